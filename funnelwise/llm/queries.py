"""Registered queries of this subpackage: each operator with production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.records import compute_once
from ..sources.scratch import keep
from .chat import format_conversations, loss_text, read_turns
from .embeddings import near_embeddings
from .language import identify_language
from .licenses import scan_licenses
from .manifest import build_manifest, prove
from .mixing import mix_sources, with_word_counts
from .neardup import near_duplicates
from .packing import pack_documents
from .prefixes import conversation_trie
from .quality import repetition_quality
from .secrets import BASE_RULES, scan_secrets, spans_text
from .substrings import remove_shared
from .token_counts import count_tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_repetition_quality(spark, sf_dir):
    return repetition_quality(documents(spark, sf_dir))


@query
def op3_language_id(spark, sf_dir):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    found = identify_language(documents(spark, sf_dir).select("doc_id", "text", "lang"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte")


@query
def op7_token_counts(spark, sf_dir):
    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op8_secret_scan(spark, sf_dir):
    found = scan_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind_no"] < len(BASE_RULES))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(r.kind) for r in BASE_RULES], F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("secrets")).alias("spans"))


@query
def op10_source_mix(spark, sf_dir):
    sized = keep(with_word_counts(documents(spark, sf_dir), wanted=["doc_id", "source"]))
    return mix_sources(sized).select("doc_id", "size", "source_size", "target", "taken")


@query
def op5_sequence_packing(spark, sf_dir):
    ids, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    return pack_documents(documents(spark, sf_dir), ids, ranks)


@query
def op9_license_scan(spark, sf_dir):
    return scan_licenses(documents(spark, sf_dir))


@query
def op2_substring_dedup(spark, sf_dir):
    return remove_shared(documents(spark, sf_dir), kept=None)


@query
def op6_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir), percent=85)


@query
def op4_embedding_near_dedup(spark, sf_dir):
    return near_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


#: A conversation whose texts hold the template's marks and escape.
PROBE = (-7, r"\### Assistant: </turn> ok")


@query
def op11_chat_format(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(PROBE[0]).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE[1]).alias("text"))
    made = format_conversations(turns.unionByName(probe))
    read = compute_once(made, {"turns": read_turns(F.col("formatted")), "loss": loss_text(F.col("segments"))})
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "fault",
    )


@query
def op12_prefix_trie(spark, sf_dir):
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), families=True)


@query
def op13_merkle_manifest(spark, sf_dir):
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", upper, lower))
    return prove(build_manifest(documents(spark, sf_dir), ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", {"text": tampered}), "doc_id")
