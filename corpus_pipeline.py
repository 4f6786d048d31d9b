"""A training corpus from raw documents: five stages, each written as Parquet and read by the next.

Language identification drops texts of no known language, near-duplicate detection leaves one document of
each group, secrets are masked, sources are mixed to target weights, and the result is packed into
sequences. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwise.llm.language import language_limits, learn_languages, score_languages
from funnelwise.llm.mixing import CONTENT, PLAN_COLUMNS, mix_sources, with_word_counts
from funnelwise.llm.neardup import near_duplicates
from funnelwise.llm.packing import pack_documents
from funnelwise.llm.secrets import redact, scan_secrets
from funnelwise.sources.scratch import forget, keep

#: Of labelled texts one in HELD_OUT, by content, is not learned from but shows how far code lengths of a language go.
HELD_OUT = 5
#: A text is of no known language if its bits above the language's limit rate exceed this many times those of such texts, and those of a
#: key or address of 64 bytes, which a short clean text may hold.
EXCESS_TIMES, EXCESS_BITS = 2.0, 1024.0
#: The limit rate, in bits a byte, of a language of which no text was held out.
FOREIGN_BITS = 7.0
NEAR_PERCENT = 80


def aside(docs: DataFrame, *names: str) -> DataFrame:
    """`docs` with columns that a stage needs the names of renamed."""
    return docs.withColumnsRenamed({c: f"__own_{c}" for c in docs.columns if c.lower() in names})


def back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs`, of `rows` made from `aside`."""
    return rows.select([F.col(f"__own_{c}").alias(c) if f"__own_{c}" in rows.columns else F.col(c) for c in docs.columns])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text one of the labelled languages explains, or all if none is labelled; null texts and texts without a letter go.

    The limit comes from all labelled texts that were held out, for each language, with a margin that weighs less the longer a text is.
    """
    rows = aside(docs, "lang_pred", "score", "bits_per_byte", "limit_rate", "limit_bits")
    held_out = F.coalesce(F.pmod(F.xxhash64("text"), F.lit(HELD_OUT)) == 0, F.lit(False))
    model = learn_languages(rows, ~held_out)
    limits = keep(language_limits(score_languages(rows.filter(held_out & F.col("lang").isNotNull()).select("text"), model)))
    found = score_languages(rows, model).join(F.broadcast(limits), "lang_pred", "left")  # one row for each language
    excess = (F.col("bits_per_byte") - F.coalesce("limit_rate", F.lit(FOREIGN_BITS))) * F.octet_length("text")
    most = EXCESS_TIMES * F.coalesce("limit_bits", F.lit(0.0)) + EXCESS_BITS
    return found.filter(F.col("text").rlike(r"\p{L}") & F.coalesce(excess <= most, F.lit(True))).transform(back, docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one of smallest id, and of rows without id one besides.

    Each distinct id and text is a document of its own, so rows that share an id only go if their texts are copies.
    """
    keyed = docs.withColumns({"__key": F.xxhash64("doc_id", "text"), "__text": F.xxhash64("text", F.lit(1))})
    found = near_duplicates(keyed, NEAR_PERCENT, key="__key").select("__key", "component_id").distinct()
    members = keyed.select("__key", "doc_id").distinct().join(found, "__key")
    first = members.groupBy("component_id", F.col("doc_id").isNull()).agg(F.min(F.struct("doc_id", "__key")).alias("first"))
    left = keyed.join(first.select("first.__key").hint("merge"), "__key", "left_semi")
    return left.dropDuplicates(["__key", "doc_id", "__text"]).select(docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret found in the text masked and n_chars counted anew."""
    found = scan_secrets(aside(docs, "secrets"))
    found = found.withColumn("text", redact(F.col("text"), F.col("secrets")))
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).transform(back, docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document; where it takes a part, the text is those words joined by spaces."""
    plan = mix_sources(keep(with_word_counts(aside(docs, "size", CONTENT, *PLAN_COLUMNS))))
    part = lambda start, end: F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"))
    whole = F.array_repeat(part(F.lit(0), F.col("size")), F.col("copies").cast("int"))
    cuts = F.array(part(F.col("cut_start"), F.col("cut_end")), part(F.lit(0), F.col("wrap_end")))
    taken = F.filter(F.concat(whole, cuts), lambda p: p["end"] > p["start"])
    rows = plan.withColumn("__part", F.explode(taken))
    start, end = F.col("__part.start"), F.col("__part.end")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = F.concat_ws(" ", F.slice(words, (start + 1).cast("int"), (end - start).cast("int")))
    rows = rows.withColumn("text", F.when((start == 0) & (end == F.col("size")), F.col("text")).otherwise(cut))
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).transform(back, docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in sequences of at most 2048 tokens; an id may come several times, as the mix repeats documents."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language_id", known_language),
    ("minhash_near_dedup", one_of_each_group),
    ("secret_scan", without_secrets),
    ("source_mix", mixed),
    ("sequence_packing", packed),
]

#: Tokens, sketches and byte models are not in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that the stages leave."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    written = None
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
        if written is not None:
            forget(written)
        written = docs
    return STAGES[-1][1](spark, docs, sf_dir)
