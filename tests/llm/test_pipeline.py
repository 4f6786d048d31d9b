"""The pipeline's stages: what they drop, change and return, on edges and on whole tables."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from corpus_pipeline import STAGES
from funnelwise.llm.packing import BytePairIds
from funnelwise.llm.secrets import RULES
from funnelwise.llm.text import WORD_PATTERN

from .conftest import SF_DIR, edge_rows, prose, values
from .test_tables import check_pieces, slow_near, slow_spans, slow_targets

stages = dict(STAGES)


def test_stages_are_the_ones_asked_for_and_keep_the_columns(spark, edges, nothing):
    assert list(stages) == ["language_id", "minhash_near_dedup", "secret_scan", "source_mix", "sequence_packing"]
    for name, stage in STAGES[:-1]:
        for table in (edges, nothing):
            out = stage(spark, table, SF_DIR)
            assert out.columns == table.columns and dict(out.dtypes) == dict(table.dtypes)
            own = {r["size"] for r in out.collect()} if "size" in table.columns else set()
            assert own <= {"own size"}
        assert stage(spark, nothing, SF_DIR).count() == 0
    assert stages["sequence_packing"](spark, nothing, SF_DIR).count() == 0


def test_language_stage_drops_texts_of_no_language(spark, edges):
    prose_rows = [(100 + i, prose(i, 80), "en", "a", 0) for i in range(40)] + [(200, "漢字" * 60, "en", "a", 0), (201, None, None, "a", 0), (202, "12 ? 34", "en", "a", 0)]
    docs = spark.createDataFrame(prose_rows + [(300 + i, prose(i + 50, 80), "en", "a", 0) for i in range(500)], "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id for r in stages["language_id"](spark, docs, SF_DIR).collect()}
    assert {201, 202} & left == set() and {100 + i for i in range(40)} <= left


def test_language_stage_keeps_texts_when_nothing_is_labelled(spark):
    rows = [(1, prose(1, 40), None, "a", 0), (2, "12 ? 34", None, "a", 0), (3, None, None, "a", 0), (4, "漢字", None, "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in stages["language_id"](spark, docs, SF_DIR).collect()) == [1, 4]


def test_near_duplicate_stage_leaves_one_of_each_group(spark, edges):
    left = stages["minhash_near_dedup"](spark, edges, SF_DIR).collect()
    roots = {i: root for i, _, root, _ in slow_near(edge_rows(), 80) if i is not None}
    assert sorted(r.doc_id for r in left if r.doc_id is not None) == sorted(set(roots.values()))
    assert sorted(map(repr, (r.text for r in left if r.doc_id is None))) == sorted(map(repr, (r[1] for r in edge_rows() if r[0] is None)))


def test_near_duplicate_stage_drops_true_copies_only(spark):
    texts = [prose(k, 60) for k in range(6)]
    rows = [(7, texts[0]), (7, texts[1]), (7, texts[1]), (7, texts[2]), (3, texts[2] + " tail"), (None, texts[3]), (None, texts[3] + " tail"), (None, texts[4]), (9, texts[5]), (7, texts[5])]
    docs = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    left = [(r.doc_id, r.text) for r in stages["minhash_near_dedup"](spark, docs, SF_DIR).collect()]
    assert sorted(r for r in left if r[0]) == sorted([(7, texts[0]), (7, texts[1]), (3, texts[2] + " tail"), (7, texts[5])])
    assert sorted(t.removesuffix(" tail") for i, t in left if i is None) == sorted([texts[3], texts[4]])


def test_secret_stage_masks_and_keeps_all(spark):
    rows = [(1, "my password = abcdef123 x", "en", "a", 5), (2, None, "en", "a", None), (3, "clean", None, None, 7), (1, "clean too", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    got = values(stages["secret_scan"](spark, docs, SF_DIR))
    assert got == sorted([(1, "my [SECRET] x", "en", "a", 13), (2, None, "en", "a", None), (3, "clean", None, None, 5), (1, "clean too", "en", "a", 9)], key=repr)


def test_mix_stage_takes_what_the_plan_says(spark):
    rows = [(k, prose(k, 30 + k % 50), "en", "abc"[k % 3], 0) for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = stages["source_mix"](spark, docs, SF_DIR).collect()
    taken, sizes, texts = {}, {}, {r[0]: r[1] for r in rows}
    for i, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    for r in out:
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
        assert r.text in texts[r.doc_id] and r.n_chars == len(r.text) > 0
    assert all(abs(taken[s] - t) <= 40 for s, t in slow_targets(sizes).items())


@pytest.fixture(scope="module")
def whole(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_pipeline_equals_its_stages_by_brute_force(spark, whole):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    after_language = sorted(r.doc_id for r in stages["language_id"](spark, docs, SF_DIR).collect())
    assert after_language == sorted(i for i, t, *_ in whole if re.search(r"[^\W\d_]", t or ""))
    kept = {i for i, _, _, own in slow_near([r for r in whole if r[0] in after_language], 80) if own}
    clean = {}
    for i, t, *_ in whole:
        if i in kept:
            out, at = "", 0
            for s, _, e, _ in slow_spans(t, RULES):
                out, at = (out + t[at:s] + "[SECRET]", max(at, e)) if s >= at else (out, max(at, e))
            clean[i] = out + t[at:]
    sizes, source = {}, {i: s for i, _, _, s, _ in whole}
    for i, t in clean.items():
        sizes[source[i]] = sizes.get(source[i], 0) + len(re.findall(WORD_PATTERN, t))
    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in pieces} <= kept
    encoder = BytePairIds(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert check_pieces(pieces, [], encoder) > 0.9
    full = {i: len(encoder.ids(t)) + 1 for i, t in clean.items()}
    whole_copies = {}
    for r in pieces:
        if r.start == 0 and r.doc_tokens == full[r.doc_id]:
            whole_copies[r.doc_id] = whole_copies.get(r.doc_id, 0) + 1
    words = {}
    for i, n in whole_copies.items():
        words[source[i]] = words.get(source[i], 0) + n * len(re.findall(WORD_PATTERN, clean[i]))
    target = slow_targets(sizes)
    longest = max(len(re.findall(WORD_PATTERN, t)) for t in clean.values())
    assert all(words.get(s, 0) <= t + 40 and words.get(s, 0) >= t - 3 * longest for s, t in target.items())


def test_language_model_drops_foreign_text(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(150)
    foreign = docs.limit(5).withColumns({"doc_id": F.col("doc_id") + 10**6, "text": F.lit("這是一段完全不同的文字，沒有任何一種已知的語言。" * 5), "lang": F.lit(None).cast("string")})
    left = stages["language_id"](spark, docs.union(foreign), SF_DIR)
    assert left.count() == 150 and left.filter("doc_id >= 1000000").count() == 0


def test_language_model_drops_junk_and_keeps_short_texts_with_keys(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rnd = random.Random(4)
    junk = ["".join(rnd.choices("qxzjkvwyp   ", k=900)) for _ in range(5)]
    held = docs.filter("lang = 'en' AND length(text) > 300").select(F.substring("text", 1, 60).alias("text")).limit(5)
    key = 'token = "9004e046e75240f42eecdbd3dffbc7f3d75db0ff" '
    more = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(junk + [key + r.text for r in held.collect()])], "doc_id long, text string")
    whole = docs.unionByName(more.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("new"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)}))
    left = {r.doc_id for r in stages["language_id"](spark, whole, SF_DIR).select("doc_id").collect()}
    assert left == {r.doc_id for r in docs.filter(r"text RLIKE '\\p{L}'").select("doc_id").collect()} | {10**6 + i for i in range(5, 10)}
