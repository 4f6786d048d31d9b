"""Operators that read one text at a time: words, quality, languages, tokens and licences."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import public_tokenizers
from funnelwise.llm import language, licenses, text
from funnelwise.llm.language import KeyTable, fit_contexts, identify_language
from funnelwise.llm.licenses import TEMPLATES, all_templates, scan_licenses
from funnelwise.llm.quality import repetition_quality
from funnelwise.llm.queries import QUERIES
from funnelwise.llm.token_counts import count_tokens, piece_counter

from .conftest import SF_DIR, edge_rows, prose, values

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\t\x0b\x1cé漢▁", max_size=40)), max_size=12)


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_chunks_find_the_words(texts):
    column = pa.array(texts, pa.string())
    for chunk in text.chunks(column, size=16):
        starts, ends = chunk.spans
        for row in range(chunk.rows):
            own = slice(chunk.word_at[row], chunk.word_at[row + 1])
            want = re.findall(text.WORD_PATTERN, texts[chunk.first_row + row] or "")
            assert [chunk.data[s:e].tobytes().decode() for s, e in zip(starts[own], ends[own])] == want


def test_hashes_depend_on_the_bytes_only():
    words = [w for t in (prose(3, 500), prose(4, 500)) for w in t.split()]
    joined = " ".join(words)
    for column in (pa.array([joined]), pa.array(words), pa.array([None, "", joined]).slice(1)):
        hashes = np.concatenate([c.word_hashes() for c in text.chunks(column, 100)])
        assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))
    upper = next(text.chunks(pa.array([joined.upper()])))
    assert upper.word_hashes(lower=True).tolist() == next(text.chunks(pa.array([joined]))).word_hashes().tolist()


def test_key_table_finds_what_it_holds():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 5000, dtype=np.uint64))
    table = KeyTable(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(keys + np.uint64(1 << 50)) == -1).all()
    assert (KeyTable(keys[:0]).find(keys) == -1).all()


def slow_quality(t):
    words = re.findall(text.WORD_PATTERN, t or "")
    triples = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if triples[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [l for l in (t or "").split("\n") if re.search(text.WORD_PATTERN, l)]
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(inside), n < 50 or 100 * len(inside) > 50 * n


def test_quality_of_edges(edges, nothing):
    got = repetition_quality(edges)
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert values(got.select("doc_id", *columns)) == sorted(((r[0], *slow_quality(r[1])) for r in edge_rows()), key=repr)
    assert by_id(got, "kept")[12] == (False,) and by_id(got, "kept")[6] == (True,)
    assert repetition_quality(nothing).count() == 0


def test_quality_keeps_prose_and_rejects_repetition(spark):
    texts = [prose(i, 200) for i in range(20)] + [" ".join([prose(90, 12)] * 20), "\n".join([prose(91, 20)] * 3 + [prose(92, 60)])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = by_id(repetition_quality(docs), "kept")
    assert all(kept[i] == (True,) for i in range(20)) and kept[20] == kept[21] == (False,)


def test_language_accuracy_on_held_out_documents(spark):
    found = QUERIES["op3_language_id"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 and (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def slow_code_length(samples, order, t):
    """Code length of a text by walking down the contexts, byte by byte."""
    counts = {}
    for s in samples:
        padded = b"\n" * order + s.lower().encode()
        for i in range(order, len(padded)):
            for k in range(order + 1):
                counts.setdefault(padded[i - k : i], Counter())[padded[i]] += 1
    padded, bits = b"\n" * order + t.lower().encode(), 0.0
    for i in range(order, len(padded)):
        for k in range(order, -2, -1):
            if k < 0:
                bits += 8
                break
            seen = counts.get(padded[i - k : i])
            if seen and padded[i] in seen:
                bits += np.log2((seen.total() + len(seen)) / seen[padded[i]])
                break
            if seen:
                bits += np.log2((seen.total() + len(seen)) / len(seen))
    return bits


@pytest.mark.parametrize("order", [0, 2, 4])
def test_code_lengths_equal_those_of_a_walk(order):
    samples = {"a": ["the cat sat on the mat", "the dog"], "b": ["le chat est là", "été"], "c": [""]}
    texts = ["the chat", "là là", "zzz", "", "ça 中", "t"]
    model = fit_contexts(samples, order)
    (chunk,) = text.chunks(pa.array(texts))
    got = model.code_lengths(chunk) / 4096
    want = [[slow_code_length(samples[l], order, t) for l in model.languages] for t in texts]
    assert np.allclose(got, want, atol=0.02)


def test_language_of_edges(edges, nothing):
    got = identify_language(edges)
    assert got.columns == [c for c in edges.columns if c not in ("lang_pred", "score")] + ["lang_pred", "score", "bits_per_byte"]
    found = {r.doc_id: r for r in got.collect()}
    assert [found[i].lang_pred for i in (1, 2, 3, 15)] == ["und"] * 4 and found[15].score == 0.0 and found[6].lang_pred in ("en", "fr")
    assert got.count() == len(edge_rows()) and identify_language(nothing).count() == 0
    assert {r.lang_pred for r in identify_language(edges, F.lit(False)).collect()} == {"und"}


def test_language_sample_is_bounded_and_whole(edges, spark):
    from funnelwise.llm.language import language_samples

    docs = spark.createDataFrame([(i, prose(i, 40), "en" if i % 3 else "de") for i in range(60)], "doc_id long, text string, lang string")
    samples = language_samples(docs, "text", "lang", "doc_id", 5, 10**9)
    assert {l: len(s) for l, s in samples.items()} == {"en": 5, "de": 5}
    assert {t for s in samples.values() for t in s} <= {prose(i, 40) for i in range(60)}
    assert {l: len(s) for l, s in language_samples(docs, "text", "lang", "doc_id", 5, 1).items()} == {"en": 1, "de": 1}


def test_language_sample_of_shared_and_null_ids(spark):
    from funnelwise.llm.language import language_samples

    rows = [(7, prose(i, 40), "en" if i % 2 else "de") for i in range(60)] + [(None, prose(i, 40), "fr") for i in range(60)] + [(8, "x" * 5000, "xx")] + [(9, "same", "yy")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    samples = language_samples(docs, "text", "lang", "doc_id", 5, 1500)
    assert {l: len(s) for l, s in samples.items() if l in ("xx", "yy")} == {"xx": 1, "yy": 1} and set(samples) == {"en", "de", "fr", "xx", "yy"}
    assert all(1 <= len(s) <= 5 and sum(len(t) for t in s) <= 1500 for s in samples.values())


MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet="  aethins.\n▁é", max_size=60)))
def test_token_counts_equal_the_library(library, t):
    assert piece_counter(MODEL).count(t) == len(library.encode(t))


def test_token_counts_of_tables(spark, edges, nothing, library):
    got = values(count_tokens(edges, MODEL))
    rows = [(i, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t, *_ in edge_rows()]
    assert got == sorted(rows, key=repr) and count_tokens(nothing, MODEL).count() == 0
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = {r.doc_id: len(library.encode(r.text)) for r in docs.collect()}
    assert {k: v[0] for k, v in by_id(QUERIES["op7_token_counts"](spark, SF_DIR), "n_tokens").items()} == want


def test_licences_in_lines_paragraphs_and_texts(spark, edges, nothing):
    texts = [
        "some words\nReleased under the MIT license\nother words",
        "This program is free software: you can redistribute it and/or modify it under the\nterms of the GNU General Public License as published\nby the Free Software Foundation, either version 3 of the License,\nor (at your option) any later version.\n\nmore",
        "released under the", "MIT", None, "",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [(r.doc_id, r.start, r.license, r.dice) for r in scan_licenses(docs).collect()]
    assert (0, 2, "mit_statement", 1.0) in got and (1, 0, "gpl_3_notice", 1.0) in got
    assert {g[0] for g in got} == {0, 1}
    assert scan_licenses(edges).count() == 0 and scan_licenses(nothing).count() == 0
    assert scan_licenses(docs, templates={"empty": "", "one": "word"}).count() == 0


def test_every_licence_template_wins_over_its_siblings(spark):
    of = {n: t for n, t in all_templates().items() if n not in TEMPLATES}
    docs = spark.createDataFrame([(n, " ".join(t.split())) for n, t in of.items()], "doc_id string, text string")
    got = {(r.doc_id, r.license, r.dice) for r in scan_licenses(docs).collect() if r.start == 0}
    assert {(n, n, 1.0) for n in of} <= got
    assert {"bsd_2_text", "bsd_3_text", "isc_text", "mpl_2_text", "lgpl_2_1_text", "gpl_2_text", "agpl_3_notice_program", "cc_by_sa_3_statement_short"} <= set(of)


def test_licences_inside_longer_texts(spark):
    all_of, before, after = all_templates(), prose(1, 400), prose(2, 400)
    marked = lambda t, mark, end="\n": end.join(mark + l for l in t.split("\n"))
    texts = {
        "mit_text": "\n".join([before, marked(all_of["mit_text"], " * "), after]), "bsd_3_text": "\r\n".join([before, marked(all_of["bsd_3_text"], "# ", "\r\n"), after]),
        "isc_text": " ".join([before, *all_of["isc_text"].split(), after]), "gpl_2_text": before + "\n" + all_of["gpl_2_text"], "lgpl_2_1_text": all_of["lgpl_2_1_text"] + after, "bsd_2_text": all_of["bsd_2_text"],
        "mit_statement": "Copyright 2020 Foo Inc. Released under the MIT License.", "cc_by_sa_3_statement_short": f"{before} Licensed under CC BY-SA 3.0", "agpl_3_notice_program": f"{before} {all_of['agpl_3_notice_program']} {after}",
        "gpl_2_notice_program": "\n".join(["int x;", "/* Foo", " *", " * " + all_of["gpl_2_notice_program"], " *", " */", after]), "mpl_2_notice": marked(before + "\n\n" + all_of["mpl_2_notice"] + "\n\n" + after, "# "),
        "apache_2_notice": "x\r" + all_of["apache_2_notice"] + "\r" + before,
    }
    docs = spark.createDataFrame([*texts.items(), ("none", f"{before} licensed under the {after}")], "doc_id string, text string")
    found = scan_licenses(docs).collect()
    best = {r.doc_id: r.license for r in sorted(found, key=lambda r: (r.end - r.start) * (r.dice - 0.75))}
    assert best == {name: name for name in texts}
    twice = spark.createDataFrame([(1, f"{before} Released under the MIT License. {after} Released under the MIT License. {before}")], "doc_id long, text string")
    assert [(r.start, r.end, r.license, r.dice) for r in sorted(scan_licenses(twice).collect())] == [(400, 405, "mit_statement", 1.0), (805, 810, "mit_statement", 1.0)]


def test_nothing_depends_on_the_seeded_order(spark):
    rows = edge_rows()
    random.Random(5).shuffle(rows)
    a, b = (spark.createDataFrame(r, "doc_id long, text string, lang string, source string, n_chars long") for r in (edge_rows(), rows))
    assert values(repetition_quality(a)) == values(repetition_quality(b.repartition(5)))


def test_parts_are_those_that_every_start_finds(monkeypatch):
    """All templates; a failed start that rules out its neighbours leaves the parts that trying each of them finds."""
    index = licenses.TemplateIndex.of(licenses.all_templates(), 0.75)
    rnd, texts = random.Random(4), list(licenses.all_templates().values())
    words = max(texts, key=len).split()
    shreds = lambda n, k: " ".join(" ".join(words[i : i + k]) for i in rnd.choices(range(len(words) - k), k=n))
    samples = [shreds(300, 8), shreds(40, 60), " filler words ".join(rnd.sample(texts, 12)), shreds(100, 8) + " " + rnd.choice(texts) + " " + shreds(100, 20)]
    samples += [" ".join(w if rnd.random() < 0.93 else "other" for w in t.split()) for t in rnd.sample(texts, 12)]

    def found(t):
        (chunk,) = text.chunks(pa.array([t], pa.large_string()), 1 << 30, licenses._SEPARATORS)
        at, grams = chunk.windows(chunk.word_hashes(lower=True), 2)
        hit, place = index.find(grams)
        by_word = np.zeros(len(chunk.spans[0]), np.uint64)
        by_word[at] = grams
        return licenses.parts(index, by_word, chunk.word_row, chunk.word_at, at[hit], place)

    fast = [found(t) for t in samples]
    monkeypatch.setattr(licenses, "_hopeless", lambda dice, least, size: 0.5)  # the start alone
    assert fast == [found(t) for t in samples] and sum(map(len, fast)) > 12


def test_language_limits_are_quantiles_of_the_rates_and_of_what_is_above(spark):
    rows = [("en", 2.0 + i / 1000, "x" * 100) for i in range(1000)] + [("en", 9.0, "x" * 50), ("fr", 3.0, "y"), ("und", None, "z")]
    got = {r.lang_pred: r for r in language.language_limits(spark.createDataFrame(rows, "lang_pred string, bits_per_byte double, text string"), high=1.0).collect()}
    assert got.keys() == {"en", "fr"} and got["fr"].limit_rate == 4.5 and got["fr"].limit_bits == 0
    assert abs(got["en"].limit_rate - 1.5 * 2.99) < 0.01 and abs(got["en"].limit_bits - (9 - got["en"].limit_rate) * 50) < 1e-6
    assert language.language_limits(spark.createDataFrame([], "lang_pred string, bits_per_byte double, text string")).count() == 0


@pytest.mark.parametrize("slices", [(1,), (4, 2, 1), (4096, 64, 8, 1)])
def test_language_samples_are_the_same_however_they_are_sliced(spark, monkeypatch, slices):
    rows = [(i % 50 if i % 3 else None, f"{'abc'[i % 3]} text {i // 2}", "ef"[i % 2]) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    want = language.language_samples(docs, "text", "lang", "doc_id", 40, 10_000)
    monkeypatch.setattr(language, "SLICES", slices)
    assert language.language_samples(docs, "text", "lang", "doc_id", 40, 10_000) == want
    assert all(len(texts) == 40 for texts in want.values())
