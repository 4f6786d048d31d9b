"""Substring duplicates by relative Lempel-Ziv parsing of documents against indexed reference blocks.

The symbols are windows of `n` consecutive words. A reference block indexes all windows whose anchor (the least
hash of the short word grams inside the window) falls into its part of the hash range, so every
window belongs to one block and neighbours mostly to the same. A document is sent, in fragments, to the blocks that index
its windows, and is parsed greedily there: a factor starts at a window that a document of smaller id holds, and goes on as long
as both documents do. At its border the next window is looked up anew, so a window across two factors is found as well.

Before the shuffle each task parses its own documents against each other and sends on only the
windows that are not found there, so a passage held by many documents travels once from each block of a task.
Windows are equal if their hash and (half of) their anchor's hash are, 96 bits in all. A part of the hash range that holds too many windows, those around
a phrase that very many documents have, is dealt anew by window and looked up in sorted order, which holds one window at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import keep
from .text import chunks, mix

WINDOW_WORDS = 13
ANCHOR_WORDS = 5
#: Text that a task parses as one block, and that a reference block holds the windows of.
LOCAL_BYTES = 6 << 20
BLOCK_BYTES = 16 << 20
#: Parts of the hash range for each reference block; one part is looked up at a time.
PARTS = 16
#: Windows of one part that are looked up together, several times as many as a part has on average.
PART_WINDOWS = 1 << 20

_FRAGMENTS = "part int, docs binary, tags binary, starts binary, counts binary, anchors binary, hashes binary, ref_docs binary, ref_starts binary"
_FACTORS = "doc long, tag long, start long, windows long, ref_doc long, ref_start long"
_FOUND = f"{_FACTORS}, anchor long, window long"


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _planes(values: np.ndarray) -> bytes:
    """Bytes of an array, all first bytes first: planes that hardly change compress to little."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _values(planes: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _sliding_least(values: np.ndarray, n: int) -> np.ndarray:
    """Least of each n neighbours."""
    least, width = values, 1
    while 2 * width <= n:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    return np.minimum(least[: len(values) - n + 1], least[n - width :][: len(values) - n + 1])


def windows_of(text: pa.Array, n: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Row, first word, hash and anchor of every window."""
    out = [(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
    for chunk in chunks(text):
        words = chunk.word_hashes()
        start, window = chunk.windows(words, n)
        if not len(start):
            continue
        gram = np.full(len(words), np.iinfo(np.uint64).max)
        at, short = chunk.windows(words, anchor)
        gram[at] = short
        row = chunk.word_row[start]
        out.append(((chunk.first_row + row).astype(np.int32), (start - chunk.word_at[row]).astype(np.int32), window, _sliding_least(gram, n - anchor + 1)[start]))
    return tuple(np.concatenate(column) for column in zip(*out))


def first_holders(window: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Index of the first row with the same window and anchor, for each row."""
    order = np.argsort(window, kind="stable")
    same, alike = window[order][1:] == window[order][:-1], anchor[order][1:] == anchor[order][:-1]
    if (same & ~alike).any():  # two windows of one hash
        order = np.lexsort((np.arange(len(window)), anchor, window))
        same, alike = window[order][1:] == window[order][:-1], anchor[order][1:] == anchor[order][:-1]
    at = np.where(np.concatenate([[True], ~(same & alike)]), np.arange(len(order)), 0)
    holder = np.empty(len(order), np.int64)
    holder[order] = order[np.maximum.accumulate(at)]
    return holder


def factor(text: np.ndarray, doc: np.ndarray, start: np.ndarray, window: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Greedy parse of windows against an index of the same windows.

    Rows are ordered by document, text and position; `text` tells the texts apart. Returns whether a document of smaller id holds each
    window, and the factors: first row, number of windows and first row of the reference.
    """
    nothing = [np.zeros(0, np.int64)] * 3
    if not len(doc):
        return np.zeros(0, bool), nothing
    holder = first_holders(window, anchor)
    found = doc[holder] < doc
    at = np.flatnonzero(found)
    if not len(at):
        return found, nothing
    goes_on = np.concatenate([(text[1:] == text[:-1]) & (start[1:] == start[:-1] + 1), [False]])  # the next row is the next window of the text
    on = (at[1:] == at[:-1] + 1) & goes_on[at[:-1]] & (holder[at[1:]] == holder[at[:-1]] + 1) & goes_on[holder[at[:-1]]]
    first = np.flatnonzero(np.concatenate([[True], ~on]))
    begin, n, ref = at[first], np.diff(np.append(first, len(at))), holder[at[first]]
    # a run of first holders ends where another document becomes the first; the reference may go on
    last, ref_last = begin + n - 1, ref + n - 1
    more = goes_on[last] & goes_on[ref_last]
    more[more] = (window[last[more] + 1] == window[ref_last[more] + 1]) & (anchor[last[more] + 1] == anchor[ref_last[more] + 1])
    if not more.any():
        return found, [begin, n, ref]
    out, upto = [], 0
    for b, size, r, longer in zip(begin.tolist(), n.tolist(), ref.tolist(), more.tolist()):
        skipped = max(0, upto - b)
        if skipped >= size:
            continue
        b, r, size = b + skipped, r + skipped, size - skipped
        if longer:
            size = _extent(goes_on, window, anchor, b, r, size)
        out.append((b, size, r))
        upto = b + size
    return found, [np.array(c, np.int64) for c in zip(*out)]


def _extent(goes_on: np.ndarray, window: np.ndarray, anchor: np.ndarray, at: int, ref: int, n: int) -> int:
    """How many windows from `at` and from `ref` on are the same, given that `n` are; compared in steps of doubling length."""
    step = 16
    while True:
        a, r = at + n - 1, ref + n - 1  # the last pair known to be the same
        size = min(step, len(window) - 1 - max(a, r))
        same = goes_on[a : a + size] & goes_on[r : r + size] & (window[a + 1 : a + 1 + size] == window[r + 1 : r + 1 + size]) & (anchor[a + 1 : a + 1 + size] == anchor[r + 1 : r + 1 + size])
        if not same.all() or not size:
            return n + (int(np.argmin(same)) if size else 0)
        n, step = n + size, 2 * step


def _fragments(row, start, window, anchor, doc, tag, parts: int) -> Iterator[tuple]:
    """Runs of neighbouring windows of one anchor, gathered by part of the hash range."""
    if not len(row):
        return
    cut = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1) | (anchor[1:] != anchor[:-1])
    first = np.flatnonzero(np.concatenate([[True], cut]))
    count = np.diff(np.append(first, len(row)))
    # least hashes are small ones, so they are mixed again before the range is cut
    part = ((mix(anchor[first], 1) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    first, count, part = first[order], count[order], part[order]
    begin = np.concatenate([[0], np.cumsum(count)])
    window = window[np.repeat(first - begin[:-1], count) + np.arange(len(row))]
    edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
    for a, b in zip(edges[:-1], edges[1:]):
        at = first[a:b]
        of = row[at]
        tags = _planes(tag[of]) if tag[of].any() else b""
        yield (int(part[a]), _planes(doc[of]), tags, _planes(start[at].astype(np.uint32)), _planes(count[a:b].astype(np.uint32)), _planes(anchor[at].astype(np.uint32)), window[begin[a] : begin[b]].tobytes(), None, None)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(_names(_FRAGMENTS))
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], names=_names(_FRAGMENTS))


def _found(*columns: np.ndarray, pending: tuple[np.ndarray, np.ndarray] | None = None) -> pa.RecordBatch:
    """Factors; or windows still to be looked up, with their anchors and hashes."""
    none = pa.nulls(len(columns[0]), pa.int64())
    arrays = [pa.array(c.astype(np.int64)) for c in columns]
    arrays += [none] * (6 - len(arrays)) + ([none] * 2 if pending is None else [pa.array(c.view(np.int64)) for c in pending])
    return pa.RecordBatch.from_arrays(arrays, names=_names(_FOUND))


def with_tags(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(key, tag, text): rows that share a key with others are told apart by a hash of their texts; tag is 0 for all others."""
    shared = keep(docs.groupBy(F.col(key).alias("__shared")).agg(F.count("*").alias("n")).filter("n > 1 AND __shared IS NOT NULL").drop("n"))
    rows = docs.select(key, text).join(shared, F.col(key) == F.col("__shared"), "left")
    return rows.select(key, F.when(F.col("__shared").isNotNull(), F.xxhash64(text)).otherwise(F.lit(0)).alias("__tag"), text)


def shared_factors(docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS) -> DataFrame:
    """(doc, tag, start, windows, ref_doc, ref_start): factors of each document found in documents of smaller key.

    `start` counts words; a factor covers words [start, start + windows + n - 1), which also stand in
    ref_doc from ref_start. Every window that a document of smaller key holds lies in a factor.
    Null texts and texts of fewer than n words have none; rows of null key are not compared. Rows that
    share a key are told apart by `tag`, see with_tags; none is smaller than another, and all are references for larger keys.
    """
    return _factors_of(with_tags(docs, text, key), text, key, n, anchor)


def _factors_of(tagged: DataFrame, text: str, key: str, n: int, anchor: int) -> DataFrame:
    size = tagged.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    blocks = max(int(tagged.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK_BYTES))
    parts = blocks * PARTS

    def parse(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks().sort_by([(key, "ascending"), ("__tag", "ascending")])
        doc, tag = table.column(0).to_numpy(), table.column(1).to_numpy()
        again = np.concatenate([[False], (doc[1:] == doc[:-1]) & (tag[1:] == tag[:-1]) & (tag[1:] != 0)])
        if again.any():  # rows of equal key and text are one
            table, doc, tag = table.filter(pa.array(~again)), doc[~again], tag[~again]
        row, start, window, anchors = windows_of(table.column(2), n, anchor)
        del table
        found, (at, count, ref) = factor(row, doc[row], start, window, anchors)
        rows = []
        if len(at):
            columns = (doc[row[at]], tag[row[at]], start[at].astype(np.int64), count, doc[row[ref]], start[ref].astype(np.int64))
            d, t, s, c, rd, rs = map(_planes, columns)
            rows.append((int(doc[row[at[0]]]) % parts, d, t, s, c, None, None, rd, rs))
        row, start, window, anchors = (column[~found] for column in (row, start, window, anchors))
        for fragment in _fragments(row, start, window, anchors, doc, tag, parts):
            rows.append(fragment)
            if len(rows) >= 256:
                yield _batch(rows)
                rows.clear()
        yield _batch(rows)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0
        for batch in batches:
            for chunk in chunks(batch.column(2), LOCAL_BYTES):
                if held and waiting + len(chunk.data) > LOCAL_BYTES:
                    yield from parse(held)
                    held, waiting = [], 0
                held.append(batch.slice(chunk.first_row, chunk.rows))
                waiting += len(chunk.data)
        if held:
            yield from parse(held)

    def windows(fragments: list[dict]) -> tuple[np.ndarray, ...]:
        """Document, tag, position, hash and anchor of the windows of fragments, in the order of document, tag and position."""
        read = lambda name, kind: np.concatenate([_values(f[name], kind) for f in fragments])
        doc, count, anchors = read("docs", np.int64), read("counts", np.uint32).astype(np.int64), read("anchors", np.uint32).astype(np.uint64)
        tag = np.concatenate([_values(f["tags"], np.int64) if f["tags"] else np.zeros(len(f["docs"]) // 8, np.int64) for f in fragments])
        start = read("starts", np.uint32).astype(np.int64)
        hashes = np.concatenate([np.frombuffer(f["hashes"], np.uint64) for f in fragments])
        begin = np.cumsum(count) - count
        order = np.lexsort((start, tag, doc))
        size = count[order]
        step = np.arange(len(hashes)) - np.repeat(np.cumsum(size) - size, size)
        of = np.repeat(order, size)
        return doc[of], tag[of], start[of] + step, hashes[begin[of] + step], anchors[of]

    def settle(fragments: list[dict]) -> pa.RecordBatch:
        doc, tag, start, window, anchors = windows(fragments)
        text = np.cumsum(np.concatenate([[True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])]))
        again = np.concatenate([[False], (text[1:] == text[:-1]) & (start[1:] == start[:-1])])  # of rows with equal key and text
        if again.any():
            doc, tag, start, window, anchors, text = (c[~again] for c in (doc, tag, start, window, anchors, text))
        _, (at, count, ref) = factor(text, doc, start, window, anchors)
        return _found(doc[at], tag[at], start[at], count, doc[ref], start[ref])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, got, size, full = None, [], 0, False
        for batch in batches:
            for row in batch.to_pylist():
                if row["hashes"] is None:
                    yield _found(*[_values(row[c], np.int64) for c in ("docs", "tags", "starts", "counts", "ref_docs", "ref_starts")])
                    continue
                if row["part"] != part:
                    if got:
                        yield settle(got)
                    part, got, size, full = row["part"], [], 0, False
                got.append(row)
                size += len(row["hashes"]) // 8
                if full or size > PART_WINDOWS:
                    full = True
                    for one in got:
                        doc, tag, start, window, anchors = windows([one])
                        yield _found(doc, tag, start, pending=(anchors, window))
                    got = []
        if got:
            yield settle(got)

    def by_window(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows in the order of hash, anchor and document: all but the first document's have it as their reference."""
        before = None
        for batch in batches:
            column = {name: batch.column(name).to_numpy() for name in ("window", "anchor", "doc", "tag", "start")}
            if not batch.num_rows:
                continue
            keys = np.stack([column["window"], column["anchor"]])
            new = np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
            first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            ref_doc, ref_start = column["doc"][first], column["start"][first]
            if before is not None and (keys[:, 0] == before[0]).all():
                head = first == 0
                ref_doc[head], ref_start[head] = before[1:]
            before = (keys[:, -1], ref_doc[-1], ref_start[-1])
            hit = ref_doc < column["doc"]
            arrays = [column["doc"][hit], column["tag"][hit], column["start"][hit], np.ones(hit.sum(), np.int64), ref_doc[hit], ref_start[hit]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in arrays], names=_names(_FACTORS))

    sent = tagged.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("long").alias(key), "__tag", text).mapInArrow(send, _FRAGMENTS)
    looked_up = keep(sent.repartition(blocks, "part").sortWithinPartitions("part").mapInArrow(look_up, _FOUND))
    pending = looked_up.filter("window IS NOT NULL").select("window", "anchor", "doc", "tag", "start")
    late = pending.repartition("window").sortWithinPartitions("window", "anchor", "doc", "start").mapInArrow(by_window, _FACTORS)
    return looked_up.filter("windows IS NOT NULL").select(*_names(_FACTORS)).unionByName(late)


def remove_shared(docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS, kept: str | None = "kept_text") -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) and, unless `kept` is None, the kept words joined by spaces.

    A word goes if it lies in a run of n words that also stands in a document of smaller key; runs are
    judged on the input. See shared_factors for nulls and repeated keys; every row gives a row, and
    other columns are ignored.
    """
    tagged = with_tags(docs, text, key)
    span = F.struct("start", "windows")
    spans = _factors_of(tagged, text, key, n, anchor).groupBy(F.col("doc").alias("__doc"), F.col("tag").alias("__of")).agg(F.collect_set(span).alias("__spans"))
    rows = tagged.join(spans, (F.col(key) == F.col("__doc")) & (F.col("__tag") == F.col("__of")), "left").select(key, text, "__spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, digest, left = [], [], [], []
            for value, spans in zip(batch.column(1).cast(pa.large_binary()), batch.column(2)):
                words = (value.as_py() or b"").split()
                total.append(len(words))
                if spans.is_valid:
                    start, windows = (spans.values.field(i).to_numpy() for i in range(2))
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, start, 1)
                    np.add.at(depth, start + windows + n - 1, -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
                removed.append(total[-1] - len(words))
                joined = b" ".join(words)
                digest.append(hashlib.sha256(joined).hexdigest())
                if kept:
                    left.append(joined)
            arrays = [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())]
            if kept:
                arrays.append(pa.array(left, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "n_words", "n_removed", "kept_sha256", *[kept] * bool(kept)])

    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(cut, f"`{key}` {kind}, n_words long, n_removed long, kept_sha256 string" + (f", `{kept}` string" if kept else ""))
