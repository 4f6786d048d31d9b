"""Near-duplicate documents: fast similarity sketches, banding, and exact verification.

Sketches propose; full shingle sets decide. Documents with equal sets are one class and only the
class's smallest document goes on. Representatives that share a band are compared by sketch inside
the band's bucket, which gives clusters of probably similar documents; the texts of each cluster are then brought
together once and the links of its full sets are confirmed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import forget, keep
from .graph import components
from .keysets import split_by_keys
from .text import Chunk, by_row, chunks, group_by_row, mix

COORDINATES = 128
BAND = 4
#: Rows of a group that are compared in one task; larger groups are cut into blocks.
CELL_ROWS = 512
#: Shingles of a group's texts that count as a row, so that a cell of long texts holds fewer of them.
ROW_SHINGLES = 4096
#: Blocks of a group of which all pairs are compared.
GRID_BLOCKS = 16
#: A sketch must be this many standard deviations below the threshold to exclude a link.
SLACK = 5


def shingle_sets(chunk: Chunk, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, ordered by row and hash, and where each row's begin.

    Words are in lower case (A-Z). A row of fewer than n words, but one at least, has one shingle.
    """
    words = chunk.word_hashes(lower=True)
    start, shingle = chunk.windows(words, n)
    row = chunk.word_row[start]
    for few in range(1, n):
        short = np.flatnonzero(chunk.n_words == few)
        if len(short):
            total = sum(words[chunk.word_at[short] + j] * np.uint64(0xD6E8FEB86659FD93 + 2 * j) for j in range(few))
            row, shingle = np.append(row, short), np.append(shingle, mix(total, 100 + few))
    order = group_by_row(shingle, row)
    row, shingle = row[order], shingle[order]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (shingle[1:] != shingle[:-1])]) if len(row) else np.zeros(0, bool)
    row, shingle = row[new], shingle[new]
    return shingle, np.searchsorted(row, np.arange(chunk.rows + 1))


def similarity_sketches(shingle: np.ndarray, row_at: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """Fast similarity sketch of each row: t coordinates, agreeing between two sets with their Jaccard similarity.

    In round i of the first t, every element is placed in a hashed bin; in round t + i all of them go to bin i, so
    that after 2t rounds each bin has an element. A bin keeps its least (round, hash). A row whose
    bins are all filled after a round is done, which takes one or two rounds for most texts.
    """
    rows = len(row_at) - 1
    out = np.full((rows, t), np.iinfo(np.uint64).max)
    count = np.diff(row_at)
    open_ = np.flatnonzero(count)
    low = np.uint64((1 << 55) - 1)
    for turn in range(2 * t):
        if not len(open_):
            break
        at = np.repeat(row_at[open_] - np.concatenate([[0], np.cumsum(count[open_])])[:-1], count[open_]) + np.arange(count[open_].sum())
        hashed = mix(shingle[at], turn + 1)
        own = np.repeat(np.arange(len(open_)), count[open_])
        place = (hashed >> np.uint64(55)).astype(np.int64) % t if turn < t else np.full(len(at), turn - t)
        flat = out[open_]
        np.minimum.at(flat.reshape(-1), own * t + place, (hashed & low) | np.uint64(turn << 55))
        out[open_] = flat
        open_ = open_[(flat == np.iinfo(np.uint64).max).any(axis=1)]
    return out


def band_keys(sketches: np.ndarray, width: int) -> np.ndarray:
    """One hash for each band of `width` coordinates."""
    bands = sketches.reshape(len(sketches), -1, width)
    keys = np.arange(bands.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(width):
        keys = mix(keys ^ bands[:, :, j], j)
    return keys.view(np.int64)


def sketch_table(docs: DataFrame, text: str, key: str, n: int, t: int, band: int) -> DataFrame:
    """(key, n_shingles, set_1, set_2, bands, sketch): set_1 and set_2 are equal for equal sets; sketch has a byte of each coordinate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                shingle, row_at = shingle_sets(chunk, n)
                sketches = similarity_sketches(shingle, row_at, t)
                sums = [by_row(mix(shingle, 1000 + k), row_at).view(np.int64) for k in (1, 2)]
                bands = band_keys(sketches, band)
                offsets = pa.array(np.arange(chunk.rows + 1) * bands.shape[1], pa.int32())
                columns = [
                    batch.column(0).slice(chunk.first_row, chunk.rows),
                    pa.array(np.diff(row_at), pa.int64()),
                    *[pa.array(s) for s in sums],
                    pa.ListArray.from_arrays(offsets, pa.array(bands.ravel())),
                    pa.array([s.tobytes() for s in sketches.astype(np.uint8)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "n_shingles", "set_1", "set_2", "bands", "sketch"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_shingles long, set_1 long, set_2 long, bands array<long>, sketch binary")


def spanning_links(n: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect whatever the links of n items connect. linked(i, others): which of the others i links with.

    A search from each item reached so far looks only at items not yet reached, so alike items cost
    one comparison each.
    """
    links, left = [], np.arange(n)
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            i = queue.pop()
            hit = linked(i, left)
            links += [(i, int(j)) for j in left[hit]]
            queue += left[hit].tolist()
            left = left[~hit]
    return links


def sketch_links(payloads: list[bytes], least: float) -> list[tuple[int, int]]:
    """Spanning links of sketches that agree in at least `least` of their coordinates."""
    table = np.frombuffer(b"".join(payloads), np.uint8).reshape(len(payloads), -1)
    return spanning_links(len(table), lambda i, others: (table[others] == table[i]).mean(axis=1) >= least)


def set_links(payloads: list[bytes], percent: float, n: int) -> list[tuple[int, int]]:
    """Spanning links of texts with 100 * intersection >= percent * union of their shingle sets."""
    sets = []
    for chunk in chunks(pa.array(payloads, pa.large_binary())):
        shingle, row_at = shingle_sets(chunk, n)
        sets += [shingle[row_at[i] : row_at[i + 1]] for i in range(chunk.rows)]
    size = np.array([len(s) for s in sets])
    begin = np.concatenate([[0], np.cumsum(size)])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1] if len(sets) else np.zeros(0, np.int64)
    mine = np.zeros(ids.max() + 1 if len(ids) else 1, bool)

    def linked(i: int, others: np.ndarray) -> np.ndarray:
        out = np.zeros(len(others), bool)
        near = np.flatnonzero(100 * np.minimum(size[others], size[i]) >= percent * np.maximum(size[others], size[i]))
        if not len(near):
            return out
        mine[ids[begin[i] : begin[i + 1]]] = True
        picked = others[near]
        at = np.repeat(begin[picked] - np.concatenate([[0], np.cumsum(size[picked])])[:-1], size[picked]) + np.arange(size[picked].sum())
        common = np.add.reduceat(mine[ids[at]].astype(np.int64), np.concatenate([[0], np.cumsum(size[picked])])[:-1])
        mine[ids[begin[i] : begin[i + 1]]] = False
        out[near] = 100 * common >= percent * (size[picked] + size[i] - common)
        return out

    return spanning_links(len(sets), linked)


def links_in_groups(members: DataFrame, spanning: Callable[[list[bytes]], list[tuple[int, int]]]) -> DataFrame:
    """(a, b): spanning links of each group of `members` (group, rows, id, payload), `rows` being the group's size, or more where payloads are long.

    A group of at most CELL_ROWS rows is one cell. A larger one is cut into blocks by a hash of the id, and
    up to GRID_BLOCKS blocks every pair of blocks is a cell. In a group beyond that, every block first meets one
    small block of pivots, which settles a large group of alike items; whatever is then not connected with the
    group's largest part, and only that, meets every block. All pairs that could still connect parts are compared.
    """
    blocks = F.ceil(F.col("rows") / CELL_ROWS).cast("long")
    sized = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    zero = F.lit(0).cast("long")
    every = F.sequence(zero, F.col("blocks") - 1)
    cell = lambda low, high: F.struct(low.alias("low"), high.alias("high"))
    pivot = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 40)) < F.lit(1 << 40) * 32 / F.col("rows")
    others = F.when(F.col("blocks") <= GRID_BLOCKS, F.transform(every, lambda k: cell(F.least("block", k), F.greatest("block", k))))
    others = others.when(pivot, F.transform(every, lambda k: cell(k, k))).otherwise(F.array(cell(F.col("block"), F.col("block"))))
    first = keep(_cell_links(sized.withColumn("cell", F.explode(others)), spanning))
    many = sized.filter(F.col("blocks") > GRID_BLOCKS)
    if many.isEmpty():
        return first
    parts = components(first).withColumnRenamed("id", "__id")
    labelled = many.join(parts, F.col("id") == F.col("__id"), "left").withColumn("part", F.coalesce("root", "id"))
    by_part = labelled.groupBy("group", "part").agg(F.count("*").alias("n"))
    largest = by_part.groupBy("group").agg(F.max(F.struct("n", "part")).alias("top")).select("group", F.col("top.part").alias("main"))
    open_ = keep(labelled.join(largest, "group").filter("part != main").select(*many.columns))
    crowd = open_.groupBy("group").agg(F.ceil(F.count("*") / CELL_ROWS).cast("long").alias("slices"))
    spread = open_.join(crowd, "group").withColumn("high", F.pmod(F.xxhash64("id", F.lit(2)), F.col("slices"))).withColumn("low", F.explode(every))
    alls = many.join(crowd, "group").withColumn("low", F.col("block")).withColumn("high", F.explode(F.sequence(zero, F.col("slices") - 1)))
    crossed = [rows.select("group", "id", "payload", cell(F.col("low"), F.col("high")).alias("cell")) for rows in (spread, alls)]
    return keep(first.unionByName(_cell_links(crossed[0].unionByName(crossed[1]), spanning)))


def _cell_links(members: DataFrame, spanning: Callable[[list[bytes]], list[tuple[int, int]]]) -> DataFrame:
    """Spanning links of each (group, cell). Cells are of bounded size and read one after another."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(ids: list[int], payloads: list[bytes]) -> pa.RecordBatch:
            links = spanning(payloads) if len(ids) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([ids[x[k]] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

        now, ids, payloads = None, [], []
        for batch in batches:
            for place, own, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if place != now:
                    if len(ids) > 1:
                        yield solved(ids, payloads)
                    now, ids, payloads = place, [], []
                ids.append(own)
                payloads.append(payload.as_py())
        if len(ids) > 1:
            yield solved(ids, payloads)

    cell = F.xxhash64("group", "cell").alias("__cell")
    dealt = members.select(F.struct("group", "cell").alias("place"), "id", F.col("payload").cast("binary"), cell)
    dealt = dealt.repartition(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__cell").sortWithinPartitions("place", "id")
    return dealt.select("place", "id", "payload").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, percent: float = 80, text: str = "text", key: str = "doc_id", n: int = 5, t: int = COORDINATES, band: int = BAND) -> DataFrame:
    """(key, n_shingles, component_id, kept) of each row of `docs`.

    Documents link if 100 times the intersection of their sets of n-word shingles is at least `percent`
    times the union; component_id is the smallest key that links reach, kept says that it is the own
    one. Texts without words, and nulls, are in no link, nor are rows of null key, which are kept; rows that
    share a key are one document, which links by any of its texts. Other columns are ignored.
    """
    sketches = keep(sketch_table(docs, text, key, n, t, band))
    with_words = sketches.filter((F.col("n_shingles") > 0) & F.col(key).isNotNull())
    # equal sets have equal bands and sketches
    classes = keep(with_words.groupBy("set_1", "set_2").agg(F.min(key).alias("id"), F.max("n_shingles").alias("shingles"), F.first("bands").alias("bands"), F.first("sketch").alias("payload")))
    bands = classes.select("id", F.explode("bands").alias("group"))
    signed = bands.groupBy("group").agg(F.count("*").alias("rows"), F.bit_xor(F.xxhash64("id")).alias("x"), F.sum(F.pmod(F.xxhash64("id", "id"), F.lit(1 << 31))).alias("s"))
    # of buckets with the same members one is enough
    buckets = signed.filter("rows > 1").groupBy("rows", "x", "s").agg(F.min("group").alias("group")).select("group", "rows")
    rows = bands.join(buckets, "group").join(classes.select("id", "payload"), "id")
    share = percent / 100
    probable = share - SLACK * (share * (1 - share) / t) ** 0.5
    rows = keep(rows)
    likely = links_in_groups(rows, lambda payloads: sketch_links(payloads, probable))
    clusters = components(likely)
    forget(rows, likely)
    roots_too = clusters.union(clusters.select(F.col("root").alias("id"), "root").distinct())
    of_cluster = roots_too.join(classes.select("id", "shingles"), "id")
    sizes = of_cluster.groupBy("root").agg(F.greatest(F.count("*"), F.ceil(F.sum("shingles") / ROW_SHINGLES)).alias("rows"))
    members = keep(roots_too.join(sizes, "root").select("id", F.col("root").alias("group"), "rows"))
    # one plan at every size: what the text side costs then follows the members
    probable, _ = split_by_keys(docs.select(F.col(key).alias("id"), F.col(text).alias("payload")), members, "id")
    texts = probable.join(members.hint("merge"), "id").dropDuplicates(["id", "payload"])
    texts = keep(texts)
    confirmed = links_in_groups(texts, lambda payloads: set_links(payloads, percent, n))
    roots = components(confirmed)
    forget(texts, confirmed, members)
    ids = classes.join(roots, "id", "left").select("set_1", "set_2", F.coalesce("root", "id").alias("component_id"))
    out = sketches.select(key, "n_shingles", "set_1", "set_2").join(ids, ["set_1", "set_2"], "left")
    own = F.when((F.col("n_shingles") == 0) | F.col(key).isNull(), F.col(key)).otherwise(F.coalesce("component_id", F.col(key)))
    return out.select(key, "n_shingles", own.alias("component_id")).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
