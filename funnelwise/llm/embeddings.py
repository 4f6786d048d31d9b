"""Near-duplicate embeddings by spherical-cap filters with structured random product codes.

A filter direction is a pair of code vectors, one for each half of the (randomly rotated) space, so a
vector's products with all pairs are sums of two short lists. Each vector is list-decoded to every
direction within `slack` of its best one; vectors of one label that share a direction meet in its
bucket, where their cosines are computed in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import forget, keep
from .graph import components

SEED = 20240611
#: Rows of a bucket that meet in one task, and pairs that are looked at together there.
CELL_ROWS = 1024
_PAIRS = 1 << 18


def slack_for(least: float, dim: int) -> float:
    """How far below its best a vector joins directions: 2.75 deviations of what a link changes in a product."""
    return 2.75 * (1 - least * least) ** 0.5 / max(dim, 1) ** 0.5


@lru_cache(maxsize=8)
def product_code(dim: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A rotation of the space, and `size` unit code vectors for each half of it."""
    random = np.random.default_rng([SEED, dim, size])
    rotation = np.linalg.qr(random.standard_normal((dim, dim)))[0]
    codes = [random.standard_normal((size, width)) for width in (dim // 2, dim - dim // 2)]
    return rotation, *[c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12) for c in codes]


def list_decode(units: np.ndarray, size: int, slack: float) -> list[np.ndarray]:
    """The directions, as numbers in order, whose product with each unit vector is within `slack` of its best."""
    dim = units.shape[1]
    rotation, left, right = product_code(dim, size)
    turned = units @ rotation
    a, b = turned[:, : dim // 2] @ left.T / 2**0.5, turned[:, dim // 2 :] @ right.T / 2**0.5
    best_a, best_b = a.max(axis=1), b.max(axis=1)
    out = []
    for i in range(len(units)):
        # a direction can only reach the level with a half that is within the slack of that half's best
        p, q = np.flatnonzero(a[i] >= best_a[i] - slack), np.flatnonzero(b[i] >= best_b[i] - slack)
        s, t = np.nonzero(a[i][p][:, None] + b[i][q] >= best_a[i] + best_b[i] - slack)
        out.append(np.sort(p[s] * size + q[t]).astype(np.int64))
    return out


def direction_kind(size: int) -> type:
    """Type of the numbers of the size * size directions in lists."""
    return np.int32 if size < 1 << 15 else np.int64


def with_directions(classes: DataFrame, least: float, size: int) -> DataFrame:
    """(label, dim, direction, id, copies, vector, directions): a row for each direction of each vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [v.values.to_numpy() for v in batch.column(3)]
            dims = np.array([len(v) for v in vectors])
            rows, directions, lists = [], [], []
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                own = np.stack([vectors[i] for i in at]).astype(np.float64)
                own /= np.abs(own).max(axis=1, keepdims=True)
                own /= np.linalg.norm(own, axis=1, keepdims=True)
                for i, found in zip(at, list_decode(own, size, slack_for(least, dim))):
                    rows.append(np.full(len(found), i))
                    directions.append(found)
                    lists += [found.astype(direction_kind(size)).tobytes()] * len(found)
            if not rows:
                continue
            row = pa.array(np.concatenate(rows))
            # components that are single precision, as those of a float table are, travel as such
            raw = pa.array([(short if ((short := v.astype(np.float32)) == v).all() else v).tobytes() for v in vectors], pa.binary())
            label, ids, copies = (batch.column(k).take(row) for k in range(3))
            columns = [label, pa.array(dims, pa.int32()).take(row), pa.array(np.concatenate(directions)), ids, copies, raw.take(row), pa.array(lists, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "dim", "direction", "id", "copies", "vector", "directions"])

    kind = classes.schema["label"].dataType.simpleString()
    shape = f"label {kind}, dim int, direction long, id long, copies long, vector binary, directions binary"
    return classes.select("label", "id", "copies", "vector").mapInArrow(run, shape)


def cell_links(vectors: np.ndarray, sides: np.ndarray, lists: list[np.ndarray], direction: int, copies: np.ndarray, least: float, across: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each vector of a cell: links that no smaller shared direction has, and the least position that links reach.

    across: only pairs of different sides are new here.
    """
    units = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(units @ units.T >= least, 1))
    if across:
        a, b = a[sides[a] != sides[b]], b[sides[a] != sides[b]]
    links, root = np.zeros(len(units), np.int64), np.arange(len(units))
    most = max(map(len, lists))
    table = np.full((len(lists), most), -1, np.int64)
    for i, own in enumerate(lists):
        table[i, : len(own)] = own
    step = max(1, _PAIRS // most)
    for at in range(0, len(a), step):
        p, q = a[at : at + step], b[at : at + step]
        # the pair counts in its smallest shared direction only
        smaller = np.zeros(len(p), bool)
        for k in range(most):
            mine = table[p, k]
            look = np.flatnonzero(~smaller & (mine >= 0) & (mine < direction))
            if not len(look):
                break
            smaller[look] = (table[q[look]] == mine[look, None]).any(axis=1)
        np.add.at(links, p[~smaller], copies[q[~smaller]])
        np.add.at(links, q[~smaller], copies[p[~smaller]])
    while True:
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        root = root[root]
        if (root == before).all():
            return links, root


def links_by_cell(members: DataFrame, least: float, size: int) -> DataFrame:
    """(id, links, other): what each cell found for its vectors; `other` is one that links reach, or the own id."""
    bucket, kind = ["label", "dim", "direction"], direction_kind(size)
    sizes = members.groupBy(*bucket).agg(F.ceil(F.count("*") / CELL_ROWS).cast("long").alias("blocks"))
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    rows = members.join(sizes, bucket).withColumn("block", block)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    place = F.struct(*bucket, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    rows = rows.select(place.alias("place"), F.xxhash64(place).alias("__cell"), "id", "copies", "vector", "directions", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(place: dict, rows: list[tuple]) -> pa.RecordBatch:
            ids, copies, vectors, lists, blocks = zip(*rows)
            ids, copies = np.array(ids), np.array(copies)
            table = np.stack([np.frombuffer(v, np.float32 if len(v) == 4 * place["dim"] else np.float64).astype(np.float64) for v in vectors])
            own = [np.frombuffer(x, kind) for x in lists]
            links, root = cell_links(table, np.array(blocks), own, place["direction"], copies, least, place["low"] != place["high"])
            linked = np.flatnonzero((links > 0) | (root != np.arange(len(root))))
            return pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(links[linked]), pa.array(ids[root[linked]])], names=["id", "links", "other"])

        now, held = None, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for place, *row in zip(*columns):
                if place != now:
                    if len(held) > 1:
                        yield solved(now, held)
                    now, held = place, []
                held.append(tuple(row))
        if len(held) > 1:
            yield solved(now, held)

    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(tasks, "__cell").sortWithinPartitions("place").drop("__cell")
    return dealt.mapInArrow(run, "id long, links long, other long")


def near_embeddings(table: DataFrame, least: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label", directions_each: int = 8) -> DataFrame:
    """(key, n_links, component_id, kept) of each row of `table`.

    Rows link if their labels are equal and not null, their vectors have the same dimension and a
    cosine of at least `least`, and they share a direction; n_links counts the other rows linked, component_id is the smallest key
    that links reach. A vector that is null, empty, zero or holds a null or non-finite number links
    with nothing, nor does a row of null key. Equal vectors are one class, looked at once; every row
    counts, also rows that share a key. The code grows with the root of the number of classes, so buckets stay small.
    Other columns are ignored.
    """
    numbers = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite & F.exists(numbers, lambda x: x != 0)
    rows = table.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.when(sound, numbers).alias("vector"))
    valid = rows.filter(F.col("vector").isNotNull())
    classes = keep(valid.groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies")))
    size = int(max(16, (classes.count() / directions_each) ** 0.5))
    members = keep(with_directions(classes, least, size))
    found = keep(links_by_cell(members, least, size))
    forget(members)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    reached = classes.join(links, "id", "left").join(roots, "id", "left")
    reached = reached.select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id"))
    out = rows.join(reached, ["label", "vector"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
