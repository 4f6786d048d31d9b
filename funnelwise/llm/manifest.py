"""Merkle manifest of a dataset, kept as a postorder append log.

Records are leaves; every FAN_OUT neighbours of a group close a node, level by level, up to the group's subroot, and the
subroots of all groups close a root in the same way. The log of a tree lists its nodes in completion order. A node's
position there follows from the sizes of the subtrees before it, so that siblings are addressed without a search.

The log is written by aligned builders: each has the FAN_OUT ** BUILDER_LEVELS leaves of one subtree, writes their nodes in order,
and hands on one top node; tops are the leaves of the next round. No task holds more than one builder's
nodes, however many records a group has. Proofs go the other way, from the round of the root down.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import keep

FAN_OUT = 8
BUILDER_LEVELS = 4
BUILDER_LEAVES = FAN_OUT**BUILDER_LEVELS
#: Number of the tree over the subroots; the trees of groups count from 0.
TOP_TREE = -1
_PATH_SHAPE = "tree long, builder long, path array<string>, subroot string, root string"


def height(leaves: int) -> int:
    """Levels above the leaves until one node remains."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FAN_OUT), levels + 1
    return levels


def log_position(level: int, index: int, leaves: int) -> int:
    """Position in the log of node `index` (from 0) of a level: the nodes completed before its last leaf, and the levels below it.

    Of each level as many nodes are complete before leaf e as whole subtrees fit before it.
    """
    last, before = min((index + 1) * FAN_OUT**level, leaves) - 1, level
    while last:
        before += last
        last //= FAN_OUT
    return before


def digest(*hex_digests: str) -> str:
    return hashlib.sha256("".join(hex_digests).encode()).hexdigest()


def fold(leaf: str, path: list[str]) -> str:
    """The root that a leaf and its siblings give; `path` has the siblings to the left and to the right of each level."""
    for left, right in zip(path[::2], path[1::2]):
        leaf = digest(left, leaf, right)
    return leaf


def record_digest(*columns: Column) -> Column:
    """SHA-256, as 32 bytes, of the values in order: `-` for null, else UTF-8 byte count, colon and text."""
    shown = [c.cast("string") for c in columns]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in shown]), 256))


def in_order(rows: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """`rows` with their 0-based `index` within the group, and (group, leaves) of all groups. Null groups and values come first.

    Rows are sorted in ranges of group and order, so that a large group is spread over tasks; one row for each range and
    group gives the offsets. Rows of equal order may be numbered either way. The ranges are written, so numbers hold.
    """
    keys = [F.col(c).asc_nulls_first() for c in group + order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = keep(ranged.withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    runs = ranged.groupBy(*group, F.col("__part").alias("part")).agg(F.min("__row").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = keep(runs.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")))
    sizes = runs.groupBy(*group).agg(F.sum("n").alias("leaves"))
    offsets = runs.select(*[F.col(c).alias(f"__of_{c}") for c in group], "part", "offset")
    same = F.col("__part") == F.col("part")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    placed = ranged.join(offsets, same).withColumn("index", F.col("__row") + F.col("offset"))
    return placed.select(*rows.columns, "index"), sizes


def _build(level: int):
    """Function of one builder's leaves, nodes of `level`: its nodes in completion order, its leaves among them."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("index", ignore_index=True)
        leaves, tree, builder = int(rows["leaves"][0]), int(rows["tree"][0]), int(rows["builder"][0])
        nodes = -(-leaves // FAN_OUT**level)
        levels = min(BUILDER_LEVELS, height(leaves) - level)
        open_: list[list[str]] = [[] for _ in range(levels + 1)]
        out = []
        for index, node, key, claimed in zip(rows["index"], rows["digest"], rows["key"], rows["claimed"]):
            out.append((tree, builder, leaves, level, index, log_position(level, index, leaves), node, key, claimed))
            open_[0].append(node.hex())
            for up in range(1, levels + 1):
                width = FAN_OUT**up
                if (index + 1) % width and index + 1 < nodes:
                    break
                made = digest(*open_[up - 1])
                open_[up - 1].clear()
                open_[up].append(made)
                out.append((tree, builder, leaves, level + up, index // width, log_position(level + up, index // width, leaves), bytes.fromhex(made), None, None))
        return pd.DataFrame(out, columns=["tree", "builder", "leaves", "level", "index", "position", "digest", "key", "claimed"])

    return run


def _walk(level: int, nodes: pd.DataFrame, above: pd.DataFrame):
    """(leaf's row, its path) of each leaf of a builder: its siblings on each level, found by log position, and the path above the builder."""
    leaves = int(nodes["leaves"].iloc[0])
    at = dict(zip(nodes["position"], (d.hex() for d in nodes["digest"])))
    counts = nodes.groupby("level")["index"].agg(["min", "max"])
    top = int(counts.index.max())
    paths = {int(counts["min"][top]): list(above["path"].iloc[0])}
    for down in range(top - 1, level - 1, -1):
        low, high = int(counts["min"][down]), int(counts["max"][down])
        digests = [at[log_position(down, i, leaves)] for i in range(low, high + 1)]
        upper, paths = paths, {}
        for start in range(0, len(digests), FAN_OUT):
            run, rest = digests[start : start + FAN_OUT], upper[(low + start) // FAN_OUT]
            for i in range(len(run)):
                paths[low + start + i] = ["".join(run[:i]), "".join(run[i + 1 :]), *rest]
    own = nodes[nodes["level"] == level]
    return own, [paths[i] for i in own["index"]]


def _paths(level: int):
    """Function of one builder's nodes and the path above it: the path of each of its leaves, itself a builder of the round below."""
    def run(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        own, paths = _walk(level, nodes, above)
        return pd.DataFrame({"tree": own["tree"], "builder": own["index"], "path": paths, "subroot": above["subroot"].iloc[0], "root": above["root"].iloc[0]})

    return run


def _proofs(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    own, paths = _walk(0, nodes, above)
    leaf = [d.hex() for d in own["digest"]]
    shown = [mine if claimed is None else claimed.hex() for mine, claimed in zip(leaf, own["claimed"])]
    return pd.DataFrame({
        "key": own["key"], "leaf": leaf, "subroot": above["subroot"].iloc[0], "root": above["root"].iloc[0], "proof_sha256": [digest(*p) for p in paths],
        "folded_root": [fold(s, p) for s, p in zip(shown, paths)], "log_position": own["position"],
    })


@dataclass
class Forest:
    """Trees and their log: `rounds` of builders' nodes (tree, builder, leaves, level, index, position, digest, key, claimed), and `tops` (tree, digest, round of its builder)."""

    rounds: list[DataFrame]
    tops: DataFrame

    def log(self) -> DataFrame:
        """(tree, position, level, index, digest): every node once, at its position in its tree's log."""
        parts = [nodes.filter((F.col("level") > number * BUILDER_LEVELS) | F.lit(number == 0)) for number, nodes in enumerate(self.rounds)]
        return reduce(DataFrame.unionByName, parts).select("tree", "position", "level", "index", "digest")

    def paths(self, above: DataFrame) -> DataFrame:
        """(tree, builder, path, subroot, root) above each builder of the first round, from (tree, path, subroot, root) above each tree."""
        enter = keep(above.join(self.tops.select("tree", "round"), "tree").select("tree", F.lit(0).cast("long").alias("builder"), "path", "subroot", "root", "round"))
        down = None
        for number in reversed(range(len(self.rounds))):
            here = enter.filter(F.col("round") == number).drop("round")
            here = here if down is None else here.unionByName(down)
            if number == 0:
                return here
            down = _cogroup(self.rounds[number], here).applyInPandas(_paths(number * BUILDER_LEVELS), _PATH_SHAPE)


def _cogroup(nodes: DataFrame, above: DataFrame):
    return nodes.groupBy("tree", "builder").cogroup(above.groupBy("tree", "builder"))


def grow(leaves: DataFrame) -> Forest:
    """Trees over (tree, leaves, index, digest, key, claimed), where `leaves` is the number of the tree's leaves."""
    key = leaves.schema["key"].dataType.simpleString()
    shape = f"tree long, builder long, leaves long, level int, index long, position long, digest binary, key {key}, claimed binary"
    rounds, tops = [], []
    while True:
        level = len(rounds) * BUILDER_LEVELS
        nodes = leaves.withColumn("builder", F.floor(F.col("index") / BUILDER_LEAVES))
        rounds.append(keep(nodes.groupBy("tree", "builder").applyInPandas(_build(level), shape)))
        finished = F.col("leaves") <= F.pow(F.lit(float(FAN_OUT)), F.col("level"))
        tops.append(rounds[-1].filter(finished).select("tree", "digest", F.lit(len(rounds) - 1).alias("round")))
        leaves = rounds[-1].filter(~finished & (F.col("level") == level + BUILDER_LEVELS)).select("tree", "leaves", "index", "digest", "key", "claimed")
        if leaves.isEmpty():
            return Forest(rounds, keep(reduce(DataFrame.unionByName, tops)))


@dataclass
class Manifest:
    """`groups` (group, tree, leaves), the trees of the groups, and the tree over their subroots."""

    groups: DataFrame
    trees: Forest
    top: Forest


def build_manifest(docs: DataFrame, fields: list[str], group: str, key: str, claims: dict[str, Column] | None = None) -> Manifest:
    """The Merkle manifest of records: leaves by group in the order of the key, null first, ties by digest.

    A leaf is the digest of `fields`, see record_digest; other columns are ignored. `claims` gives columns of the record that
    somebody shows instead, null where it is the same one; proofs can then be folded from it. Groups go in the order of
    their names, null first. Null keys are keys; repeated rows are leaves of their own; no rows give trees without nodes.
    """
    own = [F.col(f) for f in fields]
    claimed = F.lit(None).cast("binary")
    for name, other in (claims or {}).items():
        claimed = F.when(other.isNull(), claimed).otherwise(record_digest(*[other if f == name else F.col(f) for f in fields]))
    salt = F.monotonically_increasing_id().bitwiseAND(F.lit(1023)).alias("salt")
    digests = keep(docs.select(F.col(group).alias("group"), F.col(key).alias("key"), record_digest(*own).alias("digest"), claimed.alias("claimed"), salt))
    placed, sizes = in_order(digests, ["group"], ["key", "digest", "salt"])
    groups, all_groups = in_order(sizes, [], ["group"])
    groups = keep(groups.withColumnRenamed("index", "tree"))
    numbered = placed.join(groups.withColumnRenamed("group", "__group"), F.col("group").eqNullSafe(F.col("__group")))
    trees = grow(numbered.select("tree", "leaves", "index", "digest", "key", "claimed"))
    count = all_groups.first()["leaves"] or 0
    top = trees.tops.select(
        F.lit(TOP_TREE).cast("long").alias("tree"), F.lit(count).cast("long").alias("leaves"), F.col("tree").alias("index"), "digest",
        F.lit(None).cast("long").alias("key"), F.lit(None).cast("binary").alias("claimed"),
    )
    return Manifest(groups, trees, grow(top))


def prove(manifest: Manifest, name: str = "key") -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified, log_position) of each record, digests in lower-case hex.

    proof_sha256 is the digest of the siblings on the way to the root; folded_root is what they and the claimed record give, or the
    own one where none is claimed. `name` names the key.
    """
    tops = manifest.top.tops
    root = F.lower(F.hex("digest"))
    above = tops.select("tree", F.array().cast("array<string>").alias("path"), root.alias("subroot"), root.alias("root"))
    groups = _cogroup(manifest.top.rounds[0], manifest.top.paths(above)).applyInPandas(_paths(0), _PATH_SHAPE)
    groups = groups.select(F.col("builder").alias("tree"), "path", "root").join(manifest.trees.tops.select("tree", root.alias("subroot")), "tree")
    kind = manifest.trees.rounds[0].schema["key"].dataType.simpleString()
    shape = f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, log_position long"
    found = _cogroup(manifest.trees.rounds[0], manifest.trees.paths(groups)).applyInPandas(_proofs, shape)
    return found.select(F.col("key").alias(name), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "log_position")
