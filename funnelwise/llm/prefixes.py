"""The trie of conversation prefixes, by digests of fixed-length blocks of turns.

Conversations that share their first blocks share a running digest, so one grouping by block digest finds the groups of all
levels at once, and copies fold into one row. Only blocks whose siblings diverge are then cut at their turns and
grouped again; a block without a sibling gives its turns as they are. Texts never leave the map pass: a turn travels as
two 64-bit digests and a length, and a prefix as the exclusive or of its turns' digests, each mixed with its position.
Such digests can be folded in chunks, so that a conversation of any length is spread over tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import forget, keep

BLOCK_TURNS = 4
#: Turns of a conversation that are ordered or folded together; a multiple of BLOCK_TURNS.
CHUNK_TURNS = 4096
HEAD_TURNS = 5
#: Ids of the conversations that end at one node which a piece of their list holds.
PIECE_IDS = 4096

_NODE = ["p1", "p2"]
_UP = ["up1", "up2"]


def turn_digests(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, t1, t2, chars) of every turn: digests of role and text, and the text's code points."""
    said = [F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))]
    digest = lambda seed: F.xxhash64(F.lit(seed), *said)
    return turns.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), digest(1).alias("t1"), digest(2).alias("t2"), F.length(said[1]).cast("long").alias("chars")
    )


def _with_running(rows: DataFrame, chunk: Column, order: list[Column], sums: dict[str, Column], xors: dict[str, Column]) -> DataFrame:
    """Add inclusive running sums and exclusive ors over each conversation. `chunk` rises with the order; one row for each chunk crosses the borders."""
    rows, keys = rows.withColumn("__chunk", chunk), ["conv", "__chunk"]
    folds = {n: (F.sum, c) for n, c in sums.items()} | {n: (F.bit_xor, c) for n, c in xors.items()}
    before = Window.partitionBy("conv").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = rows.groupBy(*keys).agg(*[fold(c).alias(n) for n, (fold, c) in folds.items()])
    carried = chunks.select(*keys, *[fold(n).over(before).alias(f"__{n}") for n, (fold, _) in folds.items()]).filter(F.col(f"__{next(iter(folds))}").isNotNull())
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({n: fold(c).over(inside) for n, (fold, c) in folds.items()}).join(carried, keys, "left")
    rows = rows.withColumns({n: F.col(n) + F.coalesce(f"__{n}", F.lit(0)) for n in sums} | {n: F.col(n).bitwiseXOR(F.coalesce(f"__{n}", F.lit(0))) for n in xors})
    return rows.drop("__chunk", *[f"__{n}" for n in folds])


def numbered_turns(digests: DataFrame) -> DataFrame:
    """`digests` with the 1-based position of each turn: by turn, null first, ties by digest. `digests` is read twice: pass a table."""
    chunk = F.coalesce(F.floor(F.col("turn") / CHUNK_TURNS), F.lit(-(1 << 60)))
    return _with_running(digests, chunk, [F.col("turn").asc_nulls_first(), F.col("t1"), F.col("t2")], {"position": F.lit(1).cast("long")}, {})


def with_family_heads(numbered: DataFrame) -> DataFrame:
    """Conversations rebuilt in families of 100: (conv, position, t1, t2, chars), one row of null position if no turn is left.

    Conversation c has the first h turns of c - c % 100 (all if fewer, none if absent), then its own after its first
    h; h is crc32(c) % 6. `numbered` is read several times: pass a table.
    """
    top = numbered.filter((F.col("conv") % 100 == 0) & (F.col("position") <= HEAD_TURNS))
    heads = top.groupBy(F.col("conv").alias("family")).agg(F.array_sort(F.collect_list(F.struct("position", "t1", "t2", "chars"))).alias("head"))
    convs = numbered.groupBy("conv").agg(F.count("*").alias("n")).withColumns({
        "family": F.col("conv") - F.col("conv") % 100, "h": (F.crc32(F.col("conv").cast("string")) % (HEAD_TURNS + 1)).cast("int"),
    })
    none = F.array().cast(heads.schema["head"].dataType)
    convs = convs.join(heads, "family", "left").select("conv", "n", "h", F.when(F.col("h") > 0, F.slice(F.coalesce("head", none), F.lit(1), F.greatest("h", F.lit(1)))).otherwise(none).alias("head"))
    empty = (F.size("head") == 0) & (F.col("n") <= F.col("h"))
    taken = convs.filter((F.size("head") > 0) | empty).select("conv", F.inline_outer("head"))
    own = numbered.join(convs.select("conv", "h", F.size("head").alias("k")), "conv").filter(F.col("position") > F.col("h"))
    return taken.unionByName(own.select("conv", (F.col("position") - F.col("h") + F.col("k")).alias("position"), "t1", "t2", "chars"))


def prefix_digests(rebuilt: DataFrame) -> DataFrame:
    """(conv, position, chars, m1, m2, p1, p2, total): each turn's mixed digest, and the running ones and code points up to it. Reads `rebuilt` twice."""
    mixed = lambda seed: F.xxhash64(F.lit(seed), "position", "t1", "t2")
    rows = rebuilt.filter(F.col("position").isNotNull()).select("conv", "position", "chars", mixed(3).alias("m1"), mixed(4).alias("m2"))
    return _with_running(rows, F.floor((F.col("position") - 1) / CHUNK_TURNS), [F.col("position")], {"total": F.col("chars")}, {"p1": F.col("m1"), "p2": F.col("m2")})


def turn_blocks(prefixes: DataFrame, block: int = BLOCK_TURNS) -> DataFrame:
    """(conv, block, up1, up2, turns): the at most `block` turns of each block in order, and the digest of all before."""
    turn = F.struct("position", "p1", "p2", "chars", "total")
    first = lambda c: F.min_by(c, "position")
    at = F.floor((F.col("position") - 1) / block).alias("block")
    return prefixes.groupBy("conv", F.floor((F.col("position") - 1) / CHUNK_TURNS).alias("chunk"), at).agg(
        first(F.col("p1").bitwiseXOR(F.col("m1"))).alias("up1"), first(F.col("p2").bitwiseXOR(F.col("m2"))).alias("up2"), F.array_sort(F.collect_list(turn)).alias("turns")
    ).drop("chunk")


def block_values(blocks: DataFrame, *folds: Column) -> DataFrame:
    """Distinct blocks after the same blocks: (up1, up2, turns, diverges, and the folds), diverges if there is more than one."""
    last = F.element_at("turns", -1)
    keyed = blocks.withColumns({"d1": last["p1"], "d2": last["p2"]})
    values = keep(keyed.groupBy(*_UP, "d1", "d2").agg(F.first("turns").alias("turns"), *folds))
    siblings = values.groupBy(*_UP).agg((F.count("*") > 1).alias("diverges"))
    return values.join(siblings, _UP).drop("d1", "d2")


def turns_of(values: DataFrame, picks: dict[str, Column], folds: list[Column]) -> DataFrame:
    """Nodes (p1, p2, up1, up2, depth, before, and the folds): the turns of block values, grouped by prefix where siblings diverge.

    `picks` gives a column for turn number j (from 0) of a value; `folds` fold them under their names.
    """
    cut = values.select("*", F.posexplode("turns").alias("j", "t"))
    up = [F.when(F.col("j") == 0, F.col(f"up{n}")).otherwise(F.get("turns", F.col("j") - 1)[f"p{n}"]).alias(f"up{n}") for n in (1, 2)]
    before = (F.col("t.total") - F.col("t.chars")).alias("before")
    rows = cut.select("diverges", F.col("t.p1").alias("p1"), F.col("t.p2").alias("p2"), *up, F.col("t.position").alias("depth"), before, *[c.alias(n) for n, c in picks.items()])
    whole = rows.filter(~F.col("diverges")).drop("diverges")
    facts = [*_NODE, *_UP, "depth", "before"]
    return whole.unionByName(rows.filter("diverges").groupBy(*facts).agg(*folds))


def ends_hashes(ends: DataFrame) -> DataFrame:
    """(p1, p2, ends): SHA-256 of the comma-joined ids of the conversations that end at each node, ascending.

    Ids are sorted over ranges of (node, id) and joined to pieces there, so that a node at which very many end is
    spread over tasks; only its pieces meet, and are hashed one after another.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, out = None, [], []

        def close():
            if ids:
                out.append((*node, ids[0], ",".join(map(str, ids))))
                ids.clear()

        for batch in batches:
            for p1, p2, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (p1, p2) != node or len(ids) >= PIECE_IDS:
                    close()
                    node = (p1, p2)
                ids.append(conv)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=[*_NODE, "first", "ids"])
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=[*_NODE, "first", "ids"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, out = None, None, []
        for batch in batches:
            for p1, p2, ids in zip(*(batch.column(n).to_pylist() for n in (*_NODE, "ids"))):
                if (p1, p2) != node:
                    if node is not None:
                        out.append((*node, digest.hexdigest()))
                    node, digest = (p1, p2), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=[*_NODE, "ends"])
                out.clear()
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*node, digest.hexdigest())], names=[*_NODE, "ends"])

    in_ranges = ends.select(*_NODE, "conv").repartitionByRange(*_NODE, "conv").sortWithinPartitions(*_NODE, "conv")
    joined = in_ranges.mapInArrow(pieces, "p1 long, p2 long, first long, ids string")
    return joined.repartition(*_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(hashes, "p1 long, p2 long, ends string")


def trie_of(rebuilt: DataFrame, block: int = BLOCK_TURNS) -> DataFrame:
    """The prefix trie of conversations (conv, position from 1, t1, t2, chars; a null position for one without turns).

    Columns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.
    A conversation owns the nodes of which it is the smallest member: the last part of its path, from a depth on. What it shares with
    smaller ones is what a trie saves of it, and each leaf has one owner; so sums over subtrees are sums over members.
    Equal prefixes are those of equal 128-bit digests. No rows give no node. `rebuilt` is read several times: pass a table.
    """
    prefixes = keep(prefix_digests(rebuilt))
    blocks = keep(turn_blocks(prefixes, block))
    ending = F.max(F.struct("position", *_NODE, "total")).alias("end")
    convs = prefixes.groupBy("conv").agg(ending).select("conv", "end.*")
    none = F.lit(0).cast("long")
    convs = keep(convs.unionByName(rebuilt.filter("position is null").select("conv", none.alias("position"), none.alias("p1"), none.alias("p2"), none.alias("total"))))

    smallest = F.min("conv").alias("conv")
    found = keep(turns_of(block_values(blocks, smallest), {"conv": F.col("conv")}, [smallest]))
    children = found.groupBy(F.col("up1").alias("p1"), F.col("up2").alias("p2")).agg(F.count("*").alias("n_children"))
    top = F.min(F.struct("depth", "before", *_UP, *_NODE)).alias("top")
    owners = keep(found.join(children, _NODE, "left").groupBy("conv").agg(top, F.max(F.col("n_children").isNull().cast("long")).alias("leaf")))

    shared = convs.join(owners, "conv", "left").select("conv", F.coalesce("top.before", "total").alias("saved"), F.coalesce("leaf", none).alias("leaf"))
    shared = keep(shared)
    n, leaves = F.count("*").alias("n_convs"), F.sum("leaf").alias("n_leaves")
    rest = lambda j: F.greatest(F.col("saved") - F.get("turns", F.lit(j))["total"] + F.get("turns", F.lit(j))["chars"], F.lit(0))
    values = block_values(blocks.join(shared, "conv"), n, smallest, leaves, *[F.sum(rest(j)).alias(f"saved{j}") for j in range(block)])
    picks = {c: F.col(c) for c in ("n_convs", "conv", "n_leaves")} | {"saved": F.get(F.array(*[f"saved{j}" for j in range(block)]), F.col("j"))}
    nodes = turns_of(values, picks, [F.sum("n_convs").alias("n_convs"), smallest, F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")])
    root = shared.agg(n, smallest, leaves, F.sum("saved").alias("saved")).filter("n_convs > 0").withColumns({"p1": none, "p2": none, "depth": none})
    above = found.select(F.col("p1").alias("up1"), F.col("p2").alias("up2"), F.col("conv").alias("parent"))
    above = above.unionByName(root.select(none.alias("up1"), none.alias("up2"), F.col("conv").alias("parent")))
    parents = owners.select("top.*").join(above, _UP).select(*_NODE, "parent")

    parts = [nodes.drop(*_UP, "before"), root, children, parents, ends_hashes(convs)]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    whole = every.groupBy(*_NODE).agg(*[F.max(c).alias(c) for c in every.columns if c not in _NODE])
    return whole.select(
        F.col("conv").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "conv")).alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", none).alias("n_children"), F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", families: bool = False, block: int = BLOCK_TURNS) -> DataFrame:
    """The prefix trie of conversations, see trie_of; with `families`, of the conversations that with_family_heads rebuilds.

    Turns go by number, null first, ties by digest; null roles and texts are empty; rows of null key are not of a conversation;
    repeated rows are turns of their own; other columns are ignored.
    """
    digests = keep(turn_digests(turns, key, turn, role, text))
    numbered = keep(numbered_turns(digests))
    rebuilt = keep(with_family_heads(numbered) if families else numbered.select("conv", "position", "t1", "t2", "chars"))
    forget(digests, numbered)
    return trie_of(rebuilt, block)
