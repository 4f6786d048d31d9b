"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Every source gets a target; blocks are allocated to sources, then to each source's shards, by highest
quotients; each shard then takes its blocks from a seeded order of its documents, starting at a
seeded block. All numbers come from tables with one row for each source or shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import keep
from .text import chunks

PLAN_COLUMNS = ["position", "shard", "source_size", "target", "copies", "cut_start", "cut_end", "wrap_end", "taken"]
#: A column of `with_word_counts` that tells rows of one key apart.
CONTENT = "content_md5"
BLOCK_WORDS = 16
SHARD_WORDS = 1 << 17
#: Shards are apportioned in two steps, so that no step has more rows than this in a group of shards.
SHARDS_TOGETHER = 1024


def with_word_counts(docs: DataFrame, text: str = "text", name: str = "size", wanted: list[str] | None = None) -> DataFrame:
    """The columns `wanted` (all by default) with the number of words of the text, null has none, and the MD5 of the text as CONTENT."""
    docs = docs.drop(CONTENT).withColumn(CONTENT, F.md5(text))
    names = [c for c in (wanted or docs.columns) if c not in (name, CONTENT)] + [CONTENT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [n for chunk in chunks(batch.column(len(names))) for n in chunk.n_words.tolist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes, pa.int64())], names=[*names, name])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    return docs.select(*names, F.col(text).alias("__counted")).mapInArrow(run, f"{kinds}, `{name}` long")


def seeded(seed: int, *parts: Column) -> Column:
    """Hexadecimal digest of a seed and values."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))


def number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, source_size, target, position): `share` of all sizes by weight, at most `most` times a source's size.

    Weights repeat over the sources by code point, null last. What is above a limit goes to the others by weight: the level at
    which targets are weight times level is the highest of those found with the first sources at their limit.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    position = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    placed = totals.withColumn("position", position).withColumn("weight", F.element_at(cycle, (F.col("position") - 1) % len(weights) + 1))
    limit = F.lit(float(most)) * F.col("source_size")
    by_limit = Window.orderBy(limit / F.col("weight"), "position").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    placed = placed.withColumns({
        "limit": limit,
        "left": F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(by_limit), F.lit(0.0)),
        "weight_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_limit), F.lit(0.0)),
    })
    level = F.max(F.col("left") / F.col("weight_left")).over(everything)
    target = F.greatest(F.least(F.col("limit"), F.col("weight") * level), F.lit(0.0))
    return placed.withColumn("target", target).select("source", "source_size", "target", "position")


def sainte_lague(rows: DataFrame, group: list[str], weight: str, house: str, cap: str, order: list[str], name: str) -> DataFrame:
    """`rows` with `name`: seats of a house of `house` in each group, at most `cap` each, by highest quotients.

    Seats that rounding gives with a smaller house are certain. The open ones go to the highest
    quotients weight / (2 * seats + 1), ties by `order`; a row can win at most its share of the open
    seats and of the roundings, so no more quotients than that are made.
    """
    of = Window.partitionBy(*group)
    n, total = F.count("*").over(of), F.sum(weight).over(of)
    sure = F.floor(F.when(F.col("__total") > 0, F.col(weight) * F.greatest(F.col(house) - F.col("__n"), F.lit(0)) / F.col("__total")).otherwise(0) + 0.5)
    base = rows.withColumns({"__n": n, "__total": total}).withColumn("__sure", F.least(sure.cast("long"), F.col(cap)))
    base = base.withColumn("__open", F.col(house) - F.sum("__sure").over(of))
    most = F.when(F.col("__total") > 0, F.ceil((F.col("__open") + F.col("__n")) * F.col(weight) / F.col("__total")) + 2).otherwise(0)
    offers = F.greatest(F.least(F.col(cap) - F.col("__sure"), most.cast("long")), F.lit(0).cast("long"))
    made = base.filter(offers > 0).select(*group, *order, weight, "__sure", "__open", F.explode(F.sequence(F.lit(1).cast("long"), offers)).alias("__k"))
    quotient = F.col(weight) / (2 * (F.col("__sure") + F.col("__k")) - 1)
    ranked = made.withColumn("__rank", F.row_number().over(Window.partitionBy(*group).orderBy(quotient.desc(), *order)))
    won = ranked.filter(F.col("__rank") <= F.col("__open")).groupBy(*group, *order).agg(F.count("*").alias("__won"))
    return base.join(won, [*group, *order], "left").select(*rows.columns, (F.col("__sure") + F.coalesce("__won", F.lit(0))).alias(name))


def block_quotas(sized: DataFrame, sources: DataFrame, block: int) -> DataFrame:
    """(position, shard, shard_words, quota): blocks to take from each shard of each source."""
    blocks = F.ceil(F.col("words") / block)
    shards = sized.groupBy("position", "shard").agg(F.sum("size").alias("words")).withColumns({"cap": (2 * blocks).cast("long"), "part": F.floor(F.col("shard") / SHARDS_TOGETHER)})
    parts = shards.groupBy("position", "part").agg(F.sum("words").alias("words"), F.sum("cap").alias("cap"))
    whole = parts.groupBy("position").agg(F.sum("cap").alias("cap")).join(sources.select("position", "target"), "position")
    whole = whole.withColumn("house", F.round(F.sum("target").over(Window.partitionBy()) / block).cast("long"))
    whole = sainte_lague(whole, [], "target", "house", "cap", ["position"], "quota").select("position", F.col("quota").alias("house"))
    parts = sainte_lague(parts.join(whole, "position"), ["position"], "words", "house", "cap", ["part"], "quota")
    shards = shards.join(parts.select("position", "part", F.col("quota").alias("house")), ["position", "part"])
    shards = sainte_lague(shards, ["position", "part"], "words", "house", "cap", ["shard"], "quota")
    return shards.select("position", "shard", F.col("words").alias("shard_words"), "quota")


def shard_of(digest: Column, shard_words: int) -> Column:
    return number(digest) % F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))


def mix_sources(
    sized: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2,
    seed: int = 17,
    block: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    key: str = "doc_id",
) -> DataFrame:
    """Columns of `sized` (with source and size) and source_size, target, copies, cut_start, cut_end, wrap_end, taken.

    The mix takes `copies` of the whole document, its words [cut_start, cut_end) and its words
    [0, wrap_end); `taken` counts them all. `sized` is read several times: pass a table. Null sources are a source, the last; repeated rows each count; documents
    without words are taken 0 times; an empty table gives an empty one. Columns of these names are replaced. Rows are dealt to
    shards by key, size and CONTENT, so a key on many rows is spread; only rows equal in all three share a shard.
    """
    sized = sized.drop(*PLAN_COLUMNS)
    sources = keep(source_targets(sized.select("source", "size"), weights, share, most))
    own = sources.withColumnRenamed("source", "__source")
    placed = sized.join(own, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    digest = seeded(seed, F.col(key), F.col("size"), F.col(CONTENT))
    placed = placed.withColumn("shard", shard_of(digest, shard_words))
    quotas = keep(block_quotas(placed.select("position", "shard", "size"), sources, block))
    in_order = Window.partitionBy("position", "shard").orderBy(F.substring(digest, 9, 24), key, "size", CONTENT)
    end = F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = placed.withColumn("__end", end).join(quotas, ["position", "shard"])
    blocks = F.ceil(F.col("shard_words") / block)
    rows = rows.withColumns({"__start": F.col("__end") - F.col("size"), "__blocks": F.greatest(blocks, F.lit(1))})
    rows = rows.withColumns({"copies": F.floor(F.col("quota") / F.col("__blocks")), "__extra": F.col("quota") % F.col("__blocks")})
    first = number(seeded(seed, F.lit("first"), F.col("position"), F.col("shard"))) % F.col("__blocks")
    inside = lambda at: F.least(F.greatest(at - F.col("__start"), F.lit(0)), F.col("size"))
    rows = rows.withColumn("__first", first)
    rows = rows.withColumns({
        "cut_start": inside(F.col("__first") * block),
        "cut_end": inside((F.col("__first") + F.col("__extra")) * block),
        "wrap_end": inside((F.col("__first") + F.col("__extra") - F.col("__blocks")) * block),
    })
    taken = F.col("copies") * F.col("size") + F.col("cut_end") - F.col("cut_start") + F.col("wrap_end")
    return rows.withColumn("taken", taken).select(*[c for c in sized.columns if c != CONTENT], *PLAN_COLUMNS[2:])
