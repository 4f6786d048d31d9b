"""Ordered computations over groups of any size, split along the time axis.

A window over a whole group would sort that group in one task. Here every window covers one
(group, chunk) only; what crosses a chunk border travels through one summary row per chunk.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys of which NULL is one; the keys come from the left side."""
    right = right.withColumnsRenamed({k: f"__same_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__same_{k}")) for k in keys], F.lit(True))
    return left.join(right, same, how).drop(*[f"__same_{k}" for k in keys])


def numbered(df: DataFrame, by: list[str], order: list[Column], chunk: Column, name: str = "position") -> DataFrame:
    """Add the 1-based position of each row within its group.

    `chunk` must rise with `order`: all rows of a chunk come before all rows of the next.
    """
    df = df.withColumn("__chunk", chunk)
    keys = [*by, "__chunk"]
    before = Window.partitionBy(*by).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = df.groupBy(*keys).agg(F.count("*").alias("__size"))
    offsets = offsets.select(*keys, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    placed = join_same(df.withColumn("__inside", inside), offsets, keys)
    return placed.withColumn(name, F.col("__offset") + F.col("__inside")).drop("__chunk", "__inside", "__offset")


def trailing_mean(df: DataFrame, by: list[str], position: str, value: str, rows: int, name: str, block: int = 4096) -> DataFrame:
    """Add the mean of the last `rows` values, given each row's position in its group.

    Rows are cut into blocks of consecutive positions; the last `rows - 1` rows of a block are
    also sent to the next one, so that each block is complete on its own.
    """
    own = F.floor(F.col(position) / block)
    carried = F.floor((F.col(position) + rows - 1) / block)
    df = df.withColumn("__own", own).withColumn("__block", F.explode(F.array_distinct(F.array(own, carried))))
    window = Window.partitionBy(*by, "__block").orderBy(position).rowsBetween(1 - rows, 0)
    df = df.withColumn(name, F.avg(value).over(window))
    return df.filter(F.col("__own") == F.col("__block")).drop("__own", "__block")


def neighbour(df: DataFrame, by: list[str], order: Column, value: str | Column, chunk: str, name: str, following: bool = False) -> DataFrame:
    """Add the value of the preceding row of the group, or of the following one; NULL where there is none.

    `chunk` names a column that rises with the order; one row for each chunk carries a value over its border. Rows of NULL keys are a group.
    """
    keys, value = [*by, chunk], F.col(value) if isinstance(value, str) else value
    edge, shift = (F.min_by, F.lead) if following else (F.max_by, F.lag)
    edges = df.groupBy(*keys).agg(edge(value, order).alias("__edge"))
    carried = shift("__edge").over(Window.partitionBy(*by).orderBy(chunk))
    borders = edges.select(*keys, carried.alias("__carried"))
    window = Window.partitionBy(*keys).orderBy(order)
    at_border = (shift(F.lit(1)).over(window)).isNull()
    inside = df.withColumns({"__border": at_border, "__next": shift(value).over(window)})
    joined = join_same(inside, borders, keys)
    merged = F.when(F.col("__border"), F.col("__carried")).otherwise(F.col("__next"))
    return joined.withColumn(name, merged).drop("__border", "__next", "__carried")


def previous(df: DataFrame, by: list[str], order: Column, value: str | Column, chunk: str, name: str) -> DataFrame:
    """Add the value of the preceding row of the group (NULL on the first), given a chunk column."""
    return neighbour(df, by, order, value, chunk, name)


def following(df: DataFrame, by: list[str], order: Column, value: str | Column, chunk: str, name: str) -> DataFrame:
    """Add the value of the next row of the group (NULL on the last), given a chunk column."""
    return neighbour(df, by, order, value, chunk, name, following=True)
