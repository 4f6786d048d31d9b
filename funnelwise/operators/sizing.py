"""Joins to tables with unique keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach(rows: DataFrame, table: DataFrame, key: str, table_key: str, picks: dict[str, Column | str]) -> DataFrame:
    """Left join a table with unique keys, adding `picks` (new name -> table column).

    The join carries no hint, so that its plan follows sizes measured at run time: adaptive execution
    broadcasts a table within the session's limit, and else splits the partitions that hot and NULL
    keys make large.
    """
    found = {n: f"__found_{n}" for n in picks}
    table = table.select(
        F.col(table_key).alias("__key"), *[(F.expr(c) if isinstance(c, str) else c).alias(found[n]) for n, c in picks.items()]
    )
    kept = [c for c in rows.columns if c not in picks]
    joined = rows.join(table, F.col(key) == F.col("__key"), "left")
    return joined.select(*kept, *[F.col(c).alias(n) for n, c in found.items()])
