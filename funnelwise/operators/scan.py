"""Reading the deal table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def incremental_scan(df: DataFrame, since: Column | None = None, limit: int | None = None) -> DataFrame:
    """Rows updated at or after `since` (all if None); with `limit`, the earliest updated ones.

    Without a limit the rows come unordered: merging does not depend on their order.
    """
    if since is not None:
        df = df.filter(F.col("update_time") >= since)
    if limit is not None:
        df = df.orderBy(F.col("update_time").asc_nulls_first(), "id").limit(limit)
    return df


def point_lookup(deals: DataFrame, id) -> DataFrame:
    """The row of one id, compared as text; empty if absent."""
    return deals.filter(F.col("id") == F.lit(str(id)))


def all_ids(deals: DataFrame) -> DataFrame:
    return deals.select("id")


def count_records(deals: DataFrame) -> DataFrame:
    return deals.agg(F.count("*").alias("records"))
