"""Newest-wins merging of deal batches into the deal table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import HISTORY_PREFIX


def latest_per_id(df: DataFrame, id: str = "id", order: str = "update_time", seq: str | list[str] = "seq") -> DataFrame:
    """One row per id: newest `order`, ties to the highest `seq`.

    Spark ranks before the shuffle too, so each task sends one row per id and many copies of one
    id never meet in a single task.
    """
    ties = [seq] if isinstance(seq, str) else seq
    newest = [F.col(order).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in ties]]
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(id).orderBy(*newest)))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def new_records(source: DataFrame, target: DataFrame, id_key: str = "id") -> DataFrame:
    """Source rows whose id, as text, is not in the target; rows without id are kept."""
    held = target.select(F.col("id").cast("string").alias("__held"))
    return source.join(held, source[id_key].cast("string") == held["__held"], "left_anti")


def _applies(old_time: Column, new_time: Column) -> Column:
    """Newest-wins rule: equal times update, a NULL new time never beats a known one."""
    return old_time.isNull() | F.coalesce(new_time >= old_time, F.lit(False))


def _merged(column: str, shared: bool, applies: Column, history: str) -> Column:
    old, new = F.col(f"t.{column}"), F.col(f"s.{column}")
    if not shared:
        return old
    if column == "add_time":
        new = F.coalesce(old, new)
    elif history == "preserve" and column.startswith(HISTORY_PREFIX):
        new = F.coalesce(old, new)
    return F.when(applies, new).otherwise(old)


def merge_deals(target: DataFrame, source: DataFrame, history: str = "overwrite") -> DataFrame:
    """Upsert `source` (one row per id) into `target`.

    New ids are inserted. A known id is updated when the target's update_time is NULL or not
    newer; the earliest known add_time stays. `history="preserve"` keeps stage-history cells that
    are already filled, "overwrite" replaces them with the source's.

    One full outer join reads either side once.
    """
    source = source.select(*[c for c in target.columns if c in source.columns])
    t, s = target.alias("t"), source.withColumn("__sent", F.lit(True)).alias("s")
    on = F.col("t.id") == F.col("s.id")
    applies = F.col("s.__sent").isNotNull() & _applies(F.col("t.update_time"), F.col("s.update_time"))
    shared = set(source.columns) - {"id"}
    inserts = F.col("t.id").isNull()
    columns = []
    for c in target.columns:
        if c == "id":
            columns.append(F.coalesce(F.col("t.id"), F.col("s.id")).alias(c))
        elif c in shared:
            columns.append(F.when(inserts, F.col(f"s.{c}")).otherwise(_merged(c, True, applies, history)).alias(c))
        else:
            columns.append(F.col(f"t.{c}").alias(c))
    return t.join(s, on, "full_outer").select(*columns)
