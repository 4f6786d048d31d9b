"""When each deal first entered each stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import following

_LOG_TIME = r"^\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}$"


def changelog_time(c: Column) -> Column:
    """UTC timestamp of `yyyy-MM-dd HH:mm:ss`, NULL for any other text."""
    return F.when(c.rlike(_LOG_TIME), F.concat(c, F.lit("Z")).try_cast("timestamp"))


def changelog_stage(c: Column) -> Column:
    """Stage id of a changelog value: integer text; fractions of a numeric column truncate."""
    text = F.btrim(c.cast("string"))
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))


def stage_entries(changelog: DataFrame, catalog: DataFrame) -> DataFrame:
    """Usable stage changes -> (deal_id, column, ts), several per deal and stage."""
    numeric = dict(changelog.dtypes)["new_value"] != "string"
    stage = F.col("new_value").try_cast("bigint") if numeric else changelog_stage(F.col("new_value"))
    moves = changelog.filter((F.col("field_key") == "stage_id") & (F.col("deal_id") > 0))
    moves = moves.select("deal_id", stage.alias("stage_id"), changelog_time(F.col("time")).alias("ts"))
    moves = moves.filter(F.col("stage_id").isNotNull() & F.col("ts").isNotNull())
    return moves.join(catalog, "stage_id").select("deal_id", "column", "ts")


def first_stage_entry(changelog: DataFrame, catalog: DataFrame) -> DataFrame:
    """Earliest entry per deal and stage column; map-side minima absorb busy deals."""
    return stage_entries(changelog, catalog).groupBy("deal_id", "column").agg(F.min("ts").alias("ts"))


def stage_transitions(entries: DataFrame) -> DataFrame:
    """Each stay of a deal in a stage -> (deal_id, stage, entered_at, next_stage, left_at, seconds), the last three NULL for the current one.

    `entries` are all usable changes, see stage_entries; repeated ones count once. Changes of one time go by stage name. Each task
    orders one day of a deal, so a deal of very many changes is spread.
    """
    changes = entries.groupBy("deal_id", F.col("column").alias("stage"), F.col("ts").alias("entered_at")).agg(F.to_date(F.first("ts")).alias("day"))
    change = F.struct("entered_at", "stage")
    stays = following(changes, ["deal_id"], change, change, "day", "then")
    left = F.col("then.entered_at")
    return stays.select("deal_id", "stage", "entered_at", F.col("then.stage").alias("next_stage"), left.alias("left_at"), F.timestamp_diff("SECOND", F.col("entered_at"), left).alias("seconds"))


def stage_history_wide(entries: DataFrame, columns: list[str]) -> DataFrame:
    """One row per deal, one timestamp column per stage.

    `entries` may be the earliest entries or all of them; either way there is one shuffle on deal_id.
    """
    return entries.groupBy("deal_id").agg(*[F.min(F.when(F.col("column") == c, F.col("ts"))).alias(c) for c in columns])


def fill_stage_history(deals: DataFrame, wide: DataFrame) -> DataFrame:
    """Set history cells that are NULL from `wide`; filled cells and other columns stay."""
    cells = [c for c in wide.columns if c != "deal_id" and c in deals.columns]
    updates = wide.select(F.col("deal_id").cast("string").alias("__deal"), *[F.col(c).alias(f"__{c}") for c in cells])
    joined = deals.join(updates, F.col("id") == F.col("__deal"), "left")
    return joined.select(*[F.coalesce(F.col(c), F.col(f"__{c}")).alias(c) if c in cells else F.col(c) for c in deals.columns])


def _any_null(columns: list[str]) -> Column:
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    return missing


def backfill_candidates(deals: DataFrame, columns: list[str], limit: int, exclude: DataFrame | None = None) -> DataFrame:
    """Ids of the `limit` oldest deals with a history cell missing, leaving out `exclude(id)`."""
    if exclude is not None:
        deals = deals.join(exclude.select("id"), "id", "left_anti")
    open_deals = deals.filter(_any_null(columns)).select("id", "add_time")
    return open_deals.orderBy(F.col("add_time").asc_nulls_last(), "id").limit(limit).select("id")


def backfill_count(deals: DataFrame, columns: list[str]) -> DataFrame:
    """Deals with a history cell missing; -1 where no history column is declared."""
    count = F.count_if(_any_null(columns)) if columns else F.lit(-1).cast("bigint")
    return deals.agg(count.alias("needing_backfill")) if columns else deals.agg(F.max(count).alias("needing_backfill"))


def backfill_progress(batch_results: DataFrame) -> DataFrame:
    """Totals per backfill run from its batches (run_id, initial, processed, api_errors, ...).

    `remaining` is NULL where the initial count is unknown (negative).
    """
    bad = ~F.col("status").isin("success", "skipped")
    totals = batch_results.groupBy("run_id").agg(
        F.max("initial").alias("initial"),
        F.sum("processed").alias("processed"),
        F.sum("api_errors").alias("api_errors"),
        F.sum("processing_errors").alias("processing_errors"),
        F.count_if(bad).alias("bad_batches"),
    )
    remaining = F.when(F.col("initial") >= 0, F.greatest(F.lit(0), F.col("initial") - F.col("processed")))
    status = F.when(F.col("bad_batches") > 0, "completed_with_errors").otherwise("completed")
    return totals.select(
        "run_id", "processed", remaining.alias("remaining"), "api_errors", "processing_errors", status.alias("status")
    )
