"""Filling the stage history of deals from their changelogs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.history import backfill_candidates, backfill_count, fill_stage_history, stage_entries, stage_history_wide


def backfill_stage_history(
    deals: DataFrame, changelog: DataFrame, catalog: DataFrame, columns: list[str], limit: int, exclude: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Fill the history of the `limit` oldest incomplete deals -> (table, one-row progress).

    One pass over the changelog, one shuffle on the deal, one join to the table.
    """
    chosen = backfill_candidates(deals, columns, limit, exclude)
    log = changelog.join(chosen.select(F.col("id").try_cast("bigint").alias("deal_id")), "deal_id", "left_semi")
    filled = fill_stage_history(deals, stage_history_wide(stage_entries(log, catalog), columns))
    before = backfill_count(deals, columns).select(F.col("needing_backfill").alias("initial"))
    after = backfill_count(filled, columns).select(F.col("needing_backfill").alias("remaining"))
    processed = chosen.agg(F.count("*").alias("processed"))
    parts = before.unionByName(after, allowMissingColumns=True).unionByName(processed, allowMissingColumns=True)
    return filled, parts.agg(*[F.max(c).alias(c) for c in ("initial", "processed", "remaining")])
