"""Run summaries, batch quality, and health from the operational logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import numbered, trailing_mean

RESOURCES = ["peak_memory_mb", "cpu_percent", "threads", "disk_bytes"]
SUCCESS, ERROR = "success", "error"


def run_watermark(fetched: DataFrame, loaded: DataFrame) -> DataFrame:
    """Next watermark: newest fetched update_time plus a second, cut to seconds; NULL if nothing loaded."""
    newest = fetched.agg(F.max("update_time").alias("newest")).withColumn("loaded", F.lit(0).cast("bigint"))
    count = loaded.agg(F.count("*").alias("loaded"))
    both = newest.unionByName(count, allowMissingColumns=True).agg(F.max("newest").alias("newest"), F.sum("loaded").alias("loaded"))
    next_second = next_watermark("newest").cast(fetched.schema["update_time"].dataType)
    return both.select(F.when(F.col("loaded") > 0, next_second).alias("watermark"))


def next_watermark(newest: str) -> Column:
    return F.date_trunc("second", F.col(newest) + F.expr("INTERVAL '1' SECOND"))


def run_summary(fetched: DataFrame, rejected: DataFrame, loaded: DataFrame, error: str | None = None) -> DataFrame:
    """One row: fetched, validated, loaded and failed counts with status and message.

    With the `error` that broke a run off, whatever was not loaded counts as failed.
    """
    sides = {"fetched": fetched, "failed": rejected, "loaded": loaded}
    counts = None
    for name, df in sides.items():
        part = df.agg(F.count("*").alias("n")).withColumn("side", F.lit(name))
        counts = part if counts is None else counts.unionByName(part)
    total = lambda side: F.sum(F.when(F.col("side") == side, F.col("n")))
    row = counts.agg(*[total(s).alias(s) for s in sides])
    return summary_row(row, error)


def summary_row(counts: DataFrame, error: str | None = None) -> DataFrame:
    """Add validated, status and message to fetched, failed and loaded; other columns stay, last."""
    row = counts.withColumn("validated", F.col("fetched") - F.col("failed"))
    message = F.format_string("ETL completed. Fetched=%d, Validated=%d, Loaded=%d, Failed=%d.", "fetched", "validated", "loaded", "failed")
    rest = [c for c in counts.columns if c not in ("fetched", "failed", "loaded")]
    if error is not None:
        failed = F.greatest(F.col("failed"), F.col("fetched") - F.col("loaded")).alias("failed")
        return row.select("fetched", "validated", "loaded", failed, F.lit(ERROR).alias("status"), F.lit(f"Critical ETL failure: {error}").alias("message"), *rest)
    return row.select("fetched", "validated", "loaded", "failed", F.lit(SUCCESS).alias("status"), message.alias("message"), *rest)


def batch_quality(batches: DataFrame) -> DataFrame:
    """Per batch: size, failures by type, error rate, and whether it was empty."""
    sums = batches.groupBy("run_id", "batch_id").agg(
        F.sum("original").alias("size"),
        F.sum("schema_failed").alias("schema_failed"),
        F.sum("transform_failed").alias("transform_failed"),
    )
    sums = sums.withColumn("failed", F.col("schema_failed") + F.col("transform_failed"))
    return sums.withColumns({
        "error_rate": F.when(F.col("size") > 0, F.col("failed") / F.col("size")),
        "is_empty": F.col("size") == 0,
    })


def stage_times(batches: DataFrame) -> DataFrame:
    """Extract, transform and load seconds per flow -> (flow_type, stage, runs, total_s, mean_s)."""
    stages = [c[:-2] for c in ("extract_s", "transform_s", "load_s") if c in batches.columns]
    timed = [F.struct(F.lit(s).alias("stage"), F.col(f"{s}_s").alias("seconds")) for s in stages]
    long = batches.select("flow_type", F.inline(F.array(*timed)))
    return long.groupBy("flow_type", "stage").agg(
        F.count("seconds").alias("runs"), F.sum("seconds").alias("total_s"), F.avg("seconds").alias("mean_s")
    )


def db_op_stats(ops: DataFrame) -> DataFrame:
    """Count and seconds by operation, with the highest connection counts."""
    return ops.groupBy("operation").agg(
        F.count("*").alias("operations"),
        F.sum("duration_s").alias("total_s"),
        F.max("active").alias("max_active"),
        F.max("idle").alias("max_idle"),
    )


def aux_sync_totals(syncs: DataFrame) -> DataFrame:
    """Dimension sync log -> runs, failures and records per entity."""
    failed = F.col("status") != SUCCESS
    return syncs.groupBy("entity_type").agg(
        F.count("*").alias("runs"),
        F.count_if(failed).alias("failures"),
        F.sum(F.when(failed, 0).otherwise(F.col("records"))).alias("records"),
    )


def flow_run_health(runs: DataFrame) -> DataFrame:
    """Per flow: runs, failures, last finish, last success and the resources of the last run."""
    ok = F.col("status") == SUCCESS
    resources = [c for c in RESOURCES if c in runs.columns]
    order = F.struct("end_ts", "seq") if "seq" in runs.columns else F.col("end_ts")
    return runs.groupBy("flow_type").agg(
        F.count("*").alias("runs"),
        F.count_if(~ok).alias("failures"),
        F.max("end_ts").alias("last_finish"),
        F.max(F.when(ok, F.col("end_ts"))).alias("last_success"),
        *[F.max_by(c, order).alias(f"last_{c}") for c in resources],
    )


def sla_breaches(runs: DataFrame, max_seconds: float = 3600, max_memory_mb: float = 4096) -> DataFrame:
    """Runs that broke a target, with the list of broken ones."""
    checks = [
        ((F.col("duration_s") < 0) | (F.col("duration_s") >= max_seconds), "duration"),
        (F.col("peak_memory_mb") >= max_memory_mb, "memory"),
        ((F.col("fetched") > 0) & (F.col("loaded") == 0), "nothing_loaded"),
    ]
    reasons = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for bad, name in checks]))
    return runs.withColumn("breaches", reasons).filter(F.size("breaches") > 0)


def batch_size_advice(
    runs: DataFrame,
    max_memory_mb: float,
    memory_threshold: float = 0.8,
    duration_threshold: float = 30.0,
    window: int = 5,
    reduce: float = 0.7,
    increase: float = 1.2,
    smallest: int = 100,
    largest: int = 2000,
    chunk: Column | None = None,
) -> DataFrame:
    """Add `advice`, the next batch size each run suggests for its flow.

    Too much memory shrinks the batch; otherwise, once more than `window` runs were seen, the mean
    duration of the last ones shrinks or grows it; else it stays. `chunk` is a coarse time rising
    with (start_ts, seq), by default the day; it bounds how many runs one task orders.
    """
    chunk = F.to_date("start_ts") if chunk is None else chunk
    placed = numbered(runs, ["flow_type"], [F.col("start_ts"), F.col("seq")], chunk)
    recent = trailing_mean(placed, ["flow_type"], "position", "duration_s", window, "recent_s")
    size = F.col("batch_size")
    smaller = F.greatest(F.lit(smallest), (size * reduce).cast("int"))
    larger = F.least(F.lit(largest), (size * increase).cast("int"))
    advice = (
        F.when(F.col("peak_memory_mb") > max_memory_mb * memory_threshold, smaller)
        .when((F.col("position") > window) & (F.col("recent_s") > duration_threshold), smaller)
        .when(F.col("position") > window, larger)
        .otherwise(size)
    )
    return recent.withColumn("advice", advice.cast("int")).drop("position", "recent_s")
