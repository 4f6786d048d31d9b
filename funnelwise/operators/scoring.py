"""Choosing the best batch size of an experiment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .run_log import SUCCESS
from .sizing import attach

DEFAULT_BATCH_SIZE = 1000


def _best(runs: DataFrame, usable: Column, maxima: dict[str, Column], score: Column, default: int) -> DataFrame:
    """Best-scoring usable run per experiment; the earliest wins ties, `default` if none is usable."""
    runs = runs.withColumn("usable", F.coalesce(usable, F.lit(False)))
    tops = runs.groupBy("experiment").agg(*[F.max(F.when(F.col("usable"), c)).alias(n) for n, c in maxima.items()])
    rated = attach(runs, tops, "experiment", "experiment", {n: F.col(n) for n in maxima})
    rated = rated.withColumn("score", F.when(F.col("usable"), score))
    order = F.when(F.col("usable"), F.struct(F.col("score"), -F.col("seq")))
    best = rated.groupBy("experiment").agg(F.max_by(F.struct("batch_size", "score"), order).alias("best"))
    size = F.coalesce(F.col("best.batch_size"), F.lit(default)).cast("int")
    return best.select("experiment", size.alias("batch_size"), F.col("best.score").alias("score"))


def _share(value: Column, top: Column) -> Column:
    return F.when(top > 0, value / top).otherwise(0.0)


def score_runs_balanced(runs: DataFrame, default: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """Weighs short runs 0.4, low memory 0.4 and few quality issues 0.2."""
    duration, memory, issues = F.col("duration_s"), F.col("peak_memory_mb"), F.col("data_quality_issues")
    usable = (F.coalesce(issues, F.lit(0)) != -1) & (duration > 0) & (memory >= 0)
    quality = F.when(F.col("top_issues") > 0, F.coalesce(1 - issues / F.col("top_issues"), F.lit(0.0))).otherwise(1.0)
    score = 0.4 * (1 - _share(duration, F.col("top_duration"))) + 0.4 * (1 - _share(memory, F.col("top_memory"))) + 0.2 * quality
    return _best(runs, usable, {"top_duration": duration, "top_memory": memory, "top_issues": issues}, score, default)


def score_runs_throughput(runs: DataFrame, default: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """Weighs rows per second 0.7 and low memory 0.3 over clean, successful runs."""
    duration, memory = F.col("duration_s"), F.col("peak_memory_mb")
    usable = (F.col("status") == SUCCESS) & (F.col("data_quality_issues") == 0) & (duration > 0) & (memory >= 0)
    speed = F.try_divide(F.col("loaded"), duration)
    score = 0.7 * _share(speed, F.col("top_speed")) + 0.3 * (1 - _share(memory, F.col("top_memory")))
    return _best(runs, usable, {"top_speed": speed, "top_memory": memory}, score, default)


def experiment_success_rate(runs: DataFrame) -> DataFrame:
    """Share of successful runs per batch size."""
    return runs.groupBy("batch_size").agg(
        F.count("*").alias("runs"), F.avg((F.col("status") == SUCCESS).cast("double")).alias("success_rate")
    )
