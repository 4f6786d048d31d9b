"""Run metrics as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame


def export_run_metrics_csv(runs: DataFrame, path: str) -> None:
    """Write run metrics as CSV files with a header, replacing what is at `path`."""
    runs.write.mode("overwrite").option("header", True).csv(path)
