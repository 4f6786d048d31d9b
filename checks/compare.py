"""Run registered queries against their oracles: python -m checks.compare [sf] [key ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from . import ORACLES, QUERIES

ALL_TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("funnelwise")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # the JVM does not compile larger methods; Spark then generates several instead
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in ALL_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float) and v not in (math.inf, -math.inf):
        return float(f"{v:.9g}") + 0.0
    return v


def canonical(columns: list[str], rows) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([_cell(r[i]) for i in order]) for r in rows)


def compare(spark: SparkSession, con, sf_dir: str, key: str, df: DataFrame | None = None) -> str:
    """'' where both engines agree, else what differs."""
    df = QUERIES[key](spark, sf_dir) if df is None else df
    left = canonical(df.columns, [tuple(r) for r in df.collect()])
    if key not in ORACLES:
        return ""
    result = con.execute(ORACLES[key])
    right = canonical([c[0] for c in result.description], result.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} vs {right[0]}"
    only = sorted(set(left[1]) - set(right[1]))[:2], sorted(set(right[1]) - set(left[1]))[:2]
    if left[1] != right[1]:
        return f"rows {len(left[1])} vs {len(right[1])}\n  spark {only[0]}\n  duck  {only[1]}"
    return ""


if __name__ == "__main__":
    sf, *keys = [*sys.argv[1:]] or ["0.01"]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con, bad = session(), duck(sf_dir), 0
    for key in keys or QUERIES:
        started = time.time()
        try:
            problem = compare(spark, con, sf_dir, key)
        except Exception as error:  # report every query, whatever breaks one
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{'DIFF' if problem else 'ok':5}{key} {time.time() - started:.1f}s {problem}", flush=True)
    print("failing:", bad)
