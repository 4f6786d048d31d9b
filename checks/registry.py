"""Named queries with their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .inputs import with_inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Result in types both engines share: UTC wall-clock timestamps, doubles for decimals."""
    def shown(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            return F.convert_timezone(None, F.lit("UTC"), c.cast("timestamp_ntz")).alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        return c

    return df.select([shown(f) for f in df.schema.fields])


def check(sql: str | None = None, inputs: tuple[str, ...] = (), name: str | None = None, **ctes: str):
    """Register a query under its function name, with the SQL its result must equal."""
    def register(build):
        key = name or build.__name__
        QUERIES[key] = lambda spark, sf_dir: plain(build(spark, sf_dir))
        if sql is not None:
            ORACLES[key] = with_inputs(list(inputs), sql, **ctes)
        return build

    return register
