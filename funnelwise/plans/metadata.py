"""The pipeline's declarations, made from field and stage metadata."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normalize_name
from ..operators.catalogs import custom_field_catalog, history_columns, stage_column_catalog
from ..schema import BASE_NAMES, deal_schema
from ..sources.scratch import keep


@dataclass(frozen=True)
class DealPlan:
    """What transform and sync need: custom field keys to columns, the table's schema, and stages to history columns.

    The declarations are tables; the driver holds one, a row for each field or stage of the account, only when it is asked for.
    """

    mapped: DataFrame
    own: DataFrame
    stage_catalog: DataFrame

    @cached_property
    def mapping(self) -> dict[str, str]:
        return {r["api_key"]: r["column"] for r in self.mapped.orderBy("api_key", "column").collect()}

    @cached_property
    def history(self) -> list[str]:
        return history_columns(self.stage_catalog)

    @cached_property
    def schema(self) -> T.StructType:
        return deal_schema([r["column"] for r in self.own.collect()], self.history)

    def rows(self) -> DataFrame:
        """The declarations as rows (part, name, kind): each mapped key once, and the columns beside those of the base table."""
        row = lambda part, name, kind: [F.lit(part).alias("part"), F.col(name).alias("name"), kind.alias("kind")]
        mapped = self.mapped.groupBy("api_key").agg(F.max("column").alias("column"))
        mapping = mapped.select(*row("mapping", "api_key", F.col("column")))
        times = self.stage_catalog.select("column").distinct()
        columns = self.own.select(*row("column", "column", F.lit("text"))).unionByName(times.select(*row("column", "column", F.lit("time"))))
        return mapping.unionByName(columns.filter(~F.col("name").isin(BASE_NAMES)))


def deal_plan(fields: DataFrame, stages: DataFrame) -> DealPlan:
    """Declarations from field metadata (key, name) and stages (id, name).

    The mapping also feeds address columns of the base table; a stage column that a custom field claims is
    left out. Slugs are made once, in a written table that all declarations read.
    """
    named = keep(fields.select("key", "name", normalize_name(F.col("name")).alias("slug")))
    mapped = custom_field_catalog(named, keep_reserved=True, slug=F.col("slug")).select("api_key", "column")
    own = custom_field_catalog(named, slug=F.col("slug")).select("column").distinct()
    return DealPlan(mapped, own, stage_column_catalog(stages, own))
