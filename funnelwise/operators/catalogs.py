"""Column catalogs built from metadata, and conforming tables to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.records import kind
from ..functions.text import normalize_name
from ..schema import BASE_NAMES, HISTORY_PREFIX, INVALID_SLUG, SYSTEM_FIELD_KEYS
from .sizing import attach


def custom_field_catalog(fields: DataFrame, base_columns=BASE_NAMES, keep_reserved: bool = False, slug: Column | None = None) -> DataFrame:
    """Field metadata (key, name) -> (api_key, column, collides).

    `collides` marks columns claimed by more than one key. Names of base columns and of history
    columns are dropped; `keep_reserved` keeps them, as flattening feeds base address columns. `slug` is the name's where the metadata has it.
    """
    named = fields.filter((F.length("key") > 0) & (F.length("name") > 0) & ~F.col("key").isin(SYSTEM_FIELD_KEYS))
    catalog = named.select(F.col("key").alias("api_key"), (normalize_name(F.col("name")) if slug is None else slug).alias("column"))
    catalog = catalog.filter(F.col("column") != INVALID_SLUG)
    if not keep_reserved:
        reserved = F.col("column").isin(list(base_columns)) | F.col("column").startswith(HISTORY_PREFIX)
        catalog = catalog.filter(~reserved)
    claims = catalog.groupBy("column").agg(F.count("*").alias("claims"))
    return attach(catalog, claims, "column", "column", {"collides": F.col("claims") > 1})


def stage_column_catalog(stages: DataFrame, forbidden: DataFrame | None = None) -> DataFrame:
    """Stages (id, name) -> (stage_id, column) of their history column.

    Skips stages without id or usable name and columns in `forbidden(column)` or the base table.
    """
    slug = normalize_name(F.col("name"))
    usable = stages.filter((F.col("id") != 0) & (F.length("name") > 0)).withColumn("slug", slug)
    usable = usable.filter(F.col("slug") != INVALID_SLUG)
    column = F.concat(F.lit(HISTORY_PREFIX), "slug", F.lit("_"), F.col("id").cast("string"))
    catalog = usable.select(F.col("id").alias("stage_id"), column.alias("column"))
    catalog = catalog.filter(~F.col("column").isin(BASE_NAMES))
    return catalog if forbidden is None else catalog.join(forbidden.select("column"), "column", "left_anti").select("stage_id", "column")


def history_columns(catalog: DataFrame) -> list[str]:
    """Sorted history column names; a stage catalog has tens to hundreds of rows."""
    return sorted(r["column"] for r in catalog.select("column").distinct().collect())


def conform_columns(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, list[str]]:
    """Project to the declared columns in order; returns the undeclared names left out."""
    present = set(df.columns)
    columns = [
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    declared = {f.name for f in schema.fields}
    return df.select(*columns), [c for c in df.columns if c not in declared]


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add declared columns the table lacks, as NULL; existing ones keep their type and place."""
    present = set(df.columns)
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in present})


_SQL_TYPES = {"number": "NUMERIC(18,4)", "time": "TIMESTAMPTZ", "boolean": "BOOLEAN", "text": "TEXT"}


def _value_kind(field: T.StructField):
    """Kind of each non-null value, NULL for null."""
    c = F.col(field.name)
    if isinstance(field.dataType, T.VariantType):
        k = kind(c)
        found = (
            F.when(k.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "number")
            .when(k.isin("TIMESTAMP", "DATE"), "time")
            .when(k == "BOOLEAN", "boolean")
            .when(k != "VOID", "text")
        )
    elif isinstance(field.dataType, T.NumericType):
        found = F.lit("number")
    elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        found = F.lit("time")
    elif isinstance(field.dataType, T.BooleanType):
        found = F.lit("boolean")
    else:
        found = F.lit("text")
    return F.when(c.isNotNull(), found)


def select_new_column_types(df: DataFrame, columns: list[str]) -> DataFrame:
    """Storage type of undeclared columns -> (column, type), decided from all their values.

    Values of one kind get that kind's type; mixed or empty columns are TEXT.
    """
    low, high = {}, {}
    for name in columns:
        seen = _value_kind(df.schema[name])
        low[name], high[name] = F.min(seen), F.max(seen)
    counted = df.agg(*[low[n].alias(f"lo_{i}") for i, n in enumerate(columns)], *[high[n].alias(f"hi_{i}") for i, n in enumerate(columns)])
    types = F.create_map(*[F.lit(x) for pair in _SQL_TYPES.items() for x in pair])
    rows = [
        F.struct(
            F.lit(n).alias("column"),
            F.when(F.col(f"lo_{i}") == F.col(f"hi_{i}"), types[F.col(f"lo_{i}")]).otherwise(F.lit("TEXT")).alias("type"),
        )
        for i, n in enumerate(columns)
    ]
    return counted.select(F.inline(F.array(*rows)))
