"""Dimension tables from raw entity records, and their type-1 upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.records import get, text, unwrap_id, whole_number
from ..functions.text import normalize_name
from ..schema import HISTORY_PREFIX, UNKNOWN_NAME


def _known(raw: DataFrame, record: str) -> DataFrame:
    """Records that carry an id."""
    return raw.filter(whole_number(get(F.col(record), "id")).isNotNull())


def _id(record: str, key: str = "id") -> Column:
    return whole_number(get(F.col(record), key))


def _name(record: str) -> Column:
    """Name; the default stands in for an absent key only, a null name stays NULL."""
    name = get(F.col(record), "name")
    return F.when(name.isNull(), F.lit(UNKNOWN_NAME)).otherwise(text(F.col(record), "name"))


def _active(record: str) -> Column:
    flag = get(F.col(record), "active_flag")
    return F.when(flag.isNull(), F.lit(True)).otherwise(F.try_variant_get(flag, "$", "boolean"))


def dim_users(raw: DataFrame, record: str = "record") -> DataFrame:
    return _known(raw, record).select(
        _id(record).alias("user_id"), _name(record).alias("user_name"), _active(record).alias("is_active")
    )


def dim_persons(raw: DataFrame, record: str = "record") -> DataFrame:
    org = unwrap_id(get(F.col(record), "org_id"), key="value")
    return _known(raw, record).select(_id(record).alias("person_id"), _name(record).alias("person_name"), org.alias("org_id"))


def dim_stages(raw: DataFrame, record: str = "record") -> DataFrame:
    """Stages with their slug; a null or empty name counts as absent here."""
    given = F.coalesce(F.nullif(text(F.col(record), "name"), F.lit("")), F.lit(UNKNOWN_NAME))
    stripped = F.when(given.startswith(HISTORY_PREFIX), F.substring(given, F.lit(len(HISTORY_PREFIX) + 1), F.length(given))).otherwise(given)
    named = _known(raw, record).withColumn("stage_name", stripped)
    slug = F.when(F.col("stage_name") != UNKNOWN_NAME, normalize_name(F.col("stage_name")))
    return named.select(
        _id(record).alias("stage_id"),
        "stage_name",
        slug.alias("normalized_name"),
        _id(record, "pipeline_id").alias("pipeline_id"),
        _id(record, "order_nr").alias("order_nr"),
        _active(record).alias("is_active"),
    )


def dim_pipelines(raw: DataFrame, record: str = "record") -> DataFrame:
    return _known(raw, record).select(
        _id(record).alias("pipeline_id"), _name(record).alias("pipeline_name"), _active(record).alias("is_active")
    )


def dim_orgs(raw: DataFrame, record: str = "record") -> DataFrame:
    return _known(raw, record).select(_id(record).alias("org_id"), _name(record).alias("org_name"))


def id_name_map(raw: DataFrame, drop_empty: bool, record: str = "record") -> DataFrame:
    """(id, name) of an entity: names trimmed and blank ones dropped, or defaulted when absent."""
    known = _known(raw, record)
    if not drop_empty:
        return known.select(_id(record).alias("id"), _name(record).alias("name"))
    trimmed = known.select(_id(record).alias("id"), F.btrim(text(F.col(record), "name")).alias("name"))
    return trimmed.filter((F.col("id") != 0) & (F.length("name") > 0))


def stages_listing(dim_stages: DataFrame) -> DataFrame:
    """(id, name, normalized_name) by id."""
    listed = dim_stages.select(F.col("stage_id").alias("id"), F.col("stage_name").alias("name"), "normalized_name")
    return listed.orderBy("id")


def upsert_dim(target: DataFrame, source: DataFrame, key: str, now: Column) -> DataFrame:
    """Type-1 upsert: source rows replace target rows of the same key, stamped with `now`.

    `source` must hold each key once.
    """
    fresh = source.withColumn("last_synced_at", now)
    kept = target.join(source.select(key), key, "left_anti")
    return kept.select(*target.columns).unionByName(fresh, allowMissingColumns=True)
