"""Enriching deals from dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import UNKNOWN_NAME
from .sizing import attach

# Dimension -> deal columns that refer to it.
REFERENCES = {
    "users": ["creator_user_id", "owner_id"],
    "persons": ["person_id"],
    "stages": ["stage_id"],
    "pipelines": ["pipeline_id"],
    "orgs": ["org_id"],
}


def enrich_deals(
    deals: DataFrame,
    users: DataFrame,
    persons: DataFrame,
    stages: DataFrame,
    pipelines: DataFrame,
    orgs: DataFrame,
    unknown: str = UNKNOWN_NAME,
) -> DataFrame:
    """Add the six display names; a missing row or name gives `unknown`.

    Stages contribute their slug. Each dimension must hold its key once. Six joins on one lineage.
    """
    slug = F.nullif(F.col("normalized_name"), F.lit(""))
    lookups = [
        (users, "creator_user_id", "user_id", "creator_user_name", F.col("user_name")),
        (users, "owner_id", "user_id", "owner_name", F.col("user_name")),
        (stages, "stage_id", "stage_id", "stage_name", slug),
        (pipelines, "pipeline_id", "pipeline_id", "pipeline_name", F.col("pipeline_name")),
        (persons, "person_id", "person_id", "person_name", F.col("person_name")),
        (orgs, "org_id", "org_id", "org_name", F.col("org_name")),
    ]
    for table, key, table_key, name, source in lookups:
        deals = attach(deals, table, key, table_key, {name: source})
    return deals.withColumns({n: F.coalesce(F.col(n), F.lit(unknown)) for *_, n, _ in lookups})


def needed_ids(deals: DataFrame) -> DataFrame:
    """Distinct (dim, id) pairs the deals refer to, in one scan."""
    pairs = [F.struct(F.lit(d).alias("dim"), F.col(c).cast("bigint").alias("id")) for d, cols in REFERENCES.items() for c in cols]
    return deals.select(F.inline(F.array(*pairs))).filter(F.col("id").isNotNull()).distinct()


def lookup_subset(dim: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Dimension rows whose key is among `ids(id)`."""
    return dim.join(ids.select(F.col("id").alias(key)), key, "left_semi").select(*dim.columns)


def lookup_coverage(deals: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(dim, needed, found, missing) for each dimension: name -> (table, key)."""
    sides = needed_ids(deals).select("dim", "id", F.lit(1).alias("wanted"), F.lit(0).alias("held"))
    for name, (table, key) in dims.items():
        held = table.select(F.lit(name).alias("dim"), F.col(key).cast("bigint").alias("id"))
        sides = sides.unionByName(held.withColumns({"wanted": F.lit(0), "held": F.lit(1)}))
    by_id = sides.groupBy("dim", "id").agg(F.max("wanted").alias("wanted"), F.max("held").alias("held"))
    wanted = by_id.filter(F.col("wanted") == 1).groupBy("dim")
    counts = wanted.agg(F.count("*").alias("needed"), F.sum("held").cast("bigint").alias("found"))
    return counts.withColumn("missing", F.col("needed") - F.col("found"))
