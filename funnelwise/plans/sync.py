"""Incremental sync of deals and dimensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.records import compute_once, get, plain_id, text, whole_number
from ..functions.values import safe_timestamp
from ..operators import dimensions as D
from ..operators.merge import latest_per_id, merge_deals
from ..operators.run_log import next_watermark, summary_row
from ..operators.validate import validate_deals
from ..sources.scratch import forget, keep
from ..sources.tables import add_columns, apply_changes, table_schema
from .transform import flatten_judged, given_columns, judge_records, transform_deals, transform_flat


def records_since(raw: DataFrame, since: Column | None, record: str = "record") -> DataFrame:
    """Raw records updated at or after `since` (all if None)."""
    if since is None:
        return raw
    timed = compute_once(raw, {"__time": safe_timestamp(text(F.col(record), "update_time"))})
    return timed.filter(F.col("__time") >= since).drop("__time")


def sync_deals(
    target: DataFrame,
    raw: DataFrame,
    dims: dict[str, DataFrame],
    mapping: dict[str, str],
    schema: T.StructType,
    since: Column | None = None,
    history: str = "overwrite",
    seq: list[str] | None = None,
    record: str = "record",
) -> tuple[DataFrame, DataFrame]:
    """Merge raw records into the table -> (merged table, one-row run summary with watermark)."""
    fetched = records_since(raw, since, record)
    batch = transform_deals(fetched, dims, mapping, schema, record, seq or ["seq"])
    merged = merge_deals(target, batch, history)
    return merged, sync_summary(fetched, record)


def sync_summary(fetched: DataFrame, record: str = "record") -> DataFrame:
    """Counts, status and next watermark of a sync that loads the newest record of each id, as one row.

    Every record is read and judged once.
    """
    good, time = F.size("reasons") == 0, safe_timestamp(text(F.col(record), "update_time"))
    judged = validate_deals(fetched, record).select(
        good.alias("good"), time.alias("time"), F.when(good, plain_id(text(F.col(record), "id"), F.col(record), "id")).alias("id")
    )
    counts = judged.agg(
        F.count("*").alias("fetched"), F.count_if(~F.col("good")).alias("failed"), F.count_distinct("id").alias("loaded"), F.max("time").alias("newest")
    )
    return summary_row(counts).withColumn("watermark", F.when(F.col("loaded") > 0, next_watermark("newest"))).drop("newest")


def stored_watermark(spark: SparkSession, summaries: str) -> Column:
    """Where the next sync starts: the newest watermark among the summaries that runs have left; NULL before any."""
    return F.lit(spark.read.parquet(summaries).agg(F.max("watermark")).first()[0])


def sync_into_table(
    path: str,
    number: int,
    raw: DataFrame,
    dims: dict[str, DataFrame],
    mapping: dict[str, str],
    schema: T.StructType,
    history: str = "overwrite",
    seq: list[str] | None = None,
    evolve: bool = False,
    rejects: str | None = None,
    failed: Callable[[DataFrame], None] | None = None,
    record: str = "record",
) -> DataFrame:
    """Transform raw records and append the merged rows of their ids as write `number` of a stored table -> run summary.

    The raw records are read, judged and flattened once, and written with the verdict; rows to load, rejected ones and counts all come from
    there. Of the records themselves only rejected ones are written, and only for `rejects`. (Counts of observed metrics would do without, but count a task twice that runs again after its executor is lost.) With
    `evolve`, custom columns that hold a value in this batch and are not in the table are added to it. `rejects` is where rejected
    records go, with their reasons. A run that breaks off gives `failed` its summary, in which nothing is loaded, and raises.
    """
    spark = raw.sparkSession
    given, seen = given_columns(raw, record), judge_records(raw, record)
    bad = F.col("__reasons")
    seen = seen.withColumn("__reasons", F.when(F.size("reasons") > 0, F.col("reasons")))
    if rejects is not None:
        seen = seen.withColumn("__rejected", F.when(bad.isNotNull(), F.to_json(F.col(record))))
    judged = keep(flatten_judged(seen, mapping, table_schema(spark, path, schema, before=number), record).drop(record))
    counts = judged.agg(F.count("*").alias("fetched"), F.count("__reasons").alias("failed"), F.max("update_time").alias("newest")).withColumn("loaded", F.lit(0).cast("long"))
    counts = spark.createDataFrame(counts.collect(), counts.schema)
    try:
        try:
            if rejects is not None:
                rejected = judged.filter(bad.isNotNull()).select(F.col("__rejected").alias("record"), bad.alias("reasons"))
                rejected.write.mode("overwrite").parquet(f"{rejects}/write={number}")
            known = table_schema(spark, path, schema, before=number)
            flat = judged.filter(bad.isNull()).drop("__reasons", "__rejected")
            prepared = keep(transform_flat(flat, given, dims, known, seq or ["seq"], evolve))
        finally:
            forget(judged)  # before the merge, which needs the disk
        declared = {f.name for f in known.fields}
        more = [f for f in prepared.schema.fields if f.name not in declared]
        if more:
            held = prepared.agg(*[F.count(f.name).alias(f.name) for f in more]).first()
            more = [f for f in more if held[f.name]]
            add_columns(spark, path, number, more)
        wide = T.StructType([*known.fields, *more])
        source = prepared.select([f.name for f in wide.fields])
        apply_changes(source, path, number, lambda t, s: merge_deals(t, s, history), schema=wide)
        loaded = prepared.count()
    except Exception as error:
        if failed is not None:
            failed(summary_row(counts, str(error)).drop("newest"))
        raise
    forget(prepared)
    row = summary_row(counts.withColumn("loaded", F.lit(loaded).cast("long")))
    return row.withColumn("watermark", F.when(F.col("loaded") > 0, next_watermark("newest"))).drop("newest")


# Entity -> (key, mapper).
DIMENSIONS = {
    "users": ("user_id", D.dim_users),
    "persons": ("person_id", D.dim_persons),
    "stages": ("stage_id", D.dim_stages),
    "pipelines": ("pipeline_id", D.dim_pipelines),
    "orgs": ("org_id", D.dim_orgs),
}


def newest_entity_rows(raw: DataFrame, entity: str, seq: list[str], record: str = "record") -> DataFrame:
    """Mapped dimension rows, the last arrival of each id."""
    key, mapper = DIMENSIONS[entity]
    last = latest_per_id(
        raw.withColumn("__id", whole_number(get(F.col(record), "id"))).filter(F.col("__id").isNotNull()), "__id", seq[0], seq[1:] or seq
    )
    return mapper(last, record)


def sync_dimensions(
    targets: dict[str, DataFrame], raws: dict[str, DataFrame], now: Column, seq: list[str] | None = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Upsert raw entity records into each dimension -> (tables, counts per entity)."""
    tables, counts = {}, None
    for entity, raw in raws.items():
        rows = newest_entity_rows(raw, entity, seq or ["seq"])
        tables[entity] = D.upsert_dim(targets[entity], rows, DIMENSIONS[entity][0], now)
        count = rows.agg(F.count("*").alias("records")).select(F.lit(entity).alias("entity_type"), "records")
        counts = count if counts is None else counts.unionByName(count)
    return tables, counts
