"""Continuous sync, history, dimensions and metrics.

Every stream runs through `foreachBatch` with a checkpoint. What a batch writes is in a folder of the
batch's number, so a batch replayed after a failure replaces what it wrote before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.endpoints import normalize_endpoint
from ..functions.records import text
from ..functions.values import safe_timestamp
from ..operators.dimensions import upsert_dim
from ..operators.histograms import counter_increase
from ..operators.history import stage_entries
from ..operators.merge import latest_per_id
from ..operators.ordered import join_same
from ..operators.validate import validate_deals
from ..plans.sync import DIMENSIONS, newest_entity_rows, sync_into_table
from ..sources.pages import page_records, parse_pages, with_landing_time
from ..sources.scratch import delete, forget, keep, subfolders
from ..sources.tables import apply_changes, fold_changes, table_schema

#: Micro-batches after which the changes of a stored table are gathered in one folder.
FOLD_EVERY = 64


def stream_deals(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """Records of page files as they land under `path`, at most `max_files` per micro-batch."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
    return page_records(parse_pages(with_landing_time(lines)))


def _start(stream: DataFrame, each, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def stream_sync(
    stream: DataFrame,
    path: str,
    dims: dict[str, DataFrame],
    mapping: dict[str, str],
    schema: T.StructType,
    checkpoint: str,
    history: str = "overwrite",
    summaries: str | None = None,
    trigger: dict | None = None,
    fold_every: int = FOLD_EVERY,
    evolve: bool = False,
    rejects: str | None = None,
) -> StreamingQuery:
    """Transform each micro-batch and merge it into the table at `path`; older updates never win.

    Micro-batch k is write k + 1 of the table, so a replay takes its own place. A batch reads the partitions of its own ids
    only, and every `fold_every` batches the changes so far are gathered in one folder. With `summaries`, each batch
    leaves its counts, status and watermark there, one that breaks off the error, until it succeeds. `evolve` and `rejects` are those of
    sync_into_table.
    """
    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        _fold(spark, path, number, fold_every, "id", table_schema(spark, path, schema))

        def report(summary: DataFrame) -> None:
            if summaries is not None:
                shaped = summary if "watermark" in summary.columns else summary.withColumn("watermark", F.lit(None).cast("timestamp"))
                shaped.write.mode("overwrite").parquet(f"{summaries}/batch={number}")

        report(sync_into_table(path, number + 1, batch, dims, mapping, schema, history, evolve=evolve, rejects=rejects, failed=report))

    return _start(stream, each, checkpoint, trigger)


def _fold(spark: SparkSession, path: str, number: int, every: int, key: str, schema: T.StructType | None = None) -> None:
    """Before a batch that is a multiple of `every`: fold the writes of all batches before it, which are final, and drop those an earlier fold holds."""
    if number and number % every == 0:
        fold_changes(spark, path, number, key, schema, drop_below=number - every + 1)


def stream_watermark(stream: DataFrame, path: str, checkpoint: str, record: str = "record", trigger: dict | None = None) -> StreamingQuery:
    """Keep the newest update_time and the valid records of each micro-batch under `path`, one folder per batch."""

    def each(batch: DataFrame, number: int) -> None:
        time = safe_timestamp(text(F.col(record), "update_time"))
        newest = validate_deals(batch, record).agg(F.max(time).alias("newest"), F.count_if(F.size("reasons") == 0).alias("loaded"))
        newest.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _start(stream, each, checkpoint, trigger)


def read_watermark(spark: SparkSession, path: str) -> DataFrame:
    """Newest time over the batches that loaded something plus one second, as the batch watermark has it."""
    newest = F.max(F.when(F.col("loaded") > 0, F.col("newest"))) + F.expr("INTERVAL '1' SECOND")
    return spark.read.parquet(path).agg(F.date_trunc("second", newest).alias("watermark"))


_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def stream_first_entry(changelog: DataFrame, catalog: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, parts: int = 64) -> StreamingQuery:
    """Keep the earliest entry of each deal and stage in the table at `path`, one row for each.

    The minima are streaming state, in RocksDB beside the checkpoint, so they need no watermark and late entries count. In update mode a
    micro-batch gives only the minima that it lowers; the table's partitions, by a hash of the deal, that hold these are
    written anew, and a replayed batch writes the same.
    """
    spark = changelog.sparkSession
    before = spark.conf.get(_PROVIDER)
    first = stage_entries(changelog, catalog).groupBy("deal_id", "column").agg(F.min("ts").alias("ts"))

    def each(batch: DataFrame, number: int) -> None:
        lowered = keep(batch.withColumn("part", F.pmod(F.xxhash64("deal_id"), F.lit(parts)).cast("int")))
        rows = lowered
        if subfolders(batch.sparkSession, path):
            touched = lowered.select("part").filter("part >= 0").distinct()  # at most `parts` numbers
            rows = rows.unionByName(batch.sparkSession.read.schema(lowered.schema).parquet(path).join(F.broadcast(touched), "part", "left_semi"))
        merged = keep(rows.groupBy("part", "deal_id", "column").agg(F.min("ts").alias("ts")))
        merged.write.partitionBy("part").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
        forget(lowered, merged)

    spark.conf.set(_PROVIDER, _ROCKSDB)  # the query takes the settings of its start
    try:
        writer = first.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()
    finally:
        spark.conf.set(_PROVIDER, before)


def read_first_entry(spark: SparkSession, path: str) -> DataFrame:
    """Earliest entry of each deal and stage so far."""
    return spark.read.parquet(path).select("deal_id", "column", "ts")


def stream_dim_sync(stream: DataFrame, entity: str, path: str, now: Column, checkpoint: str, trigger: dict | None = None, fold_every: int = FOLD_EVERY) -> StreamingQuery:
    """Upsert one entity's raw records into its dimension at `path`; micro-batch k is write k + 1. Changes are folded as in stream_sync."""
    key = DIMENSIONS[entity][0]

    def each(batch: DataFrame, number: int) -> None:
        _fold(batch.sparkSession, path, number, fold_every, key)
        rows = keep(newest_entity_rows(batch, entity, ["seq"]).withColumn("last_synced_at", now))
        apply_changes(rows, path, number + 1, lambda t, s: upsert_dim(t, s, key, F.col("last_synced_at")), key)
        forget(rows)

    return _start(stream, each, checkpoint, trigger)


def stream_batch_stats(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep rows in, valid and failed of each micro-batch under `path`."""

    def each(batch: DataFrame, number: int) -> None:
        bad = F.size("reasons") > 0
        stats = validate_deals(batch).agg(F.count("*").alias("fetched"), F.count_if(~bad).alias("valid"), F.count_if(bad).alias("failed"))
        stats.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _start(stream, each, checkpoint, trigger)


def api_metrics(calls: DataFrame, bucket: str = "5 minutes") -> DataFrame:
    """Calls, errors and seconds per time bucket and endpoint; batch or stream."""
    labelled = calls.withColumn("endpoint", normalize_endpoint(F.col("url")))
    return labelled.groupBy(F.window("ts", bucket), "endpoint").agg(
        F.count("*").alias("calls"), F.count_if(F.col("outcome") != "ok").alias("errors"), F.sum("duration_s").alias("total_s")
    )


def stream_api_metrics(
    calls: DataFrame, path: str, checkpoint: str, bucket: str = "5 minutes", lateness: str = "1 hour", trigger: dict | None = None, fold_every: int = FOLD_EVERY
) -> StreamingQuery:
    """Keep the time buckets of the call log that each micro-batch changes under `path`, open ones too.

    Every `fold_every` batches the last states of all buckets are gathered in one folder. Calls later than `lateness` are left out, and buckets older than that leave the state.
    """
    metrics = api_metrics(calls.withWatermark("ts", lateness), bucket)
    rows = metrics.select(F.col("window.start").alias("bucket"), "endpoint", "calls", "errors", "total_s")

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
        if number and number % fold_every == 0:
            _fold_newest(batch.sparkSession, path, number, fold_every, ["bucket", "endpoint"])

    writer = rows.writeStream.outputMode("update").foreachBatch(each)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_api_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The last state of each time bucket and endpoint."""
    last = F.max_by(F.struct("calls", "errors", "total_s"), "batch").alias("last")
    return spark.read.parquet(path).groupBy("bucket", "endpoint").agg(last).select("bucket", "endpoint", "last.*")


def stream_counter_increase(
    samples: DataFrame, path: str, checkpoint: str, bucket: str = "5 minutes", lateness: str = "1 hour", trigger: dict | None = None, fold_every: int = FOLD_EVERY
) -> StreamingQuery:
    """Keep the growth of counters per time bucket under `path`, as counter_increase has it over all samples.

    A small table is carried from one micro-batch to the next: of each series the samples of the last `lateness`, from a whole bucket on, and
    the one before them. A late sample of that time changes the steps around it, so the buckets from there on are given
    anew; an older one is left out. State and buckets have a folder for each batch, and a replayed batch starts from the state before it.
    """
    def each(batch: DataFrame, number: int) -> None:
        spark, fresh = batch.sparkSession, batch.select("series", "ts", "value")
        shape = T.StructType([*fresh.schema.fields, T.StructField("horizon", T.TimestampType())])
        held = spark.createDataFrame([], shape)
        if number:
            held = spark.read.schema(shape).parquet(f"{path}/state/batch={number - 1}")
        horizons = held.groupBy("series").agg(F.max("horizon").alias("horizon"))
        timely = join_same(fresh, horizons, ["series"], "left").filter(F.col("horizon").isNull() | (F.col("ts") >= F.col("horizon")))
        known = keep(held.unionByName(timely.filter("ts IS NOT NULL")))
        grown = join_same(counter_increase(known, bucket), horizons, ["series"], "left").filter(F.col("horizon").isNull() | (F.col("bucket") >= F.col("horizon")))
        grown.drop("horizon").write.mode("overwrite").parquet(f"{path}/buckets/batch={number}")
        latest = known.groupBy("series").agg(F.max("horizon").alias("old"), F.max("ts").alias("newest"))
        start = F.window(F.col("newest") - F.expr(f"INTERVAL {lateness}"), bucket)["start"]
        moved = latest.withColumn("start", start).select("series", F.greatest("old", "start").alias("horizon"))
        aged = join_same(known.drop("horizon"), moved, ["series"])
        before = latest_per_id(aged.filter("ts < horizon"), "series", "ts", ["value"])
        aged.filter("ts >= horizon").unionByName(before).write.mode("overwrite").parquet(f"{path}/state/batch={number}")
        forget(known)
        delete(spark, f"{path}/state/batch={number - 2}")
        if number and number % fold_every == 0:
            _fold_newest(spark, f"{path}/buckets", number, fold_every, ["series", "bucket"])

    return _start(samples, each, checkpoint, trigger)


def _newest(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """The row of the last batch for each key, with `batch`."""
    return latest_per_id(spark.read.parquet(folder).withColumn("key", F.struct(*keys)), "key", "batch", keys[:1]).drop("key")


def _fold_newest(spark: SparkSession, folder: str, number: int, every: int, keys: list[str]) -> None:
    """Gather the newest rows of all batches before the last one, which is final, there, and delete the folders that an earlier fold has gathered.

    What the last batch has itself stays; a repeated fold appends rows that are equal to those there.
    """
    old = _newest(spark, folder, keys).filter(F.col("batch") < number - 1).drop("batch")
    old.write.mode("append").parquet(f"{folder}/batch={number - 1}")
    for name in subfolders(spark, folder):
        if int(name.partition("=")[2]) < number - every:
            delete(spark, f"{folder}/{name}")


def read_counter_increase(spark: SparkSession, path: str) -> DataFrame:
    """(series, bucket, increase, rate): the last state of each bucket."""
    return _newest(spark, f"{path}/buckets", ["series", "bucket"]).drop("batch")
