"""Shape of the physical plans, and streams across restarts."""

from pyspark.sql import functions as F

from checks.cases_fields import MAPPING
from checks.cases_pipelines import SCHEMA
from checks.cases_tables import at, dims
from checks.inputs import load, load_records
from funnelwise.operators import api_log, lookups, merge, quality, scan
from funnelwise.operators.histograms import counter_increase
from funnelwise.operators.history import stage_entries
from funnelwise.plans import sync, transform
from funnelwise.sources import pages, tables
from funnelwise.streaming import streams

SF_DIR = "/root/testdata/sf0.001"

def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_incremental_scan_pushes_its_filter(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").withColumnRenamed("ts", "update_time")
    assert "GreaterThanOrEqual(ts" in plan(scan.incremental_scan(events, at("2024-01-10 00:00:00")))


def test_merge_shuffles_each_side_once(spark):
    target = load(spark, SF_DIR, "deals")
    source = target.withColumn("value", F.lit(1).cast("decimal(18,2)"))
    assert plan(merge.merge_deals(target, source)).count("Exchange hashpartitioning") == 2


def test_large_dimensions_cost_one_join_each(spark):
    large = {n: t.hint("merge") for n, t in dims(spark, SF_DIR).items()}
    text = plan(lookups.enrich_deals(load(spark, SF_DIR, "deals"), **large))
    assert text.count("SortMergeJoin") == 6 and text.count("FileScan") <= 7 and text.count("orders.parquet") <= 2


def test_transform_reads_records_once_and_shuffles_finished_columns(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(transform.transform_deals(load_records(spark, SF_DIR, "deal_json"), dims(spark, SF_DIR), MAPPING, SCHEMA, seq=["seq"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("orders.parquet") <= 2 and text.count("Generate inline") <= 6
    ranked = transform.transform_deals(load_records(spark, SF_DIR, "deal_json"), dims(spark, SF_DIR), MAPPING, SCHEMA, seq=["seq"])
    below = ranked._jdf.queryExecution().optimizedPlan().toString().split("Window [row_number")[1].split("Generate")[0]
    assert "record#" not in below and "__text#" not in below


def test_reports_read_each_side_once(spark):
    source, target = (load(spark, SF_DIR, "deals") for _ in range(2))
    quality.data_quality_report(source, target, at("2001-01-01 00:00:00"), fields=["value"])
    text = plan(api_log.token_cost_by_endpoint(load(spark, SF_DIR, "api_calls")))
    assert text.count("FileScan") == 1


def test_later_fetch_wins_although_its_pages_restart(spark, tmp_path):
    page = '{"entity": "users", "page_no": %d, "success": true, "data": [{"id": 1, "name": "%s"}]}'
    times = [("2024-01-01 00:00:00", page % (5, "stale")), ("2024-01-02 00:00:00", page % (1, "fresh"))]
    lines = spark.createDataFrame(times, "landed_at string, value string")
    rows = sync.newest_entity_rows(pages.page_records(pages.parse_pages(lines)), "users", ["seq"])
    assert [r.user_name for r in rows.collect()] == ["fresh"]
    many = '{"entity": "users", "page_no": 1, "success": true, "data": [%s]}' % ", ".join('{"id": %d, "name": "%s"}' % (i % 3, i) for i in range(30))
    rows = sync.newest_entity_rows(pages.page_records(pages.parse_pages(spark.createDataFrame([(many,)], "value string"))), "users", ["seq"])
    assert sorted(r.user_name for r in rows.collect()) == ["27", "28", "29"]


def test_watermark_stays_if_nothing_was_loaded(spark, tmp_path):
    land, out, marks = (str(tmp_path / n) for n in ("land", "out", "marks"))
    good = '{"id": 1, "update_time": "2024-01-01 00:00:00"}'
    bad = '{"id": "x", "update_time": "2030-01-01 00:00:00"}'
    for batch in ([good, bad.replace("2030", "2023")], [bad]):
        spark.createDataFrame([(b,) for b in batch], "value string").coalesce(1).write.mode("append").text(land)
        stream = spark.readStream.text(land).select(F.parse_json("value").alias("record"))
        streams.stream_watermark(stream, out, marks).awaitTermination()
    assert str(streams.read_watermark(spark, out).first()[0]) == "2024-01-01 00:00:01"


def test_stream_restarts_with_late_shuffled_and_repeated_files(spark, tmp_path):
    shape = "deal_id long, field_key string, new_value string, time string"
    catalog = spark.createDataFrame([(1, "moved_to_stage_a_1"), (2, "moved_to_stage_b_2")], "stage_id long, column string")
    land, out, marks = (str(tmp_path / n) for n in ("land", "out", "marks"))
    batches = [
        [(1, "stage_id", "1", "2024-01-05 00:00:00"), (2, "stage_id", "2", "2024-01-09 00:00:00")],
        [(1, "stage_id", "1", "2024-01-02 00:00:00"), (1, "stage_id", "2", "2024-01-03 00:00:00")],
        [(1, "stage_id", "1", "2024-01-05 00:00:00"), (2, "stage_id", "2", "2024-01-01 00:00:00")],
    ]
    for batch in batches:
        spark.createDataFrame(batch, shape).coalesce(1).write.mode("append").parquet(land)
        stream = spark.readStream.schema(shape).parquet(land)
        streams.stream_first_entry(stream, catalog, out, marks).awaitTermination()
    log = spark.read.parquet(land)
    want = stage_entries(log, catalog).groupBy("deal_id", "column").agg(F.min("ts").alias("ts"))
    got = streams.read_first_entry(spark, out)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    stored = spark.read.parquet(out)
    assert stored.count() == stored.select("deal_id", "column").distinct().count(), "a read touches one row for each deal and stage"


def test_first_entries_are_kept_in_a_state_store(spark, tmp_path):
    shape = "deal_id long, field_key string, new_value string, time string"
    catalog = spark.createDataFrame([(1, "moved_to_stage_a_1")], "stage_id long, column string")
    land, out, marks = (str(tmp_path / n) for n in ("land", "out", "marks"))
    spark.createDataFrame([(i, "stage_id", "1", "2024-01-05 00:00:00") for i in range(1, 50)], shape).coalesce(1).write.mode("append").parquet(land)
    query = streams.stream_first_entry(spark.readStream.schema(shape).parquet(land), catalog, out, marks)
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 49
    assert any("rocksdb" in k.lower() for k in query.lastProgress["stateOperators"][0]["customMetrics"])
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.createDataFrame([(1, "stage_id", "1", "2024-01-01 00:00:00"), (2, "stage_id", "1", "2024-01-09 00:00:00")], shape).coalesce(1).write.mode("append").parquet(land)
    query = streams.stream_first_entry(spark.readStream.schema(shape).parquet(land), catalog, out, marks)
    query.awaitTermination()
    got = {r.deal_id: r.ts.day for r in streams.read_first_entry(spark, out).collect()}
    assert got == {1: 1, **{i: 5 for i in range(2, 50)}}


def test_streamed_increase_equals_batch_across_restarts_resets_and_late_samples(spark, tmp_path):
    land, out, marks = (str(tmp_path / n) for n in ("land", "out", "marks"))
    shape = "series string, ts timestamp, value double"
    at = lambda m: f"2024-01-01 {10 + m // 60}:{m % 60:02d}:00"
    batches = [
        [("a", at(0), 10.0), ("a", at(7), 15.0), (None, at(1), 1.0)],
        [("a", at(20), 3.0), ("a", at(3), 12.0), (None, at(30), 5.0), ("b", at(2), 7.0)],
        [("a", at(12), 18.0), ("a", at(12), 18.0), ("a", at(90), 30.0), (None, at(29), 9.0)],
        [("a", at(60), 2.0), ("b", at(200), 9.0), ("c", at(5), 1.0)],
        [("a", at(1), 99.0), ("a", at(91), 31.0), ("b", at(1), 99.0)],
    ]
    for batch in batches:
        rows = spark.createDataFrame([(s, t, v) for s, t, v in batch], "series string, t string, value double")
        rows.select("series", F.col("t").cast("timestamp").alias("ts"), "value").coalesce(1).write.mode("append").parquet(land)
        stream = spark.readStream.schema(shape).parquet(land)
        streams.stream_counter_increase(stream, out, marks, lateness="1 hour", fold_every=2).awaitTermination()
    late = [("a", at(1)), ("b", at(1))]  # more than an hour before the newest sample of their series
    kept = [r for batch in batches for r in batch if r[:2] not in late]
    samples = spark.createDataFrame(kept, "series string, t string, value double").select("series", F.col("t").cast("timestamp").alias("ts"), "value")
    want = {(r.series, r.bucket): r.increase for r in counter_increase(samples).collect()}
    assert {(r.series, r.bucket): r.increase for r in streams.read_counter_increase(spark, out).collect()} == want
    assert len(tables.subfolders(spark, f"{out}/buckets")) == 3, "folded batches are gone"
    state = spark.read.parquet(f"{out}/state")
    assert state.filter("batch = 4 AND series = 'a'").count() == 4, "the last hour from a whole bucket on, and the sample before"


def test_a_sync_reads_raw_once_keeps_rejects_and_adds_columns(spark, tmp_path):
    from checks.cases_pipelines import NARROW, held_deals

    path, bad, land = (str(tmp_path / n) for n in ("deals", "rejects", "land"))
    tables.write_snapshot(held_deals(spark, SF_DIR).select([f.name for f in NARROW.fields]), path)
    plain = '{"id": %d, "title": "t", "update_time": "2030-01-01 00:00:00"}'
    custom = '{"id": %d, "title": "t", "update_time": "2030-01-02 00:00:00", "custom_fields": {"f2": {"value": 7}}}'
    read = spark.sparkContext.accumulator(0)

    def raw(*lines):
        counted = spark.createDataFrame([(line,) for line in lines], "value string").rdd.map(lambda r: (read.add(1), r[0])[1])
        return spark.createDataFrame(counted, "string").select(F.parse_json("value").alias("record"), F.lit(1).alias("seq"))

    summary = sync.sync_into_table(path, 1, raw(plain % 900001, plain % 900002, '{"id": "x"}'), dims(spark, SF_DIR), MAPPING, NARROW, evolve=True, rejects=bad)
    row = summary.first()
    assert (row.fetched, row.validated, row.loaded, row.failed, row.status, str(row.watermark)) == (3, 2, 2, 1, "success", "2030-01-01 00:00:01")
    assert read.value == 3, "each raw record was read once"
    assert [(r.record, r.reasons) for r in spark.read.parquet(bad).collect()] == [('{"id":"x"}', ["id: not an integer"])]
    assert tables.table_schema(spark, path, NARROW) == NARROW, "no value of a new column yet"
    sync.sync_into_table(path, 2, raw(custom % 900002), dims(spark, SF_DIR), MAPPING, NARROW, evolve=True)
    wide = tables.table_schema(spark, path, NARROW)
    assert [f.name for f in wide.fields[len(NARROW.fields):]] == ["pontos"]
    assert tables.table_schema(spark, path, NARROW, before=2) == NARROW
    got = {r.id: r.pontos for r in tables.read_table(spark, path, schema=wide).filter("id like '90000_' or pontos is not null").collect()}
    assert got == {"900001": None, "900002": "7"}
    tables.fold_changes(spark, path, 2, schema=wide)
    assert {r.id: r.pontos for r in tables.read_table(spark, path, schema=wide).filter("id like '90000_'").collect()} == got


def test_a_broken_run_leaves_its_summary(spark, tmp_path):
    reports = []
    raw = spark.createDataFrame([('{"id": 1}',)], "value string").select(F.parse_json("value").alias("record"), F.lit(1).alias("seq"))
    try:
        sync.sync_into_table(str(tmp_path / "nowhere"), 1, raw, dims(spark, SF_DIR), MAPPING, SCHEMA, failed=lambda s: reports.append(s.first()))
    except Exception:  # noqa: BLE001 - any error of the run
        pass
    assert [(r.fetched, r.loaded, r.failed, r.status) for r in reports] == [(1, 0, 1, "error")] and "Critical ETL failure" in reports[0].message
