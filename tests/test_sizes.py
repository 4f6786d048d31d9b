"""Whole inputs, and work that is dealt out by the size of the input; tables are made here."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from checks import QUERIES, cases_pipelines, cases_tables, inputs
from funnelwise.operators import validate
from funnelwise.plans import metadata, sync, transform
from funnelwise.schema import BASE_NAMES, deal_schema
from funnelwise.sources import tables
from funnelwise.sources.scratch import keep

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
LINES = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"


def write_orders(spark, folder, keys):
    rows = [(k, k % 7, "O", 100.0 + k, dt.datetime(1995, 1, 1) + dt.timedelta(days=k % 900), f"{1 + k % 5}-X") for k in keys]
    spark.createDataFrame(rows, ORDERS).write.parquet(f"{folder}/orders.parquet")


def test_every_change_is_merged(spark, tmp_path):
    write_orders(spark, tmp_path, range(1, 5))
    lines = [(k, 5, 1, 1, 1.0, 10.0, 0.0, 0.0, "R", "O", dt.datetime(2005, 1, 1)) for k in (2, 3, 9, 100)]
    spark.createDataFrame(lines, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    merged = {r["id"]: r["titulo"] for r in QUERIES["merge_deals_small_source"](spark, str(tmp_path)).collect()}
    assert merged == {"1": "Order 1", "2": "Line 1", "3": "Line 1", "4": "Order 4", "9": "Line 1", "100": "Line 1"}


def test_landed_files_and_their_shares_follow_the_orders(spark, tmp_path, monkeypatch):
    write_orders(spark, tmp_path, range(1, 101))
    spark.createDataFrame([(k, f"c{k}") for k in range(7)], "c_custkey bigint, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    monkeypatch.setattr(cases_tables, "FILE_LINES", 10)
    folder, files = cases_tables.landed(spark, str(tmp_path), files=3)
    lines = spark.read.text(folder).groupBy(F.input_file_name()).count().collect()
    assert files == 10 == len(lines) and max(r["count"] for r in lines) <= 20 and sum(r["count"] for r in lines) == 100
    stats = QUERIES["stream_batch_stats"](spark, str(tmp_path)).first()
    assert stats.fetched == sum(1 + (k % 2 == 0) for k in range(1, 101) if k % 23 and k % 19)


def test_batches_are_dealt_out_by_the_number_of_lines(spark, tmp_path, monkeypatch):
    lines = [(k, 5, 1, n, 1.0, 10.0, 0.0, 0.0, "R", "O", dt.datetime(2005, 1, 1)) for k in range(100) for n in (1, 2)]
    spark.createDataFrame(lines, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(inputs, "TASK_ROWS", 10)
    found = QUERIES["batch_quality"](spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == 20 and found.count() == 200


def test_plan_rows_never_pass_through_the_driver(spark):
    fields = spark.createDataFrame([("a", "Área"), ("b", "area"), ("b", "Zona"), ("c", "Título"), ("d", "***"), ("e", ""), ("value", "x"), (None, "n")], "key string, name string")
    plan = metadata.deal_plan(fields, spark.createDataFrame([(1, "Novo"), (0, "x")], "id bigint, name string"))
    rows = plan.rows()
    assert not {"mapping", "schema", "history"} & set(vars(plan)) and "LocalTableScan" not in rows.filter("part = 'mapping'")._jdf.queryExecution().executedPlan().toString()
    found = {tuple(r) for r in rows.collect()}
    shown = {("mapping", k, c) for k, c in plan.mapping.items()}
    shown |= {("column", f.name, "time" if f.name in plan.history else "text") for f in plan.schema.fields if f.name not in BASE_NAMES}
    assert found == shown and plan.mapping == {"a": "area", "b": "zona", "c": "titulo"} and rows.count() == len(found)


def write_deals(spark, folder, orders):
    write_orders(spark, folder, range(1, orders + 1))
    spark.createDataFrame([(k, f"c{k}") for k in range(7)], "c_custkey bigint, c_name string").write.parquet(f"{folder}/customer.parquet")


def test_orders_are_dealt_out_before_their_records_are_built(spark, tmp_path, monkeypatch):
    write_deals(spark, tmp_path, 100)
    monkeypatch.setattr(inputs, "TASK_ROWS", 10)
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", 65535)
    try:
        records = inputs.load_records(spark, str(tmp_path), "deal_json")
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", 8000)
    assert records.rdd.getNumPartitions() == 10 and records.count() == 100 == records.select("seq").distinct().count()
    shuffled = records._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")[1:]
    assert len(shuffled) == 1 and "parse_json" not in shuffled[0] and "concat" not in shuffled[0]


def test_records_are_judged_and_flattened_in_projections(spark):
    raw = spark.createDataFrame([('{"id": 1, "custom_fields": {"a": {"value": 2}}}',)], "value string").select(F.parse_json("value").alias("record"), F.lit(1).alias("seq"))
    flat = transform.flatten_judged(validate.valid(transform.judge_records(raw)), {"a": "one"}, deal_schema(["one"]))
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    made = [line.split("Generate ")[1] for line in plan.splitlines() if "Generate " in line]
    assert len(made) == 2 and all(m.startswith("inline(array(__made#") for m in made)
    assert [(r.id, r.one) for r in flat.collect()] == [("1", "2")]


def test_a_sync_writes_no_record_that_it_loads(spark, tmp_path, monkeypatch):
    kept, path, bad = [], str(tmp_path / "deals"), str(tmp_path / "rejects")
    schema = deal_schema(["one"])
    tables.write_snapshot(spark.createDataFrame([("7", *[None] * (len(schema) - 1))], schema), path, parts=1)
    monkeypatch.setattr(sync, "keep", lambda df: kept.append(keep(df)) or kept[-1])
    monkeypatch.setattr(sync, "forget", lambda *_: None)
    lines = ['{"id": 1, "update_time": "2024-01-01 00:00:00", "custom_fields": {"a": {"value": 2}}}', '{"id": "x", "update_time": "2025-01-01 00:00:00"}']
    raw = spark.createDataFrame([(x,) for x in lines], "value string").select(F.parse_json("value").alias("record"), F.lit(1).alias("seq"))
    empty = {
        "users": "user_id bigint, user_name string", "persons": "person_id bigint, person_name string", "orgs": "org_id bigint, org_name string",
        "stages": "stage_id bigint, stage_name string, normalized_name string", "pipelines": "pipeline_id bigint, pipeline_name string",
    }
    none = {n: spark.createDataFrame([], s) for n, s in empty.items()}
    row = sync.sync_into_table(path, 1, raw, none, {"a": "one"}, schema, rejects=bad).first()
    assert (row.fetched, row.loaded, row.failed, str(row.watermark)) == (2, 1, 1, "2025-01-01 00:00:01")
    assert not any("variant" in f.dataType.simpleString() for df in kept for f in df.schema.fields)
    assert [r["__rejected"] for r in kept[0].orderBy("id").collect()].count(None) == 1
    assert [(r.record, r.reasons) for r in spark.read.parquet(bad).collect()] == [('{"id":"x","update_time":"2025-01-01 00:00:00"}', ["id: not an integer"])]
    assert [(r.id, r.one) for r in tables.read_table(spark, path, schema=schema).orderBy("id").collect()] == [("1", "2"), ("7", None)]


def test_records_are_read_as_texts(spark):
    lines = [
        '{"id": 1, "title": "a", "owner_id": {"id": 4}, "creator_user_id": {"id": "x"}, "custom_fields": {"a": {"value": 2}, "b": {"value": "v", "country": null, "route": "r"}, "c": [1, 2]}}',
        '{"id": "2.0", "title": 7, "value": true, "stage_id": "true", "pipeline_id": true, "custom_fields": {"a": "s", "b": {"value": null}, "c": null}}',
        '{"id": 1E3, "person_id": {"id": "true"}, "value": "1e999", "add_time": false, "update_time": 10, "custom_fields": [1]}',
        '{"id": "1E3", "currency": "12345678901", "value": {"id": 1}, "person_id": "{", "creator_user_id": {"id": null}, "custom_fields": null}',
        '{"custom_fields": {"a": {}, "b": 5, "c": {"value": {"x": 1}}}}', '[1]', 'null',
    ]
    raw = spark.createDataFrame(list(enumerate(lines)), "k int, value string").select("k", F.parse_json("value").alias("record"))
    judged = transform.judge_records(raw)
    flat = transform.flatten_judged(judged, {"a": "one", "b": "local_do_acidente", "c": "one"}, deal_schema(["one"]))
    read = flat._jdf.queryExecution().optimizedPlan().toString().split("StructField(")
    assert not any("VariantType" in f.split(")")[0] for f in read if not f.startswith("_,"))
    assert [r.reasons for r in judged.orderBy("k").collect()] == [
        ["creator_user_id: not an integer"], ["stage_id: not an integer", "title: not a text"],
        ["person_id: not an integer", "value: not a number", "add_time: not a time", "custom_fields: not an object"],
        ["id: not an integer", "person_id: not an integer", "currency: too long", "value: not a number", "custom_fields: not an object"],
        ["id: missing"], ["id: missing"], ["id: missing"],
    ]
    found = [(r.one, r.local_do_acidente, r.local_do_acidente_nome_da_rua, r.owner_id) for r in flat.orderBy("k").collect()]
    assert found == [("[1,2]", "v", "r", 4), ("s", None, None, None), *[(None,) * 4] * 2, ('{"x":1}', "5", None, None), *[(None,) * 4] * 2]


def test_landed_pages_are_compressed_and_no_line_is_shuffled(spark, tmp_path):
    write_deals(spark, tmp_path, 100)
    folder, files = cases_tables.landed(spark, str(tmp_path), files=3)
    names = spark.read.text(folder).inputFiles()
    assert files == len(names) == 3 and all(n.endswith(".gz") for n in names)
    lines = inputs.load(spark, str(tmp_path), "page_json")
    assert sorted(r.value for r in spark.read.text(folder).collect()) == sorted(r.value for r in lines.select("value").collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = inputs.load(spark, str(tmp_path), "page_json", 5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above, below = plan.split("Exchange", 1)
    assert above.count("concat(") > 1 and plan.count("SortMergeJoin") == 2 and "concat(" not in below


def test_streams_leave_no_landed_pages(spark, tmp_path, monkeypatch):
    write_deals(spark, tmp_path, 100)
    folders, landed = [], cases_tables.landed
    monkeypatch.setattr(cases_pipelines, "landed", lambda *a, **b: folders.append(landed(*a, **b)) or folders[-1])
    read = lambda name: QUERIES[name](spark, str(tmp_path))
    assert read("stream_watermark").count() == 1 and read("stream_batch_stats").first().fetched > 0 and read("stream_deals").count() > 0
    assert len(folders) == 3 and not any(os.path.exists(f.removeprefix("file:")) for f, _ in folders)


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {b for b in (blocks.apply(i).toString() for i in range(blocks.size())) if b.startswith("shuffle")}


def test_kept_and_stored_tables_leave_no_shuffle_files(spark, tmp_path):
    before, path = shuffle_files(spark), str(tmp_path / "deals")
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    rows = spark.range(100).selectExpr("CAST(id AS STRING) AS id", "id % 7 AS n").repartition(3)
    tables.write_snapshot(keep(rows), path, parts=4)
    tables.apply_changes(keep(rows), path, 1, lambda held, source: held.join(source, "id", "left_semi"))
    until = time.time() + 20  # files go a little later
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and spark.conf.get(setting) == "false"
    assert tables.read_table(spark, path).count() == 100


def no_dims(spark):
    empty = {
        "users": "user_id bigint, user_name string", "persons": "person_id bigint, person_name string", "orgs": "org_id bigint, org_name string",
        "stages": "stage_id bigint, stage_name string, normalized_name string", "pipelines": "pipeline_id bigint, pipeline_name string",
    }
    return {n: spark.createDataFrame([], s) for n, s in empty.items()}


def test_a_sync_drops_the_judged_records_before_it_merges(spark, tmp_path, monkeypatch):
    kept, seen, path = [], [], str(tmp_path / "deals")
    schema = deal_schema(["one"])
    tables.write_snapshot(spark.createDataFrame([("7", *[None] * (len(schema) - 1))], schema), path, parts=1)
    there = lambda: [os.path.exists(df.inputFiles()[0].removeprefix("file://")) for df in kept]
    monkeypatch.setattr(sync, "keep", lambda df: kept.append(keep(df)) or kept[-1])
    apply = sync.apply_changes
    monkeypatch.setattr(sync, "apply_changes", lambda *a, **b: seen.append(there()) or apply(*a, **b))
    raw = spark.createDataFrame([('{"id": 1, "update_time": "2024-01-01 00:00:00"}',)], "value string").select(F.parse_json("value").alias("record"), F.lit(1).alias("seq"))
    assert sync.sync_into_table(path, 1, raw, no_dims(spark), {"a": "one"}, schema).first().loaded == 1
    assert seen == [[False, True]] and there() == [False, False]
