"""Merging, storing, looking up: edge cases, skew and properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from funnelwise.operators import catalogs, history, merge, ordered
from funnelwise.operators.histograms import counter_increase, exact_quantiles, sliding_increase
from funnelwise.operators.quality import reconcile_ids
from funnelwise.operators.scan import point_lookup
from funnelwise.operators.sizing import attach
from funnelwise.sources import pages, tables

T = lambda day: dt.datetime(2024, 1, day)
SHAPE = "id string, v string, add_time timestamp, update_time timestamp, moved_to_stage_a_1 timestamp"
TARGET = [("eq", "old", T(1), T(5), T(2)), ("newer", "old", None, T(5), None), ("older", "old", T(1), T(5), None), ("tnull", "old", T(1), None, None),
          ("snull", "old", T(1), T(5), None), ("alone", "old", T(1), T(5), None)]
SOURCE = [("eq", "new", T(3), T(5), None), ("newer", "new", T(3), T(6), T(3)), ("older", "new", T(3), T(4), None), ("tnull", "new", T(3), None, None),
          ("snull", "new", T(3), None, None), ("insert", "new", T(3), T(1), None)]


def rows(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_merge_rule(spark):
    t, s = spark.createDataFrame(TARGET, SHAPE), spark.createDataFrame(SOURCE, SHAPE)
    got = rows(merge.merge_deals(t, s))
    assert {k: v[0] for k, v in got.items()} == {"eq": "new", "newer": "new", "older": "old", "tnull": "new", "snull": "old", "alone": "old", "insert": "new"}
    assert got["eq"] == ("new", T(1), T(5), None) and got["newer"] == ("new", T(3), T(6), T(3))
    kept = rows(merge.merge_deals(t, s, history="preserve"))
    assert kept["eq"][3] == T(2) and kept["newer"][3] == T(3)


def test_merge_is_idempotent_and_order_free(spark):
    t, s = spark.createDataFrame(TARGET, SHAPE), spark.createDataFrame(SOURCE, SHAPE)
    later = s.filter("update_time IS NOT NULL").withColumns({"v": F.lit("last"), "update_time": F.col("update_time") + F.expr("INTERVAL 30 DAYS")})
    s = s.filter("update_time IS NOT NULL")
    once = merge.merge_deals(t, s)
    assert rows(merge.merge_deals(once, s)) == rows(once)
    assert {k: v[0] for k, v in rows(merge.merge_deals(once, later)).items()} == {k: v[0] for k, v in rows(merge.merge_deals(merge.merge_deals(t, later), s)).items()}


def test_new_records_keep_null_ids(spark):
    source = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    assert {r[0] for r in merge.new_records(source, spark.createDataFrame([("1",)], "id string")).collect()} == {2, None}


def test_latest_per_id_with_a_third_of_rows_on_one_id(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"), F.col("id").alias("update_time"), F.lit(0).alias("seq"))
    newest = merge.latest_per_id(df)
    assert newest.count() == 2001 and newest.filter("id = 'hot'").first().update_time == 2997
    assert newest._jdf.queryExecution().toString().count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_attach_with_hot_and_null_keys(spark, kind):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 1000).cast(kind)
    left = spark.range(6000).select("id", key.alias("k"))
    table = spark.range(0, 1000, 2).select(F.col("id").cast(kind).alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    table = table.unionByName(spark.createDataFrame([(7, "n7")], "key int, name string").select(F.col("key").cast(kind).alias("key"), "name"))
    plain = attach(left, table, "k", "key", {"name": "name"})
    shuffled = attach(left, table.hint("merge"), "k", "key", {"name": "name"})
    assert sorted(map(repr, shuffled.collect())) == sorted(map(repr, plain.collect()))
    assert shuffled.count() == 6000 and shuffled.filter("name = 'n7'").count() == 2002


def test_a_change_writes_its_own_keys_only(spark, tmp_path):
    path = str(tmp_path / "deals")
    tables.write_snapshot(spark.range(1000).select(F.col("id").cast("string").alias("id"), F.lit("a").alias("v"), F.lit(0).alias("n")), path)
    change = lambda t, s: merge_all(t, s)
    source = spark.createDataFrame([("5", "b", 1), ("new", "b", 2)], "id string, v string, n int")
    tables.apply_changes(source, path, 1, change)
    tables.apply_changes(spark.createDataFrame([("5", "c", 10)], "id string, v string, n int"), path, 2, change)
    written = {r.upto: r["count"] for r in spark.read.parquet(path).groupBy("upto").count().collect()}
    assert written == {0: 1000, 1: 2, 2: 1}
    want = {**{str(i): ("a", 0) for i in range(1000)}, "5": ("c", 11), "new": ("b", 2)}
    assert rows(tables.read_table(spark, path)) == want
    assert rows(tables.read_table(spark, path, before=2))["5"] == ("b", 1)
    tables.apply_changes(spark.createDataFrame([("5", "c", 10)], "id string, v string, n int"), path, 2, change)
    assert rows(tables.read_table(spark, path)) == want, "a replayed write changes nothing"
    tables.rewrite_table(spark, path, path + "-new")
    assert rows(tables.read_table(spark, path + "-new")) == want


def test_a_batch_reads_the_partitions_of_its_own_keys(spark, tmp_path):
    path = str(tmp_path / "deals")
    tables.write_snapshot(spark.range(5000).select("id", F.lit("a").alias("v"), F.lit(0).alias("n")), path, parts=64)
    assert tables.parts_of(spark, path) == 64
    source = spark.createDataFrame([(i * 100, "b", 1) for i in range(10)] + [(9999, "new", 1)], "id long, v string, n int")
    for number in (1, 2):
        tables.apply_changes(source, path, number, merge_all)
    held = tables.held_rows(source, path)
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert held.count() == 11 and {tuple(r) for r in held.collect()} == {(i * 100, "b", 2) for i in range(10)} | {(9999, "new", 2)}
    read = [leaf for leaf in leaves(held) if leaf.nodeName().startswith("Scan parquet")]
    assert read and all(partitions_read(leaf) <= 2 * 11 for leaf in read)
    assert max(partitions_read(leaf) for leaf in read) < 64


def leaves(df):
    """Leaves of the plan that ran."""
    df.collect()
    stack, out = [df._jdf.queryExecution().executedPlan()], []
    while stack:
        node = stack.pop()
        inner = {"AdaptiveSparkPlanExec": "executedPlan", "ShuffleQueryStageExec": "plan", "BroadcastQueryStageExec": "plan", "ResultQueryStageExec": "plan"}
        if node.getClass().getSimpleName() in inner:
            stack.append(getattr(node, inner[node.getClass().getSimpleName()])())
            continue
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
        out += [node] * (children.size() == 0)
    return out


def partitions_read(scan):
    return scan.metrics().apply("numPartitions").value()


def test_folding_changes_reads_the_same_at_every_step(spark, tmp_path):
    path = str(tmp_path / "deals")
    tables.write_snapshot(spark.range(100).select("id", F.lit("a").alias("v"), F.lit(0).alias("n")), path, parts=4)
    batch = lambda k: spark.createDataFrame([(k, "b", k), (7, "c", k), (1000 + k, "d", k)], "id long, v string, n int")
    for k in range(1, 6):
        tables.apply_changes(batch(k), path, k, merge_all)
    want = rows(tables.read_table(spark, path))
    tables.fold_changes(spark, path, 5, drop_below=3)
    assert rows(tables.read_table(spark, path)) == want and tables.subfolders(spark, path) == ["upto=0", "upto=3", "upto=4", "upto=5"]
    tables.fold_changes(spark, path, 5)
    assert rows(tables.read_table(spark, path)) == want and tables.subfolders(spark, path) == ["upto=0", "upto=5"]
    assert spark.read.parquet(f"{path}/upto=5").count() == 11
    tables.apply_changes(batch(6), path, 6, merge_all)
    tables.apply_changes(batch(6), path, 6, merge_all)
    assert rows(tables.read_table(spark, path)) == want | {6: ("b", 6), 7: ("c", 21), 1006: ("d", 6)}


def merge_all(t, s):
    both = t.alias("t").join(s.alias("s"), "id", "right")
    return both.select("id", F.col("s.v").alias("v"), (F.coalesce("t.n", F.lit(0)) + F.col("s.n")).alias("n"))


def test_a_failed_change_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "deals")
    tables.write_snapshot(spark.range(10).select(F.col("id").cast("string").alias("id")), path)
    broken = lambda t, s: t.withColumn("id", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        tables.apply_changes(spark.createDataFrame([("1",)], "id string"), path, 1, broken)
    assert tables.read_table(spark, path).count() == 10


def test_a_lookup_skips_files_of_a_snapshot(spark, tmp_path):
    path = str(tmp_path / "deals")
    tables.write_snapshot(spark.range(10_000).select(F.format_string("%05d", "id").alias("id")), path)
    assert "EqualTo(id,00042)" in point_lookup(spark.read.parquet(path), "00042")._jdf.queryExecution().executedPlan().toString()


def test_changelog_edges(spark):
    log = [(1, "stage_id", "1", "2024-01-05 10:00:00"), (1, "stage_id", "1", "2024-01-02 10:00:00"), (1, "stage_id", "9", "2024-01-01 00:00:00"),
           (1, "stage_id", "1", "bad"), (1, "stage_id", "x", "2024-01-01 00:00:00"), (1, "value", "1", "2024-01-01 00:00:00"), (0, "stage_id", "1", "2024-01-01 00:00:00"),
           (2, "stage_id", "2", "2024-01-03 00:00:00"), (2, "stage_id", None, "2024-01-03 00:00:00"), (2, "stage_id", "1", None), (3, "stage_id", "1.0", "2024-01-03 00:00:00")]
    changelog = spark.createDataFrame(log, "deal_id long, field_key string, new_value string, time string")
    catalog = catalogs.stage_column_catalog(spark.createDataFrame([(1, "Novo"), (2, "São João"), (0, "x"), (4, ""), (5, "***"), (None, "y")], "id long, name string"))
    assert catalogs.history_columns(catalog) == ["moved_to_stage_novo_1", "moved_to_stage_sao_joao_2"]
    first = {(r.deal_id, r.column): r.ts for r in history.first_stage_entry(changelog, catalog).collect()}
    assert first == {(1, "moved_to_stage_novo_1"): dt.datetime(2024, 1, 2, 10), (2, "moved_to_stage_sao_joao_2"): dt.datetime(2024, 1, 3)}


def test_backfill_count_never_rises(spark):
    deals = spark.createDataFrame([("1", None, None), ("2", T(1), None), ("3", T(1), T(2))], "id string, moved_to_stage_a_1 timestamp, moved_to_stage_b_2 timestamp")
    wide = spark.createDataFrame([(1, T(5), T(5)), (2, T(9), None), (8, T(1), T(1))], "deal_id long, moved_to_stage_a_1 timestamp, moved_to_stage_b_2 timestamp")
    columns = ["moved_to_stage_a_1", "moved_to_stage_b_2"]
    filled = history.fill_stage_history(deals, wide)
    assert rows(filled) == {"1": (T(5), T(5)), "2": (T(1), None), "3": (T(1), T(2))}
    assert history.backfill_count(deals, columns).first()[0] == 2 and history.backfill_count(filled, columns).first()[0] == 1
    assert history.backfill_count(deals, []).first()[0] == -1


def test_reconciling_a_table_with_itself(spark):
    df = spark.range(50)
    assert tuple(reconcile_ids(df, df).first()) == (50, 50, 0, 0, True)


def test_ordered_helpers_agree_with_whole_windows(spark):
    from pyspark.sql import Window

    df = spark.range(5000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise("cold").alias("g"), F.col("id").alias("ts"), (F.hash("id") % 97).cast("double").alias("v"))
    placed = ordered.numbered(df, ["g"], [F.col("ts")], F.floor(F.col("ts") / 100))
    mean = ordered.trailing_mean(placed, ["g"], "position", "v", 5, "m", block=64)
    w = Window.partitionBy("g").orderBy("ts")
    whole = df.withColumn("position", F.row_number().over(w)).withColumn("m", F.avg("v").over(w.rowsBetween(-4, 0)))
    same = mean.join(whole, (mean.g == whole.g) & (mean.ts == whole.ts) & (mean.position == whole.position) & (F.abs(mean.m - whole.m) < 1e-9))
    assert mean.count() == 5000 and same.count() == 5000


def test_exact_quantiles_on_heavy_ties(spark):
    df = spark.range(9000).select(F.lit("s").alias("g"), F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") % 701).cast("double").alias("v"))
    want = df.agg(F.percentile("v", F.array(F.lit(0.0), F.lit(0.5), F.lit(0.95), F.lit(1.0)))).first()[0]
    got = {r.q: r.value for r in exact_quantiles(df, "v", [0.0, 0.5, 0.95, 1.0], ["g"]).collect()}
    assert [got[q] for q in (0.0, 0.5, 0.95, 1.0)] == pytest.approx(want)


def slow_quantile(values, q):
    nan = lambda v: v != v
    values = sorted((v for v in values if v is not None and not nan(v))) + [v for v in values if v is not None and nan(v)]
    place = q * (len(values) - 1)
    a, b, share = values[int(place)], values[-int(-place // 1)], place % 1
    return a if a == b or not share else a + (b - a) * share


@pytest.mark.parametrize("cell_rows", [10, 1_000_000])
def test_exact_quantiles_of_odd_groups(spark, cell_rows):
    """Wide and narrow ranges, infinities, not-a-number, an outlier, a NULL group and ties, cut into small cells or not at all."""
    inf, nan = float("inf"), float("nan")
    groups = {
        "wide": [1e308, -1e308, 0.0, 1e-300, 5.0, 5.0, 5.0, 6.0, None] + [float(i) / 7 for i in range(300)] + [1e12 + i for i in range(50)],
        "inf": [float(i) for i in range(10)] + [inf], "both": [-inf, inf] * 3 + [1.0], "nan": [nan, nan, 1.0, 2.0], "outlier": [float(i) / 3 for i in range(400)] + [1e9],
        None: [float(i % 150) for i in range(500)], "one": [3.0], "none": [None], "tied": [5.0] * 400 + [float(i) for i in range(60)],
    }
    df = spark.createDataFrame([(g, v) for g, values in groups.items() for v in values], "g string, v double").repartition(5)
    qs = [0.0, 0.1, 0.5, 0.77, 0.999, 1.0]
    got = {(r.g, r.q): r.value for r in exact_quantiles(df, "v", qs, ["g"], cell_rows, cuts=8).collect()}
    want = {(g, q): slow_quantile(values, q) for g, values in groups.items() for q in qs if any(v is not None for v in values)}
    assert got == pytest.approx(want, nan_ok=True)


def test_neighbours_keep_null_groups_and_cross_chunks(spark):
    rows = [(g, i, i * 10) for g in ("a", None) for i in range(20)]
    df = spark.createDataFrame(rows, "g string, ts long, v long").withColumn("chunk", F.floor(F.col("ts") / 3))
    got = ordered.following(ordered.previous(df, ["g"], F.col("ts"), "v", "chunk", "before"), ["g"], F.col("ts"), "v", "chunk", "after").collect()
    assert sorted(((r.g or "", r.ts, r.before, r.after) for r in got)) == sorted((g or "", i, v - 10 if i else None, v + 10 if i < 19 else None) for g, i, v in rows)
    assert ordered.numbered(df, ["g"], [F.col("ts")], F.col("chunk")).filter("position = ts + 1").count() == 40


def test_sliding_increase_extrapolates_and_never_starts_below_zero(spark):
    at = lambda m, s=0: dt.datetime(2024, 1, 1, 0, m, s)
    even = [("even", at(m), 100.0 + 10 * m) for m in range(30)]
    rows = even + [("young", at(10), 1.0), ("young", at(12), 21.0), ("single", at(10), 5.0), ("reset", at(15), 50.0), ("reset", at(18), 60.0), ("reset", at(21), 6.0), (None, at(15), 0.0), (None, at(20), 8.0)]
    df = spark.createDataFrame(rows, "series string, ts timestamp, value double")
    got = {(r.series, r.start.hour * 60 + r.start.minute): r.increase for r in sliding_increase(df).filter("start >= '2024-01-01'").collect()}
    assert got["even", 5] == pytest.approx(150) and got["even", 0] == pytest.approx(150), "whole range, samples a minute apart"
    assert got["young", 0] == pytest.approx(20 * (120 + 6 + 60) / 120), "no growth from below zero before the first sample"
    assert got["reset", 15] == pytest.approx(16 * (360 + 0 + 90) / 360) and got[None, 10] == pytest.approx(8 * (300 + 0 + 300) / 300)
    assert not any(series == "single" for series, _ in got)


def test_stage_transitions_of_a_busy_deal(spark):
    days = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * i)
    entries = [(1, "ab"[i % 2], days(i)) for i in range(500)] + [(1, "a", days(0))] * 3 + [(2, "a", days(3)), (3, "a", days(1)), (3, "b", days(1)), (3, "c", days(9))]
    got = [tuple(r) for r in history.stage_transitions(spark.createDataFrame(entries, "deal_id long, column string, ts timestamp")).collect()]
    want = []
    for deal in (1, 2, 3):
        own = sorted({(ts, stage) for d, stage, ts in entries if d == deal})
        for (ts, stage), then in zip(own, [*own[1:], None]):
            want.append((deal, stage, ts, then and then[1], then and then[0], then and int((then[0] - ts).total_seconds())))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_counter_resets(spark):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    df = spark.createDataFrame([("s", at(0), 10.0), ("s", at(1), 15.0), ("s", at(6), 3.0), ("s", at(20), 4.0)], "series string, ts timestamp, value double")
    got = {r.bucket.minute: r.increase for r in counter_increase(df).collect()}
    assert got == {0: 5.0, 5: 3.0, 20: 1.0}


def test_tables_that_agree_shuffle_a_row_for_each_range(spark):
    from funnelwise.operators.quality import differing_ranges, field_mismatches, reconcile_unique_ids

    table = spark.range(20_000).select("id", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 5).alias("v"), F.lit("x").alias("w")).repartition(5)
    other = table.repartition(3)
    assert differing_ranges(table, other, ["id", "v", "w"], 64).count() == 0
    assert field_mismatches(table, other, ["v", "w"], ranges=64).count() == 0
    assert tuple(reconcile_unique_ids(table, other, 64).first()) == (20_000, 20_000, 0, 0, True)
    # NULL against a value, values swapped between columns, a missing and an extra row
    changed = other.withColumns({"v": F.when(F.col("id") == 7, 3).when(F.col("id") == 8, None).otherwise(F.col("v"))}).filter("id <> 9").unionByName(spark.createDataFrame([(99_999, 1, "x")], "id long, v long, w string"))
    assert 2 <= differing_ranges(table, changed, ["id", "v", "w"], 64).count() <= 4
    got = sorted(map(tuple, field_mismatches(table, changed, ["v", "w"], ranges=64).collect()))
    assert got == sorted(map(tuple, field_mismatches(table, changed, ["v", "w"]).collect())) and len(got) == 3
    assert tuple(reconcile_unique_ids(table, changed, 64).first()) == (20_000, 20_000, 1, 1, True)
    shape = range_plan(table, changed)
    assert shape.count("Exchange hashpartitioning") == 2 and shape.count("partial_bit_xor") == 2


def range_plan(a, b):
    from funnelwise.operators.quality import range_digests

    return range_digests(a, ["id", "v"], 64).join(range_digests(b, ["id", "v"], 64), "range", "full_outer")._jdf.queryExecution().executedPlan().toString()


def test_page_chains_of_two_runs_with_holes(spark):
    import json

    def page(n, run="r", **more):
        body = {"entity": "e", "run_id": run, "page_no": n, "success": True, "data": [{}], "additional_data": {"pagination": {"start": 100 * n, "more_items_in_collection": True, "next_start": 100 * n + 100}}}
        return json.dumps(body | more)

    final = lambda n, run: page(n, run, additional_data={"pagination": {"start": 100 * n, "more_items_in_collection": False}})
    cursor = lambda n, run, own, then: page(n, run, cursor=own, additional_data={"next_cursor": then})
    lines = [page(1, "hole"), page(2, "hole"), final(4, "hole"), page(1, "whole"), page(2, "whole"), page(2, "whole"), final(3, "whole"), page(1, None), page(2, None)]
    lines += [page(1, "moved"), page(2, "moved", additional_data={"pagination": {"start": 150, "more_items_in_collection": False}})]
    lines += [cursor(1, "cursor", None, "a"), cursor(2, "cursor", "b", "c"), cursor(1, "good", None, "a"), cursor(2, "good", "a", None)] + ["{broken"]
    lines += [page(n, "long") for n in range(1, 10_000)] + [final(10_000, "long")]
    heads = pages.parse_page_heads(spark.createDataFrame([(line,) for line in lines], "value string"))
    got = {r.run_id: (r.last_page, r.end_reason, r.pages) for r in pages.page_chain_audit(heads).filter("entity = 'e'").collect()}
    assert got == {
        "hole": (2, "gap", 3), "whole": (3, "complete", 4), None: (2, "missing_page", 2), "moved": (1, "gap", 2), "cursor": (1, "gap", 2), "good": (2, "complete", 2), "long": (10_000, "complete", 10_000),
    }
