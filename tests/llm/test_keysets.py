"""Rows picked by a bitmap of keys: none goes amiss, few others come along."""

import pytest
from pyspark.sql import functions as F

from funnelwise.llm import keysets
from funnelwise.llm.keysets import split_by_keys


@pytest.mark.parametrize("most", [1 << 28, 1 << 15])
def test_split_keeps_all_rows_of_the_keys(spark, monkeypatch, most):
    monkeypatch.setattr(keysets, "MOST_BITS", most)
    rows = spark.range(40_000).select(F.when(F.col("id") % 1000 > 0, F.col("id")).alias("k"), F.col("id").alias("bits"), F.lit("own").alias("bucket")).repartition(4)
    keys = spark.range(0, 40_000, 7).select(F.when(F.col("id") > 0, F.col("id")).cast("int").alias("k"))
    probable, rest = split_by_keys(rows, keys, "k")
    assert probable.columns == rest.columns == rows.columns
    wanted = {None, *range(7, 40_000, 7)}
    got, left = [[r.k for r in part.collect()] for part in (probable, rest)]
    assert len(got) + len(left) == 40_000 and not wanted & set(left) and wanted - set(range(0, 40_000, 1000)) <= set(got)
    others = len([k for k in got if k not in wanted])
    assert others < 34_000 * (1 / 8 if most > 1 << 15 else 1 / 4)


def test_split_by_no_keys_and_of_no_rows(spark):
    rows, none = spark.range(10).withColumnRenamed("id", "k"), spark.createDataFrame([], "k long")
    assert [part.count() for part in split_by_keys(rows, none, "k")] == [0, 10]
    assert [part.count() for part in split_by_keys(none, rows, "k")] == [0, 0]


def test_bitmap_is_made_where_its_keys_meet(spark):
    probable, _ = split_by_keys(spark.range(10), spark.range(5), "id")
    plan = probable._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("hashpartitioning(__key_bucket") == 1
