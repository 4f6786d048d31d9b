"""Reconciling the loaded table with its source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import keep

CRITICAL_FIELDS = ["value", "currency", "status", "stage_name"]


#: Ranges of the id's hash that are compared by digest.
RANGES = 4096


def range_digests(rows: DataFrame, columns: list[str], ranges: int = RANGES) -> DataFrame:
    """(range, n, x, s): count, exclusive or and sum of the hashes of the columns' texts in each range of the id's hash.

    The digests do not depend on the order of rows and are folded before the shuffle: a table sends one row for each
    range from each task. Tables that differ in a range agree in all three only by chance (1 in 2^96).
    """
    digest = F.xxhash64(*[c for name in columns for c in (F.col(name).isNull(), F.col(name).cast("string"))])
    other = F.xxhash64(digest, F.lit(1))
    return rows.groupBy(range_of(ranges).alias("range")).agg(
        F.count("*").alias("n"), F.bit_xor(digest).alias("x"), F.sum(other.bitwiseAND(F.lit((1 << 32) - 1))).alias("s")
    )


def range_of(ranges: int) -> Column:
    return F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(ranges)).cast("int")


def differing_ranges(source: DataFrame, target: DataFrame, columns: list[str], ranges: int = RANGES) -> DataFrame:
    """(range, n, t_n): the ranges in which the rows of two tables differ, with their counts. Written, at most `ranges` rows."""
    there = range_digests(target, columns, ranges).select("range", *[F.col(c).alias(f"t_{c}") for c in "nxs"])
    both = range_digests(source, columns, ranges).join(there, "range", "full_outer")
    same = F.lit(True)
    for c in "nxs":
        same = same & F.col(c).eqNullSafe(F.col(f"t_{c}"))
    return keep(both.filter(~same).select("range", "n", "t_n"))


def _within(rows: DataFrame, ranges: DataFrame, count: int) -> DataFrame:
    """Rows of some ranges, of which there are at most `count`."""
    return rows.withColumn("__range", range_of(count)).join(F.broadcast(ranges.select(F.col("range").alias("__range"))), "__range", "left_semi").drop("__range")


def reconcile_ids(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: distinct ids on each side, missing, extra, and whether the row counts match."""
    left = source.select(F.col("id").cast("string").alias("id"), F.lit(1).alias("s"), F.lit(0).alias("t"))
    right = target.select(F.col("id").cast("string").alias("id"), F.lit(0).alias("s"), F.lit(1).alias("t"))
    by_id = left.unionByName(right).groupBy("id").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    known = F.col("id").isNotNull()
    return by_id.agg(
        F.count_if(known & (F.col("s") > 0)).alias("source_ids"),
        F.count_if(known & (F.col("t") > 0)).alias("target_ids"),
        F.count_if(known & (F.col("s") > 0) & (F.col("t") == 0)).alias("missing_ids"),
        F.count_if(known & (F.col("s") == 0) & (F.col("t") > 0)).alias("extra_ids"),
        (F.coalesce(F.sum("s"), F.lit(0)) == F.coalesce(F.sum("t"), F.lit(0))).alias("count_match"),
    )


def reconcile_unique_ids(source: DataFrame, target: DataFrame, ranges: int = RANGES) -> DataFrame:
    """What reconcile_ids gives, for sides whose ids are unique and not NULL: only ids of ranges that differ are shuffled."""
    s, t = (side.select(F.col("id").cast("string").alias("id")) for side in (source, target))
    apart = differing_ranges(s, t, ["id"], ranges)
    found = reconcile_ids(_within(s, apart, ranges), _within(t, apart, ranges)).select("missing_ids", "extra_ids")
    parts = s.agg(F.count("*").alias("source_ids")).unionByName(t.agg(F.count("*").alias("target_ids")), True).unionByName(found, True)
    counts = parts.agg(*[F.max(c).alias(c) for c in ("source_ids", "target_ids", "missing_ids", "extra_ids")])
    return counts.withColumn("count_match", F.col("source_ids") == F.col("target_ids"))


def field_mismatches(source: DataFrame, target: DataFrame, fields=CRITICAL_FIELDS, n: int | None = None, ranges: int | None = None) -> DataFrame:
    """(id, field, source, target) of differing fields; field is NULL for an id the target lacks.

    Compares all source rows, or with `n` a repeatable sample of that many. Source values must be
    transformed the way the table's are. With `ranges`, digests of so many ranges of ids are compared first, and rows only where these
    differ: tables that agree shuffle one row for each range.
    """
    picked = source if n is None else source.orderBy(F.xxhash64("id"), "id").limit(n)
    if ranges is not None:
        columns = ["id", *fields]
        shown = lambda df: df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        picked, target = shown(picked), shown(target)
        apart = differing_ranges(picked, target, columns, ranges)
        picked, target = _within(picked, apart, ranges), _within(target, apart, ranges)
    left = picked.select(F.col("id").cast("string").alias("id"), *[F.col(f).cast("string").alias(f"s_{f}") for f in fields])
    right = target.select(F.col("id").cast("string").alias("__id"), *[F.col(f).cast("string").alias(f"t_{f}") for f in fields])
    joined = left.join(right, left["id"] == right["__id"], "left")
    pairs = [F.struct(F.lit(f).alias("field"), F.col(f"s_{f}").alias("source"), F.col(f"t_{f}").alias("target")) for f in fields]
    differing = F.filter(F.array(*pairs), lambda p: ~p["source"].eqNullSafe(p["target"]))
    nothing = F.lit(None).cast("string")
    absent = F.array(F.struct(nothing.alias("field"), nothing.alias("source"), nothing.alias("target")))
    return joined.select("id", F.inline(F.when(F.col("__id").isNull(), absent).otherwise(differing)))


def date_issue(today: Column) -> Column:
    """Whether a deal's dates contradict each other or lie after `today`."""
    checks = [F.col("add_time") > today, F.col("update_time") < F.col("add_time"), F.col("close_time") < F.col("add_time")]
    found = F.lit(False)
    for check in checks:
        found = found | F.coalesce(check, F.lit(False))
    return found


def date_consistency(deals: DataFrame, today: Column) -> DataFrame:
    return deals.agg(F.count_if(date_issue(today)).alias("issues"))


def data_quality_report(source: DataFrame, target: DataFrame, today: Column, n: int | None = None, fields=CRITICAL_FIELDS) -> DataFrame:
    """One row: issue counts in total and by kind, count match, and the first five messages.

    Without `n`, one full outer join of the two sides gives everything; their ids must be unique.
    """
    side = lambda df, p: [F.col("id").cast("string").alias(f"{p}_id"), *[F.col(f).cast("string").alias(f"{p}_{f}") for f in fields]]
    chosen, left = F.lit(True), source
    if n is not None:
        picked = source.orderBy(F.xxhash64("id"), "id").limit(n).select("id", F.lit(True).alias("__chosen"))
        chosen, left = F.coalesce("__chosen", F.lit(False)), source.join(picked, "id", "left")
    left = left.select(*side(left, "s"), F.lit(True).alias("in_source"), chosen.alias("chosen"))
    right = target.select(*side(target, "t"), F.lit(True).alias("in_target"), date_issue(today).alias("odd_dates"))
    both = left.join(right, F.col("s_id") == F.col("t_id"), "full_outer")
    missing, extra = F.col("in_target").isNull() & F.col("s_id").isNotNull(), F.col("in_source").isNull() & F.col("t_id").isNotNull()
    pairs = [F.struct(F.lit(f).alias("field"), F.col(f"s_{f}").alias("source"), F.col(f"t_{f}").alias("target")) for f in fields]
    differing = F.filter(F.array(*pairs), lambda p: ~p["source"].eqNullSafe(p["target"]))
    found = F.when(F.col("chosen") & F.col("in_target"), differing).otherwise(F.array().cast("array<struct<field:string,source:string,target:string>>"))
    both = both.withColumns({"missing": missing, "extra": extra, "found": found})
    shown = lambda p, c: F.coalesce(p[c], F.lit("None"))
    message = lambda p: F.concat(F.lit("Field mismatch "), p["field"], F.lit(": "), shown(p, "source"), F.lit(" vs "), shown(p, "target"))
    lines = F.transform("found", lambda p: F.struct(F.col("s_id").alias("id"), p["field"].alias("field"), message(p).alias("message")))
    gone = F.array(F.struct(F.col("s_id").alias("id"), F.lit("").alias("field"), F.concat(F.lit("Missing record "), F.col("s_id")).alias("message")))
    judged = keep(both.select("missing", "extra", "in_source", "in_target", "odd_dates", F.size("found").alias("n"), F.when(F.col("missing") & F.col("chosen"), gone).otherwise(lines).alias("lines")))
    first = judged.select(F.inline("lines")).orderBy("id", "field").limit(5)
    counts = judged.agg(
        F.count_if("missing").alias("missing_ids_count"),
        F.count_if("extra").alias("extra_ids_count"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("field_issues"),
        F.count_if("odd_dates").alias("date_issues"),
        (F.count("in_source") == F.count("in_target")).alias("count_match"),
    )
    listed = first.agg(F.array_sort(F.collect_list(F.struct("id", "field", "message"))).alias("lines"))
    report = counts.unionByName(listed, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in counts.columns], F.flatten(F.collect_list("lines")).alias("lines"))
    total = F.col("missing_ids_count") + F.col("extra_ids_count") + F.col("field_issues") + F.col("date_issues")
    sample = F.array_join(F.transform("lines", lambda line: line["message"]), "; ")
    return report.select(
        total.alias("data_quality_issues"), "count_match", "missing_ids_count", "extra_ids_count",
        "date_issues", sample.alias("detailed_issues_sample"),
    )


def failed_sample(df: DataFrame, n: int = 5, order: list[str] | None = None) -> DataFrame:
    """The first `n` failed rows for a report, in a fixed order."""
    return df.orderBy(*(order or ["id"])).limit(n)
