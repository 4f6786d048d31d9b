"""Bucketed distributions, their quantiles, exact quantiles, and counter rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import keep
from .ordered import join_same, previous


def duration_histogram(df: DataFrame, value: str, edges: list[float], by: list[str]) -> DataFrame:
    """Cumulative counts (by..., le, count) of values at or below each edge, the last one infinite."""
    counts = [F.count_if(F.col(value) <= F.lit(float(e))).alias(f"c{i}") for i, e in enumerate(edges)]
    wide = df.groupBy(*by).agg(*counts, F.count(value).alias(f"c{len(edges)}"))
    tops = [*map(float, edges), float("inf")]
    rows = [F.struct(F.lit(e).alias("le"), F.col(f"c{i}").alias("count")) for i, e in enumerate(tops)]
    return wide.select(*by, F.inline(F.array(*rows)))


def histogram_quantile(hist: DataFrame, q: float, by: list[str]) -> DataFrame:
    """Quantile by linear interpolation inside the first bucket that reaches rank q * total.

    The first bucket starts at 0; a rank in the infinite bucket gives the highest finite edge.
    """
    summed = hist.groupBy(*by, "le").agg(F.sum("count").alias("count"))
    # One entry per edge: the list is as short as the list of edges.
    listed = summed.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("le", "count"))).alias("b"))
    ranked = listed.withColumn("n", F.element_at("b", -1)["count"]).withColumn("rank", F.col("n") * F.lit(q))
    hit = F.filter(F.transform("b", lambda x, i: F.struct(i.alias("i"), x["count"].alias("count"))), lambda x: x["count"] >= F.col("rank"))
    placed = ranked.withColumn("i", hit[0]["i"]).withColumn("bucket", F.get("b", F.col("i")))
    placed = placed.withColumn("below", F.when(F.col("i") > 0, F.get("b", F.col("i") - 1)))
    low, high = F.coalesce(F.col("below.le"), F.lit(0.0)), F.col("bucket.le")
    start = F.coalesce(F.col("below.count"), F.lit(0))
    share = F.try_divide(F.col("rank") - start, F.col("bucket.count") - start)
    inside = low + (high - low) * F.coalesce(share, F.lit(0.0))
    value = (
        F.when(F.col("n") == 0, None)
        .when(high == float("inf"), F.col("below.le"))
        .when((F.col("i") == 0) & (high <= 0), high)
        .otherwise(inside)
    )
    return placed.select(*by, F.lit(float(q)).alias("q"), value.alias("value"))


def exact_quantiles(df: DataFrame, value: str, quantiles: list[float], by: list[str], cell_rows: int = 1_000_000, cuts: int = 64) -> DataFrame:
    """Interpolated exact quantiles per group -> (by..., q, value).

    Values are counted first, so repeated ones collapse before any shuffle, and written once. While a group has more than `cell_rows` different
    values, it is cut at about equal ranks, which a mergeable quantile sketch gives however the values are spread, and
    only the cells that hold a wanted rank stay. Then what is left is ordered. Exact: the sketch only chooses the cuts. NULL
    values do not count, a NULL group is one, infinities are values, and NaN is above all of them.
    """
    counted = keep(df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("c")))
    totals = counted.groupBy(*by).agg(F.sum("c").alias("c"))
    wanted = totals.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in quantiles]))).withColumn("place", F.col("q") * (F.col("c") - 1))
    wanted = wanted.select(*by, "q", "place", F.explode(F.array_distinct(F.array(F.floor("place"), F.ceil("place")))).alias("rank"))
    inside, cells = counted, list(by)
    while (inside.groupBy(*cells).count().agg(F.max("count")).first()[0] or 0) > cell_rows:
        inside, wanted, cells = _cells(inside, wanted, cells, f"cell{len(cells) - len(by)}", cuts)
    last = F.sum("c").over(Window.partitionBy(*cells).orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    hit = join_same(inside.withColumn("last", last), wanted, cells)
    hit = hit.filter((F.col("rank") < F.col("last")) & (F.col("rank") >= F.col("last") - F.col("c")))
    ends = hit.groupBy(*by, "q").agg(F.min("v").alias("a"), F.max("v").alias("b"), F.max("place").alias("place"))
    share, a, b = F.col("place") - F.floor("place"), F.col("a"), F.col("b")
    return ends.select(*by, "q", F.when((a == b) | (share == 0), a).otherwise(a + (b - a) * share).alias("value"))


def _cells(inside: DataFrame, wanted: DataFrame, by: list[str], name: str, cuts: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Cut each group's different values into cells of about equally many, and keep those that hold a wanted rank.

    Cells are numbered by the cuts at or below a value. The cuts are written, as a sketch made again could give others.
    """
    ranks = F.array(*[F.lit(i / cuts) for i in range(1, cuts)])
    sketch = F.kll_sketch_agg_double(F.when(~F.isnan("v"), F.col("v")), F.lit(1024))
    edges = keep(inside.groupBy(*by).agg(sketch.alias("s"), F.count_if(~F.isnan("v")).alias("numbers")).select(
        *by, F.when(F.col("numbers") > 0, F.array_sort(F.array_distinct(F.kll_sketch_get_quantile_double("s", ranks)))).otherwise(F.array().cast("array<double>")).alias("edges")
    ))
    cell = F.size(F.filter("edges", lambda e: e <= F.col("v")))
    placed = join_same(inside, edges, by).withColumn(name, cell).drop("edges")
    sizes = placed.groupBy(*by, name).agg(F.sum("c").alias("size"))
    upto = F.sum("size").over(Window.partitionBy(*by).orderBy(name).rowsBetween(Window.unboundedPreceding, 0))
    sizes = sizes.withColumn("upto", upto).withColumn("start", F.col("upto") - F.col("size"))
    wanted = join_same(wanted, sizes, by).filter((F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("upto")))
    cells = [*by, name]
    wanted = keep(wanted.select(*cells, "q", "place", (F.col("rank") - F.col("start")).alias("rank")))
    return keep(join_same(placed, wanted.select(*cells).distinct(), cells, "left_semi")), wanted, cells


def counter_steps(samples: DataFrame, chunk: str) -> DataFrame:
    """`samples` (series, ts, value) with `before`, the sample before it in the series, and `step`, the growth since then.

    A falling value means a restart, so it counts in full; the first sample of a series counts 0. Samples of one time count in the
    order of their values, the same on every run. `chunk` names a column that rises with the time.
    """
    sample = F.struct("ts", "value")
    stepped = previous(samples, ["series"], sample, sample, chunk, "before")
    before, value = F.col("before.value"), F.col("value")
    return stepped.withColumn("step", F.when(F.col("before").isNull(), 0.0).when(value < before, value).otherwise(value - before))


def counter_increase(samples: DataFrame, bucket: str = "5 minutes") -> DataFrame:
    """Reset-aware growth of cumulative counters (series, ts, value) per time bucket, see counter_steps."""
    timed = samples.withColumn("bucket", F.window("ts", bucket)["start"])
    totals = counter_steps(timed, "bucket").groupBy("series", "bucket").agg(F.sum("step").alias("increase"))
    return totals.withColumn("rate", F.col("increase") / _seconds(bucket))


def sliding_increase(samples: DataFrame, range: str = "15 minutes", step: str = "5 minutes") -> DataFrame:
    """Growth of counters over moving ranges, with the growth between the outer samples extrapolated to the range's edges.

    (series, start, stop, increase, rate) for each range of length `range` that starts at a multiple of `step`, includes its start
    and holds samples of two times or more. Growth is carried on to an edge if a sample lies near it, at most 1.1 times their mean
    distance away, else by half of that distance; to the start no further than to where the counter would be zero. Ranges are
    aggregated from the samples' own growth, so nothing is gathered for a range.
    """
    chunked = samples.withColumn("__chunk", F.window("ts", step)["start"])
    stepped = counter_steps(chunked, "__chunk").withColumn("__range", F.window("ts", range, step))
    start, stop = F.col("__range.start"), F.col("__range.end")
    seconds = lambda a, b: F.timestamp_diff("MICROSECOND", F.col(a), F.col(b)) / 1e6
    sums = stepped.groupBy("series", start.alias("start"), stop.alias("stop")).agg(
        F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"), F.min_by("value", F.struct("ts", "value")).alias("value"),
        F.sum(F.when(F.col("before.ts") >= start, F.col("step")).otherwise(0.0)).alias("growth"),
    ).filter(F.col("last") > F.col("first"))
    between = seconds("first", "last")
    mean = between / (F.col("n") - 1)
    near = lambda distance: F.when(distance >= mean * 1.1, mean / 2).otherwise(distance)
    to_zero = F.when((F.col("growth") > 0) & (F.col("value") >= 0), between * (F.col("value") / F.col("growth")))
    to_start = F.least(near(seconds("start", "first")), to_zero)
    to_stop = near(seconds("last", "stop"))
    increase = F.col("growth") * ((between + to_start + to_stop) / between)
    return sums.select("series", "start", "stop", increase.alias("increase"), (increase / _seconds(range)).alias("rate"))


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _seconds(bucket: str) -> float:
    count, unit = bucket.split()
    return float(count) * _UNITS[unit.rstrip("s")]
