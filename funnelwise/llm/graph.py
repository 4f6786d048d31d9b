"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import forget, keep


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every id that has a link to another one: the smallest id that links reach.

    `links` has columns a and b, in any direction, with repeats and self-links. Each step makes links of ids to the
    smallest neighbour, by sums over keys and joins that Spark can split where one id has many links,
    and is written, so a lost executor costs one step. The steps are logarithmic in the longest path; links
    that already are stars around the smallest id take none.
    """
    a, b = F.col("a"), F.col("b")
    state = keep(links.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    while not _are_stars(state):
        both = state.union(state.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter(b > a).join(least, "a").select(b.alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(b.alias("a"), F.col("m").alias("b")).filter(a != b)
        after = keep(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        forget(state)
        state = after
    return state.select(a.alias("id"), b.alias("root"))


def _are_stars(links: DataFrame) -> bool:
    """Whether every id has one link to a smaller id, which has none itself."""
    ends = links.select("a", F.lit(1).alias("up")).union(links.select("b", F.lit(0).alias("up")))
    ids = ends.groupBy("a").agg(F.sum("up").alias("ups"), F.min("up").alias("low"))
    return ids.filter((F.col("ups") > 1) | ((F.col("ups") == 1) & (F.col("low") == 0))).isEmpty()
