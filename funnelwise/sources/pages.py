"""Landed API pages: one JSON envelope per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import following

_HEAD = """
    entity STRING, run_id STRING, page_no BIGINT, success BOOLEAN, cursor STRING,
    additional_data STRUCT<
        next_cursor: STRING,
        pagination: STRUCT<start: BIGINT, more_items_in_collection: BOOLEAN, next_start: BIGINT>
    >
"""
ENVELOPE = _HEAD + ", data ARRAY<VARIANT>"
#: Pages of a chain whose neighbours one task looks up.
CHUNK_PAGES = 4096


def _landed_at(lines: DataFrame) -> Column:
    """When a line arrived: its column `landed_at`, which files give from their time; one time for all without it."""
    if "landed_at" in lines.columns:
        return F.col("landed_at").cast("timestamp")
    return F.lit(None).cast("timestamp")


def with_landing_time(lines: DataFrame) -> DataFrame:
    """Lines read from files, with the time their file landed."""
    return lines.select("value", F.col("_metadata.file_modification_time").alias("landed_at"))


def parse_pages(lines: DataFrame, column: str = "value") -> DataFrame:
    """Page envelopes of JSON lines; a broken line becomes a page with NULL fields."""
    return lines.select(_landed_at(lines).alias("landed_at"), F.from_json(F.col(column), ENVELOPE).alias("page")).select("landed_at", "page.*")


def parse_page_heads(lines: DataFrame, column: str = "value") -> DataFrame:
    """What `page_chain_audit` needs: envelopes with the number of records `size` in place of the records."""
    pages = lines.select(F.from_json(F.col(column), _HEAD + ", data ARRAY<STRING>").alias("page")).select("page.*")
    return pages.withColumn("size", F.when(F.col("data").isNotNull(), F.size("data"))).drop("data")


def page_records(pages: DataFrame) -> DataFrame:
    """Items of successful pages -> (record VARIANT, entity, page_no, cursor, seq).

    `seq` orders records by landing time, page and place, so that a later arrival has a higher one
    although every fetch counts its pages anew.
    """
    good = pages.filter(F.col("success"))
    items = good.select("landed_at", "entity", "page_no", F.col("additional_data.next_cursor").alias("cursor"), F.posexplode("data").alias("place", "record"))
    return items.select("record", "entity", "page_no", "cursor", F.struct("landed_at", "page_no", "place").alias("seq"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Records of the landed pages under `path`; unsuccessful and empty pages give none."""
    return page_records(parse_pages(with_landing_time(spark.read.text(path))))


def page_chain_audit(pages: DataFrame) -> DataFrame:
    """Where each page chain, of an entity in one fetch run, ended, and why, from page heads.

    A chain stops at its first unsuccessful, empty or final page. `missing_next_start` is a page
    that promises more without saying where; `missing_page` a chain whose last page promises more; `gap` a page whose
    follower is not the one it points to: a page number is left out, or the follower says that it starts elsewhere or
    was asked for by another cursor. Pages landed twice count as one link. Each task looks at one stretch of a chain.
    """
    pagination = F.col("additional_data.pagination")
    more = F.coalesce(pagination["more_items_in_collection"], F.lit(False))
    follows = (more & pagination["next_start"].isNotNull()) | (F.length("additional_data.next_cursor") > 0)
    size = F.coalesce(F.col("size"), F.lit(0))
    reason = (
        F.when(~F.coalesce("success", F.lit(False)), "unsuccessful")
        .when(size == 0, "no_data")
        .when(F.coalesce(follows, F.lit(False)), None)
        .when(more, "missing_next_start")
        .otherwise("complete")
    )
    kept = F.when(F.coalesce("success", F.lit(False)), size).otherwise(0)
    place = F.struct("page_no", pagination["start"].alias("start"), "cursor")
    marked = pages.select(
        "entity", "run_id", "page_no", kept.alias("items"), reason.alias("reason"), place.alias("place"), F.floor(F.col("page_no") / CHUNK_PAGES).alias("chunk"),
        pagination["next_start"].alias("next_start"), F.nullif("additional_data.next_cursor", F.lit("")).alias("next_cursor"),
    )
    linked = following(marked, ["entity", "run_id"], F.col("place"), F.col("place"), "chunk", "then")
    then = F.col("then")
    elsewhere = (then["start"] != F.col("next_start")) | (then["cursor"] != F.col("next_cursor"))
    gap = (then["page_no"] > F.col("page_no") + 1) | ((then["page_no"] == F.col("page_no") + 1) & F.coalesce(elsewhere, F.lit(False)))
    linked = linked.withColumn("reason", F.coalesce("reason", F.when(gap, "gap")))
    ended = F.when(F.col("reason").isNotNull(), F.col("page_no"))
    chains = linked.groupBy("entity", "run_id").agg(
        F.count("*").alias("pages"),
        F.sum("items").cast("bigint").alias("items"),
        F.max("page_no").alias("newest"),
        F.min(ended).alias("stop"),
        F.min_by("reason", ended).alias("reason"),
    )
    return chains.select(
        "entity", "run_id", "pages", "items", F.coalesce("stop", "newest").alias("last_page"),
        F.coalesce("reason", F.lit("missing_page")).alias("end_reason"),
    )
