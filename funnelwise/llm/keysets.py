"""Picking the rows of few keys in the map pass, so that a join shuffles little more than them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the bitmap for each key, and the most in all (32 MiB), which bounds what is broadcast.
BITS_EACH = 16
MOST_BITS = 1 << 28
_BUCKET_BITS = 1 << 15  # fixed by bitmap_construct_agg


def _place(key: str, bits: int) -> tuple[Column, Column]:
    """Bucket of a key's bit, and its place there, by the key's text, so that integers of any width agree. NULL is a key."""
    at = F.pmod(F.xxhash64(F.lit(11), F.col(key).cast("string")), F.lit(bits))
    return F.floor(at / _BUCKET_BITS).cast("int"), (at % _BUCKET_BITS).cast("int")


def split_by_keys(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """`rows` whose key may be in `keys` (a table with a column of that name), and those whose key is not.

    A hash of each key sets a bit, and the bitmap is broadcast. No row of a key goes amiss; of the others about one in BITS_EACH is
    taken for one, and more of them once there are over MOST_BITS / BITS_EACH keys. `keys` is read twice: pass a table.
    """
    bits = min(MOST_BITS, max(_BUCKET_BITS, 1 << (keys.count() * BITS_EACH).bit_length()))
    bucket, place = _place(key, bits)
    # keys are dealt by bucket first, so that no task sends bitmaps
    dealt = keys.select(bucket.alias("__key_bucket"), place.alias("__key_place")).repartition("__key_bucket")
    bitmap = dealt.groupBy("__key_bucket").agg(F.bitmap_construct_agg("__key_place").alias("__key_bits"))
    placed = rows.withColumns({"__key_bucket": bucket, "__key_place": place}).join(F.broadcast(bitmap), "__key_bucket", "left")
    byte = F.conv(F.hex(F.substring("__key_bits", F.floor(F.col("__key_place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.coalesce(F.getbit(byte, F.col("__key_place") % 8) == 1, F.lit(False))
    return placed.filter(held).select(rows.columns), placed.filter(~held).select(rows.columns)
