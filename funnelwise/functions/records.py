"""Access to the fields of a semi-structured record (VARIANT)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ZERO_FRACTION = r"^\s*[+-]?\d+\.0+\s*$"


def path(*keys: str) -> str:
    """Variant path of nested keys, quoted so that any key is safe."""
    return "$" + "".join("['" + k.replace("\\", "\\\\").replace("'", "\\'") + "']" for k in keys)


def get(record: Column, *keys: str) -> Column:
    """Field of a record as VARIANT; SQL NULL where absent."""
    return F.try_variant_get(record, path(*keys), "variant")


def text(record: Column, *keys: str) -> Column:
    """Field as text: a scalar's value, an object's or list's JSON text, NULL for JSON null."""
    return F.try_variant_get(record, path(*keys), "string")


def kind(value: Column) -> Column:
    """Name of the JSON kind: VOID, STRING, BOOLEAN, BIGINT, DECIMAL, DOUBLE, OBJECT or ARRAY."""
    return F.substring_index(F.substring_index(F.schema_of_variant(value), "(", 1), "<", 1)


def is_object(record: Column, *keys: str) -> Column:
    """Whether a field is an object, without describing what is in it."""
    return F.try_variant_get(record, path(*keys), "struct<_: variant>").isNotNull()


def fields(record: str, names: list[str], kind: str, *keys: str) -> Column:
    """Struct of several fields, found in one pass over the record or over the object under `keys`.

    As "string" each field is what `text` gives, as "variant" what `get` gives.
    """
    shape = ", ".join(f"`{n.replace('`', '``')}`: {kind}" for n in names)
    return F.try_variant_get(F.col(record), path(*keys), f"struct<{shape}>")


def whole_text(shown: Column) -> Column:
    """Integer of a number, boolean or integer-like text shown as text; NULL for anything else."""
    padded = F.when(shown.rlike(_ZERO_FRACTION), F.substring_index(shown, ".", 1).try_cast("bigint"))
    return F.coalesce(shown.try_cast("bigint"), padded, F.when(shown.isin("true", "false"), (shown == "true").cast("bigint")))


def whole_double(shown: Column) -> Column:
    """Integer of a number written with an exponent, as large JSON numbers are."""
    number = F.when(shown.contains("E"), shown.try_cast("decimal(38,9)"))
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def whole_number(value: Column) -> Column:
    """Integer of a number, boolean or integer-like text; NULL for anything else."""
    number, shape = whole_text(text(value)), kind(value)
    return F.when(shape == "DOUBLE", F.coalesce(number, whole_double(text(value)))).when(shape != "STRING", number).otherwise(
        F.when(~text(value).isin("true", "false"), number)
    )


def unwrap_id(value: Column, key: str = "id") -> Column:
    """Integer id given either directly or as an object holding it under `key`."""
    return whole_number(F.coalesce(get(value, key), value))


def plain_id(shown: Column, record: Column, name: str) -> Column:
    """Integer of a field given as text; an object counts as the `id` it holds."""
    shown = F.when(shown.startswith("{"), text(record, name, "id")).otherwise(shown)
    return F.coalesce(whole_text(shown), whole_double(shown))


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later filters and projections read without evaluating them again.

    Catalyst moves a filter below a projection by repeating the projected expressions in it, which
    for record fields means navigating the record once more per use. A generator stops that.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def pin(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """compute_once for many columns: a projection makes them, so that they are compiled and share what they have in common.

    What a generator itself makes is evaluated anew for each use, and not compiled once the code of its stage grows large.
    """
    made = df.withColumn("__made", F.struct(*[c.alias(n) for n, c in columns.items()]))
    return made.select(*[F.col(f"`{n}`") for n in df.columns], F.inline(F.array("__made")))
