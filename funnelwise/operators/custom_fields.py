"""Custom fields of a record as flat text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.records import compute_once, fields, path, pin, text
from ..schema import ADDRESS_KEYS, ADDRESS_SUFFIXES


_PARTS = list(dict.fromkeys(["value", *ADDRESS_KEYS, *ADDRESS_SUFFIXES]))
_OBJECT = "struct<" + ", ".join(f"`{p}`: string" for p in _PARTS) + ">"


def _line(shown: Column, held: Column, address: Column) -> Column:
    """Main text of a field: an object's address line or value, else the scalar itself, whose text is not made of an object."""
    line = F.coalesce(F.nullif(held["formatted_address"], F.lit("")), held["value"])
    return F.when(held.isNull(), shown).when(address, line).otherwise(held["value"])


def _is_address(held: Column, record: Column, *keys: str) -> Column:
    """Whether an object has a telling address key; its names are only read where no such key has a text, as JSON null has none."""
    told = F.coalesce(*[held[k] for k in ADDRESS_KEYS]).isNotNull()
    names = F.map_keys(F.try_variant_get(record, path(*keys), "map<string, variant>"))
    return told | (held.isNotNull() & F.arrays_overlap(names, F.array(*[F.lit(k) for k in ADDRESS_KEYS])))


def _last_line(choices: list[tuple[Column, Column]]) -> Column:
    """Line of the last field that is set, NULL if none is; an object is set whatever its line."""
    result = F.lit(None).cast("string")
    for held, line in choices:
        result = F.coalesce(line, F.when(held.isNull(), result))
    return result


def _last(choices: list[tuple[Column, Column]]) -> Column:
    """Result of the last choice that applies, NULL if none does."""
    result = F.lit(None).cast("string")
    for applies, value in choices:
        result = F.when(applies, value).otherwise(result)
    return result


def flatten_custom_fields(
    df: DataFrame, mapping: dict[str, str], record: str = "record", address_columns: set[str] | None = None
) -> DataFrame:
    """Add one text column per mapped slug, and address parts as `<slug>_<suffix>`.

    Where two keys share a slug, the last mapped one with a value wins. `address_columns` limits
    the part columns built to those the table declares; None builds all of them. The texts of all objects'
    parts are found in one pass; the other fields are looked up.
    """
    if not mapping:
        return df
    rows = df.withColumn("__held", fields(record, list(mapping), _OBJECT, "custom_fields"))
    held = {key: F.col("__held").getField(key) for key in mapping}
    address = {key: _is_address(held[key], F.col(record), "custom_fields", key) for key in mapping}
    by_slug: dict[str, list[str]] = {}
    for key, slug in mapping.items():
        by_slug.setdefault(slug, []).append(key)
    flat = {}
    for slug, keys in by_slug.items():
        flat[slug] = _last_line([(held[k], _line(text(F.col(record), "custom_fields", k), held[k], address[k])) for k in keys])
        for part, suffix in ADDRESS_SUFFIXES.items():
            name = f"{slug}_{suffix}"
            if (address_columns is None or name in address_columns) and name not in by_slug:
                flat[name] = _last([(address[k], held[k][part]) for k in keys])
    added = {n: c for n, c in flat.items() if n not in df.columns}
    return pin(rows, added).drop("__held") if added else df


def flatten_address(df: DataFrame, value: str, name: str) -> DataFrame:
    """Split one address field (VARIANT) into `name` and its ten component columns."""
    df = compute_once(df, {"__held": F.try_variant_get(F.col(value), "$", _OBJECT)})
    held, address = F.col("__held"), _is_address(F.col("__held"), F.col(value))
    parts = {f"{name}_{s}": F.when(address, held[p]) for p, s in ADDRESS_SUFFIXES.items()}
    return df.withColumns({name: _line(text(F.col(value)), held, address), **parts}).drop("__held")
