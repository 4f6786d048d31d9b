"""Forgiving casts, recoding and defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import STATUS_LABELS

ISO_TIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?( ?(Z|z|[+-]\d{2}(:?\d{2})?))?)?$"
EPOCH = r"^[+-]?\d{1,16}(\.\d+)?$"
# Epoch numbers above this are milliseconds.
_EPOCH_SECONDS_LIMIT = 2e10


def safe_numeric(c: Column, to: str | T.DataType = "double") -> Column:
    """Number, or NULL where the text is not a finite number."""
    if isinstance(to, str) and to in ("double", "float"):
        number = c.try_cast(to)
        return F.when(F.isnan(number) | (F.abs(number) == float("inf")), None).otherwise(number)
    return c.try_cast(to)


def safe_timestamp(c: Column, epoch: bool = True) -> Column:
    """UTC timestamp of ISO text (zone optional) or an epoch number, else NULL.

    A text without zone means UTC whatever the session time zone is.
    """
    text = F.btrim(c.cast("string"))
    sign = lambda place: F.substring(text, place, 1).isin("+", "-")
    zoned = text.endswith("Z") | text.endswith("z") | sign(-6) | sign(-5) | sign(-3)
    day, short = F.length(text) == 10, F.substring(text, 17, 1) != ":"
    full = F.when(short, F.concat(F.substring(text, 1, 16), F.lit(":00"), F.substring(text, 17, 7))).otherwise(text)
    utc = F.when(day, F.concat(text, F.lit("T00:00:00Z"))).when(zoned, full).otherwise(F.concat(full, F.lit("Z")))
    parsed = F.when(text.rlike(ISO_TIME), utc.try_cast("timestamp"))
    if not epoch:
        return parsed
    number = F.when(text.rlike(EPOCH), text.try_cast("double"))
    seconds = F.when(F.abs(number) > _EPOCH_SECONDS_LIMIT, number / 1000).otherwise(number)
    return F.coalesce(parsed, F.timestamp_micros((seconds * 1_000_000).try_cast("bigint")))


def safe_date(c: Column) -> Column:
    """Calendar date written at the start of a valid timestamp text, else NULL."""
    return F.when(safe_timestamp(c, epoch=False).isNotNull(), F.substring(F.btrim(c), 1, 10).try_cast("date"))


def recode_status(c: Column) -> Column:
    """Display label of a status; unknown codes stay as they are, NULL stays NULL."""
    labels = F.create_map(*[F.lit(x) for pair in STATUS_LABELS.items() for x in pair])
    return F.coalesce(labels[c], c)


def default_fill(df: DataFrame, defaults: dict) -> DataFrame:
    """Replace NULL by a default in the named columns, keeping each column's type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({n: F.coalesce(F.col(n), F.lit(v).cast(types[n])) for n, v in defaults.items() if n in types})


def cast_on_load(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All-text rows to typed rows: blank is NULL, text columns stay untouched."""
    def typed(field: T.StructField) -> Column:
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        c = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            return c
        text = F.nullif(F.btrim(c), F.lit(""))
        if isinstance(field.dataType, T.TimestampType):
            return safe_timestamp(text, epoch=False).alias(field.name)
        if isinstance(field.dataType, T.VariantType):
            return F.try_parse_json(text).alias(field.name)
        return text.try_cast(field.dataType).alias(field.name)

    return df.select([typed(f) for f in schema.fields])


def _without_nan(c: Column, kind: T.DataType) -> Column | None:
    """The column with NaN as NULL at every depth, or None where no float is inside."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c)
    if isinstance(kind, T.ArrayType) and _without_nan(c, kind.elementType) is not None:
        return F.transform(c, lambda x: _without_nan(x, kind.elementType))
    if isinstance(kind, T.MapType) and _without_nan(c, kind.valueType) is not None:
        return F.transform_values(c, lambda _, x: _without_nan(x, kind.valueType))
    if isinstance(kind, T.StructType):
        changed = {f.name: _without_nan(c[f.name], f.dataType) for f in kind.fields}
        if any(v is not None for v in changed.values()):
            parts = [(changed[n] if changed[n] is not None else c[n]).alias(n) for n in changed]
            return F.when(c.isNotNull(), F.struct(*parts))
    return None


def canonical_nulls(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every float column, also inside arrays, maps and structs."""
    fixed = {f.name: _without_nan(F.col(f.name), f.dataType) for f in df.schema.fields}
    return df.withColumns({n: c for n, c in fixed.items() if c is not None})
