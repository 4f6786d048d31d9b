"""Record validation: which raw deals may enter the table, and why not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.records import fields, get, is_object, kind, pin, text, whole_double, whole_text
from ..functions.values import safe_timestamp

WRAPPED_IDS = ["creator_user_id", "person_id"]
PLAIN_IDS = ["stage_id", "pipeline_id"]
TEXTS = ["title", "status", "currency", "stage_name", "pipeline_name"]
TIMES = ["add_time", "update_time"]
_NUMBERS = ["BIGINT", "DECIMAL", "DOUBLE"]
_FIELDS = ["id", *WRAPPED_IDS, *PLAIN_IDS, *TEXTS, "value", *TIMES]
_SEPARATOR = "; "


def _shape(record: str, *keys: str) -> Column:
    """Kind of a field. Finding it costs more than its text does, so it comes last in a condition."""
    return kind(get(F.col(record), *keys))


def _text(name: str) -> Column:
    return F.col(f"__text.{name}")


def _set(name: str) -> Column:
    """Only an absent field and JSON null have no text."""
    return _text(name).isNotNull()


def _not_whole(shown: Column, shape: Column) -> Column:
    """Whether a field's text is no integer; for one written plainly the kind is not asked for."""
    number = whole_text(shown).isNotNull() & (~shown.isin("true", "false") | (shape != "STRING"))
    other = ~(number | (whole_double(shown).isNotNull() & (shape == "DOUBLE")))
    return F.when(shown.try_cast("bigint").isNotNull(), False).otherwise(shown.isNotNull() & other)


def _bad_int(record: str, name: str) -> Column:
    return _not_whole(_text(name), _shape(record, name))


def _bad_wrapped(record: str, name: str) -> Column:
    """An object counts as its id; one without an id counts as NULL."""
    inside = _not_whole(text(F.col(record), name, "id"), _shape(record, name, "id"))
    return F.when(_text(name).startswith("{") & (_shape(record, name) == "OBJECT"), inside).otherwise(_bad_int(record, name))


def _bad_value(record: str, name: str) -> Column:
    """Numbers, booleans and numeric text pass, NaN included; infinities do not fit the column."""
    number = F.coalesce(F.abs(_text(name).try_cast("double")) != float("inf"), F.lit(False))
    return _set(name) & ~F.when(number, _shape(record, name).isin([*_NUMBERS, "STRING"])).otherwise(_shape(record, name) == "BOOLEAN")


def _bad_time(record: str, name: str) -> Column:
    return _set(name) & ~(safe_timestamp(_text(name)).isNotNull() & _shape(record, name).isin([*_NUMBERS, "STRING"]))


def _joined(checks: list[tuple[Column, str]]) -> Column:
    return F.concat_ws(_SEPARATOR, *[F.when(bad, F.lit(reason)) for bad, reason in checks])


def _broken_ids(record: str) -> Column:
    checks = [(~_set("id"), "id: missing"), (_bad_int(record, "id"), "id: not an integer")]
    checks += [(_bad_wrapped(record, n), f"{n}: not an integer") for n in WRAPPED_IDS]
    checks += [(_bad_int(record, n), f"{n}: not an integer") for n in PLAIN_IDS]
    return _joined(checks)


def _broken_values(record: str) -> Column:
    custom = [F.col(record), "custom_fields"]
    checks = [(_set(n) & (_shape(record, n) != "STRING"), f"{n}: not a text") for n in TEXTS]
    checks += [((F.length(_text("currency")) > 10) & (_shape(record, "currency") == "STRING"), "currency: too long")]
    checks += [(_bad_value(record, "value"), "value: not a number")]
    checks += [(_bad_time(record, n), f"{n}: not a time") for n in TIMES]
    checks += [(~is_object(*custom) & get(*custom).isNotNull(), "custom_fields: not an object")]
    return _joined(checks)


def judge_deals(raw: DataFrame, texts: list[str], record: str = "record") -> DataFrame:
    """Add `reasons`, and `__text` with the text of the fields judged and of `texts`: they are found in one pass over the record.

    A field's kind is looked up where its text alone does not decide.
    """
    seen = raw.withColumn("__text", fields(record, list(dict.fromkeys([*_FIELDS, *texts])), "string"))
    seen = seen.withColumns({"__ids": _broken_ids(record), "__values": _broken_values(record)})
    broken = F.concat_ws(_SEPARATOR, F.nullif("__ids", F.lit("")), F.nullif("__values", F.lit("")))
    none = F.array().cast("array<string>")
    reasons = F.when((F.col("__ids") == "") & (F.col("__values") == ""), none).otherwise(F.split(broken, _SEPARATOR))
    judged = pin(seen.select(*raw.columns, "__text", reasons.alias("__reasons")), {"reasons": F.col("__reasons")})
    return judged.drop("__reasons")


def validate_deals(raw: DataFrame, record: str = "record") -> DataFrame:
    """Add `reasons`: one text per broken rule, empty for a valid record. Rows pass unchanged."""
    return judge_deals(raw, [], record).drop("__text")


def valid(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("reasons") == 0).drop("reasons")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("reasons") > 0)
