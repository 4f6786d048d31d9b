"""Raw deal records to rows of the deal table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.records import compute_once, fields, plain_id, whole_text
from ..functions.values import default_fill, recode_status, safe_date, safe_numeric, safe_timestamp
from ..operators.catalogs import conform_columns
from ..operators.custom_fields import flatten_custom_fields
from ..operators.lookups import enrich_deals
from ..operators.merge import latest_per_id
from ..operators.validate import judge_deals, valid
from ..schema import FIELD_DEFAULTS, MONEY, PERCENT

_TIMES = ["add_time", "update_time", "close_time", "won_time", "lost_time", "first_won_time"]
_IDS = ["creator_user_id", "owner_id", "person_id", "org_id", "stage_id", "pipeline_id"]
_TEXTS = ["title", "status", "currency", "value", "lost_reason", "visible_to", "expected_close_date", "probability"]
_READ = ["id", *_TEXTS, *_TIMES, *_IDS]


def _typed(rows: DataFrame, record: str) -> DataFrame:
    """Typed base columns beside the other ones, from the texts in `__text`."""
    shown = lambda name: F.col(f"__text.{name}")
    number = lambda name: plain_id(shown(name), F.col(record), name)
    typed = {
        "id": number("id").cast("string"),
        "titulo": shown("title"),
        "status": recode_status(shown("status")),
        "currency": shown("currency"),
        "value": F.coalesce(safe_numeric(shown("value"), MONEY), whole_text(shown("value")).cast(MONEY)),
        "lost_reason": shown("lost_reason"),
        "visible_to": shown("visible_to"),
        "expected_close_date": safe_date(shown("expected_close_date")),
        "probability": safe_numeric(shown("probability"), PERCENT),
        **{n: safe_timestamp(shown(n)) for n in _TIMES},
        **{n: number(n) for n in _IDS},
    }
    kept = [c for c in rows.columns if c not in ("__text", "reasons")]
    return default_fill(rows.select(*kept, *[c.alias(n) for n, c in typed.items()]), FIELD_DEFAULTS)


def type_deals(records: DataFrame, record: str = "record") -> DataFrame:
    """Typed base columns of valid records, before names are looked up; other columns stay."""
    return _typed(compute_once(records, {"__text": fields(record, _READ, "string")}), record)


def transform_deals(
    raw: DataFrame,
    dims: dict[str, DataFrame],
    mapping: dict[str, str],
    schema: T.StructType,
    record: str = "record",
    seq: list[str] | None = None,
    evolve: bool = False,
) -> DataFrame:
    """Validate, type, flatten and enrich raw records, then conform them to `schema`; see transform_judged."""
    return transform_judged(judge_records(raw, record), dims, mapping, schema, record, seq, evolve)


def judge_records(raw: DataFrame, record: str = "record") -> DataFrame:
    """Raw records with the texts that typing needs and the reasons to reject them."""
    return judge_deals(raw, _READ, record)


def transform_judged(
    judged: DataFrame,
    dims: dict[str, DataFrame],
    mapping: dict[str, str],
    schema: T.StructType,
    record: str = "record",
    seq: list[str] | None = None,
    evolve: bool = False,
) -> DataFrame:
    """Type, flatten and enrich the valid ones of judged records, then conform them to `schema`.

    `dims` holds users, persons, stages, pipelines and orgs; `mapping` custom field keys to
    columns. With `seq`, only the newest record of each id is kept, before any name is looked up;
    the raw record is gone by then, so only finished columns are shuffled. `evolve` keeps flattened columns that
    the schema does not declare, behind the declared ones.
    """
    given = given_columns(judged, record)
    flat = flatten_judged(valid(judged), mapping, schema, record).drop(record)
    return transform_flat(flat, given, dims, schema, seq, evolve)


def given_columns(judged: DataFrame, record: str = "record") -> list[str]:
    """Columns of judged records that came with them, beside the record."""
    return [c for c in judged.columns if c not in (record, "__text", "reasons")]


def flatten_judged(judged: DataFrame, mapping: dict[str, str], schema: T.StructType, record: str = "record") -> DataFrame:
    """Typed base columns and flattened custom fields of judged records, beside the columns given and the record."""
    return flatten_custom_fields(_typed(judged, record), mapping, record, address_columns={f.name for f in schema.fields})


def transform_flat(
    flat: DataFrame, given: list[str], dims: dict[str, DataFrame], schema: T.StructType, seq: list[str] | None = None, evolve: bool = False
) -> DataFrame:
    """The newest of flattened records, enriched and conformed to `schema`; `given` columns go. See transform_judged."""
    if seq:
        flat = latest_per_id(flat, seq=seq)
    enriched = enrich_deals(flat.drop(*given), **dims)
    conformed, extra = conform_columns(enriched, schema)
    if not evolve:
        return conformed
    wide = T.StructType([*schema.fields, *[enriched.schema[c] for c in extra]])
    return conform_columns(enriched, wide)[0]


def undeclared_columns(mapping: dict[str, str], schema: T.StructType) -> list[str]:
    """Custom columns that `evolve` adds to a table of this schema."""
    declared = {f.name for f in schema.fields}
    return [c for c in dict.fromkeys(mapping.values()) if c not in declared]
