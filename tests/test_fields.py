"""Hand-written edge tables of the column functions and validation."""

import datetime as dt
import json
import re
import unicodedata
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from funnelwise.functions import canonical_nulls, normalize_endpoint, normalize_name, safe_date, safe_timestamp
from funnelwise.functions.records import get, kind, unwrap_id
from funnelwise.operators.custom_fields import flatten_address, flatten_custom_fields
from funnelwise.operators.validate import rejected, valid, validate_deals
from funnelwise.plans.transform import type_deals


def raw(spark, *records):
    lines = spark.createDataFrame([(i, json.dumps(r) if not isinstance(r, str) else r) for i, r in enumerate(records)], "seq long, line string")
    return lines.select("seq", F.parse_json("line").alias("record"))


def one(df):
    return [r[-1] for r in df.orderBy("seq").collect()]


def slug(name):
    text = unicodedata.normalize("NFKD", name.lower()).encode("ascii", "ignore").decode()
    text = re.sub("[^A-Za-z0-9]+", "_", text).strip("_")
    return ("_" + text if text[:1].isdigit() else text) or "_invalid_normalized_name"


def test_slug_follows_the_rule_on_all_of_unicode(spark):
    points = [*range(0x20, 0xD800), *range(0xE000, 0x1FFFF)]
    names = ["São João", "Em Negociação (2)", "1º Contato", "a—b", "__x__", "***", "", "ação/venda", "étape"]
    names += ["a" + "".join(map(chr, points[i : i + 24])) + " b" for i in range(0, len(points), 24)]
    df = spark.createDataFrame([(n, slug(n)) for n in names], "name string, want string")
    assert df.filter(normalize_name(F.col("name")) != F.col("want")).count() == 0
    assert spark.range(1).select(normalize_name(F.lit(None).cast("string"))).first()[0] == ""


@pytest.mark.parametrize("text, want", [
    ("2024-01-02", "2024-01-02 00:00:00"), ("2024-01-02 03:04:05", "2024-01-02 03:04:05"), ("2024-01-02T03:04:05Z", "2024-01-02 03:04:05"),
    ("2024-01-02T03:04:05.123456-03:00", "2024-01-02 06:04:05.123456"), ("2024-01-02T03:04:05+0300", "2024-01-02 00:04:05"),
    ("2024-01-02T03:04", "2024-01-02 03:04:00"), ("1700000000", "2023-11-14 22:13:20"), ("1700000000000", "2023-11-14 22:13:20"),
    ("", None), ("01/02/2024", None), ("2024-01-02T03:04Z", "2024-01-02 03:04:00"), ("2024-01", None), ("2024-02-30", None), (None, None),
])
def test_safe_timestamp(spark, text, want):
    got = spark.range(1).select(safe_timestamp(F.lit(text).cast("string")).cast("timestamp_ntz")).first()[0]
    assert got == (want and dt.datetime.fromisoformat(want))


def test_safe_timestamp_means_utc_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert spark.range(1).select(F.unix_micros(safe_timestamp(F.lit("1970-01-01 00:00:01")))).first()[0] == 1_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_safe_date_keeps_the_written_day(spark):
    texts = ["2024-01-02T23:00:00-03:00", "2024-01-02", "soon"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(safe_date(F.col("t"))).collect()]
    assert got == [dt.date(2024, 1, 2), dt.date(2024, 1, 2), None]


def test_canonical_nulls_reaches_into_nested_values(spark):
    df = spark.sql("SELECT double('NaN') AS a, array(1.0D, double('NaN')) AS b, named_struct('x', double('NaN'), 'y', 1) AS c, map('k', float('NaN')) AS d, 'NaN' AS e")
    row = canonical_nulls(df).first()
    assert (row.a, row.b, row.c.x, row.c.y, row.d, row.e) == (None, [1.0, None], None, 1, {"k": None}, "NaN")


def test_kinds_and_ids(spark):
    cases = [(5, "BIGINT", 5), (5.0, "DECIMAL", 5), (5.5, "DECIMAL", None), ("5", "STRING", 5), ("5.0", "STRING", 5), ("5.5", "STRING", None),
             (True, "BOOLEAN", 1), ("true", "STRING", None), (None, "VOID", None), ({"id": 7}, "OBJECT", 7), ({"x": 1}, "OBJECT", None), ([1], "ARRAY", None),
             (10**20, "DECIMAL", None), ("", "STRING", None)]
    df = raw(spark, *[{"a": v} for v, _, _ in cases])
    assert one(df.select("seq", kind(get(F.col("record"), "a")))) == [k for _, k, _ in cases]
    assert one(df.select("seq", unwrap_id(get(F.col("record"), "a")))) == [i for _, _, i in cases]
    assert raw(spark, '{"a": 1e3}').select(unwrap_id(get(F.col("record"), "a"))).first()[0] == 1000


GOOD = [
    {"id": 1}, {"id": "5"}, {"id": "5.0"}, {"id": 5.0}, {"id": True}, {"id": 1, "creator_user_id": {"id": 3}}, {"id": 1, "person_id": {"name": "x"}},
    {"id": 1, "person_id": None}, {"id": 1, "title": None, "status": "x"}, {"id": 1, "value": "1e3"}, {"id": 1, "value": "NaN"}, {"id": 1, "value": 2},
    {"id": 1, "add_time": "2024-01-02T03:04:05Z", "update_time": 1700000000}, {"id": 1, "custom_fields": {}}, {"id": 1, "owner_id": "anything"},
]
BAD = [
    ({}, "id"), ({"id": None}, "id"), ({"id": "5.5"}, "id"), ({"id": 5.5}, "id"), ({"id": ""}, "id"), ({"id": "x"}, "id"), ({"id": {"id": 1}}, "id"),
    ({"id": 10**20}, "id"), ({"id": 1, "creator_user_id": {"id": "x"}}, "creator_user_id"), ({"id": 1, "person_id": [1]}, "person_id"),
    ({"id": 1, "stage_id": {"id": 3}}, "stage_id"), ({"id": 1, "pipeline_id": 1.5}, "pipeline_id"), ({"id": 1, "title": 7}, "title"),
    ({"id": 1, "status": {}}, "status"), ({"id": 1, "currency": "BRLBRLBRLBRL"}, "currency"), ({"id": 1, "value": ""}, "value"), ({"id": 1, "value": "n/a"}, "value"),
    ({"id": 1, "value": "Infinity"}, "value"), ({"id": 1, "value": {}}, "value"), ({"id": 1, "add_time": ""}, "add_time"), ({"id": 1, "update_time": "01/02/2024"}, "update_time"),
    ({"id": 1, "add_time": "2024-1"}, "add_time"), ({"id": 1, "custom_fields": None}, "custom_fields"), ({"id": 1, "custom_fields": "{}"}, "custom_fields"),
]


def test_every_accepted_and_rejected_case(spark):
    checked = validate_deals(raw(spark, *GOOD, *[r for r, _ in BAD]))
    reasons = [r.reasons for r in checked.orderBy("seq").collect()]
    assert reasons[: len(GOOD)] == [[]] * len(GOOD)
    assert [[x.split(":")[0] for x in r] for r in reasons[len(GOOD):]] == [[field] for _, field in BAD]
    assert valid(checked).count() == len(GOOD) and rejected(checked).count() == len(BAD)


def test_several_reasons_and_non_objects(spark):
    checked = validate_deals(raw(spark, {"title": 1, "value": ""}, "[1]"))
    assert one(checked) == [["id: missing", "title: not a text", "value: not a number"], ["id: missing"]]


def test_typed_values(spark):
    row = type_deals(raw(spark, {"id": "5.0", "value": "NaN", "visible_to": 3, "owner_id": {"id": 9}, "org_id": 1.5, "status": "won", "probability": "12.345"})).first()
    assert (row.id, row.value, row.visible_to, row.owner_id, row.org_id, row.status) == ("5", Decimal("0.00"), "3", 9, None, "Ganho")
    assert row.probability == Decimal("12.35") and row.currency == "USD" and row.titulo == "" and row.add_time is None


def test_flattening(spark):
    fields = {"a": 1, "b": {"value": {"x": 1}}, "c": {"formatted_address": "", "value": "v", "country": "BR"}, "d": [1, "x"], "e": None, "g": {"y": 1}}
    mapping = {"a": "one", "b": "two", "c": "casa", "d": "list", "e": "one", "f": "none", "g": "two"}
    row = flatten_custom_fields(raw(spark, {"id": 1, "custom_fields": fields}), mapping).first()
    # A later key without a value keeps the earlier one; one that is an object without value clears it.
    assert (row.one, row.two, row.casa, row.casa_pais, row.casa_latitude, row["list"], row.none) == ("1", None, "v", "BR", None, '[1,"x"]', None)
    split = flatten_address(raw(spark, {"c": fields["c"]}).select("seq", get(F.col("record"), "c").alias("c")), "c", "casa").first()
    assert (split.casa, split.casa_pais, split.casa_estado) == ("v", "BR", None)


@pytest.mark.parametrize("url, want", [
    ("https://h.com/v1/deals/7/changelog?x=1", "/deals/detail/changelog"), ("https://h.com/api/v2/deals/7", "/deals/detail"), ("/deals/7/products/9", "/deals/detail/products"),
    ("/deals/7/other/9", "/deals/detail/other/detail"), ("/deals/7/other", "/deals/detail"), ("/persons/search", "/persons/search"), ("/users", "/users"),
    ("https://h.com/v1", "/"), ("/deals/abc/x", "/deals"),
])
def test_endpoint_labels(spark, url, want):
    assert spark.range(1).select(normalize_endpoint(F.lit(url))).first()[0] == want
