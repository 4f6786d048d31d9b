"""Scalars, validation, flattening and catalogs."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelwise.functions import normalize_endpoint, normalize_name, recode_status, safe_date, safe_numeric, safe_timestamp, unwrap_id, values
from funnelwise.functions.records import get, text
from funnelwise.operators import api_log, catalogs, custom_fields
from funnelwise.operators.validate import validate_deals
from funnelwise.schema import HISTORY_PREFIX, SYSTEM_FIELD_KEYS

from .inputs import load, load_records
from .registry import check

STATUS_SQL = "CASE {0} WHEN 'won' THEN 'Ganho' WHEN 'lost' THEN 'Perdido' WHEN 'open' THEN 'Em aberto' WHEN 'deleted' THEN 'Deletado' ELSE {0} END"


def slug_sql(c: str) -> str:
    """DuckDB text of the slug rule for names of accented letters."""
    ascii_text = f"regexp_replace(strip_accents(lower({c})), '[^\\x00-\\x7F]', '', 'g')"
    trimmed = f"trim(regexp_replace({ascii_text}, '[^A-Za-z0-9]+', '_', 'g'), '_')"
    return f"CASE WHEN {trimmed} = '' THEN '_invalid_normalized_name' WHEN regexp_matches({trimmed}, '^[0-9]') THEN '_' || {trimmed} ELSE {trimmed} END"


def checked_sql() -> str:
    """Reasons of each raw deal, from the JSON types DuckDB sees."""
    kind = lambda f: f"coalesce(json_type(record, '$.{f}'), 'NULL')"
    shown = lambda f: f"(record->>'$.{f}')"
    whole = "'[+-]?[0-9]+(\\.0+)?'"
    cases = [
        f"CASE WHEN {kind('id')} = 'NULL' THEN 'id: missing' WHEN NOT regexp_full_match({shown('id')}, {whole}) THEN 'id: not an integer' END",
        *[f"CASE WHEN {kind(f)} <> 'NULL' AND NOT regexp_full_match(coalesce(record->>'$.{f}.id', {shown(f)}), {whole}) THEN '{f}: not an integer' END" for f in ("creator_user_id", "person_id")],
        *[f"CASE WHEN {kind(f)} <> 'NULL' AND NOT regexp_full_match({shown(f)}, {whole}) THEN '{f}: not an integer' END" for f in ("stage_id", "pipeline_id")],
        *[f"CASE WHEN {kind(f)} NOT IN ('NULL', 'VARCHAR') THEN '{f}: not a text' END" for f in ("title", "status", "currency")],
        f"CASE WHEN {kind('value')} <> 'NULL' AND TRY_CAST({shown('value')} AS DOUBLE) IS NULL THEN 'value: not a number' END",
        *[f"CASE WHEN {kind(f)} <> 'NULL' AND TRY_CAST({shown(f)} AS TIMESTAMP) IS NULL THEN '{f}: not a time' END" for f in ("add_time", "update_time")],
        f"CASE WHEN {kind('custom_fields')} <> 'OBJECT' THEN 'custom_fields: not an object' END",
    ]
    return f"SELECT k, record, concat_ws('; ', {', '.join(cases)}) AS reasons FROM deal_json"


@check("SELECT k AS seq, reasons, reasons = '' AS valid FROM checked", ("deal_json",), name="validate_deals", checked=checked_sql())
def validate(spark, d):
    checked = validate_deals(load_records(spark, d, "deal_json"))
    return checked.select("seq", F.array_join("reasons", "; ").alias("reasons"), (F.size("reasons") == 0).alias("valid"))


@check(
    """SELECT k AS seq, CAST(coalesce(record->>'$.creator_user_id.id', record->>'$.creator_user_id') AS BIGINT) AS creator,
        CAST(coalesce(record->>'$.owner_id.id', record->>'$.owner_id') AS BIGINT) AS owner FROM deal_json""",
    ("deal_json",), name="unwrap_id",
)
def unwrap(spark, d):
    field = lambda n: unwrap_id(get(F.col("record"), n))
    return load_records(spark, d, "deal_json").select("seq", field("creator_user_id").alias("creator"), field("owner_id").alias("owner"))


@check(f"SELECT id, {STATUS_SQL.format('status')} AS status FROM deals", ("deals",), name="recode_status")
def recode(spark, d):
    return load(spark, d, "deals").select("id", recode_status(F.col("status")).alias("status"))


@check(
    "SELECT id, coalesce(titulo, '') AS titulo, coalesce(currency, 'USD') AS currency, CAST(coalesce(value, 0) AS DOUBLE) AS value FROM deals",
    ("deals",),
)
def default_fill(spark, d):
    deals = load(spark, d, "deals").select("id", "titulo", "currency", "value")
    return values.default_fill(deals, {"titulo": "", "currency": "USD", "value": 0})


@check(
    """SELECT k AS seq, TRY_CAST(record->>'$.value' AS DOUBLE) AS value, TRY_CAST(record->>'$.probability' AS DOUBLE) AS probability FROM deal_json""",
    ("deal_json",), name="safe_numeric",
)
def numeric(spark, d):
    shown = lambda n: text(get(F.col("record"), n))
    return load_records(spark, d, "deal_json").select(
        "seq", safe_numeric(shown("value")).alias("value"), safe_numeric(shown("probability"), "decimal(5,2)").alias("probability")
    )


@check(
    """SELECT k AS seq, TRY_CAST(rtrim(record->>'$.add_time', 'Z') AS TIMESTAMP) AS add_time,
        TRY_CAST(record->>'$.update_time' AS TIMESTAMP) AS update_time, TRY_CAST(record->>'$.close_time' AS TIMESTAMP) AS close_time FROM deal_json""",
    ("deal_json",), name="safe_timestamp",
)
def timestamp(spark, d):
    parsed = [safe_timestamp(text(get(F.col("record"), n))).alias(n) for n in ("add_time", "update_time", "close_time")]
    return load_records(spark, d, "deal_json").select("seq", *parsed)


@check("SELECT k AS seq, TRY_CAST(record->>'$.expected_close_date' AS DATE) AS expected FROM deal_json", ("deal_json",), name="safe_date")
def date(spark, d):
    return load_records(spark, d, "deal_json").select("seq", safe_date(text(get(F.col("record"), "expected_close_date"))).alias("expected"))


@check(
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS price,
        CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderdate END AS day,
        CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderkey % 2 = 1 END AS flag, concat(' ', o_orderstatus) AS note FROM orders""",
)
def cast_on_load(spark, d):
    k = F.col("o_orderkey")
    texts = load(spark, d, "orders").select(
        k.cast("string").alias("id"),
        F.when(k % 10 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("o_totalprice").cast("string"))).alias("price"),
        F.when(k % 9 == 0, "").otherwise(F.col("o_orderdate").cast("string")).alias("day"),
        F.when(k % 8 == 0, " ").when(k % 2 == 1, "true").otherwise("false").alias("flag"),
        F.concat(F.lit(" "), "o_orderstatus").alias("note"),
    )
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("price", T.DecimalType(18, 2)), T.StructField("day", T.TimestampType()),
        T.StructField("flag", T.BooleanType()), T.StructField("note", T.StringType()),
    ])
    return values.cast_on_load(texts, schema)


@check("SELECT event_id, event_type, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS value FROM events")
def canonical_nulls(spark, d):
    noisy = F.when(F.col("event_id") % 9 == 0, float("nan")).otherwise(F.col("value")).alias("value")
    return values.canonical_nulls(load(spark, d, "events").select("event_id", "event_type", noisy))


@check(f"SELECT doc_id, {slug_sql('text')} AS slug FROM documents", name="normalize_name")
def slug(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", normalize_name(F.col("text")).alias("slug"))


_PATH = "string_split(trim(split_part(regexp_replace(url, '^https?://[^/?#]+(/api)?(/v[0-9]+)?', ''), '?', 1), '/'), '/')"
ENDPOINT_SQL = f"""
    SELECT *, CASE WHEN coalesce(p[1], '') = '' THEN '/'
        WHEN regexp_full_match(coalesce(p[2], ''), '[0-9]+') THEN
            CASE WHEN p[3] IN ('changelog', 'followers', 'activities', 'files', 'mailMessages', 'participants', 'products') THEN '/' || p[1] || '/detail/' || p[3]
                 WHEN regexp_full_match(coalesce(p[4], ''), '[0-9]+') THEN '/' || p[1] || '/detail/' || p[3] || '/detail'
                 ELSE '/' || p[1] || '/detail' END
        WHEN p[2] IN ('search', 'summary', 'timeline', 'collection', 'products', 'installments') THEN '/' || p[1] || '/' || p[2]
        ELSE '/' || p[1] END AS endpoint
    FROM (SELECT *, {_PATH} AS p FROM source) q"""


@check(
    "SELECT id, endpoint FROM labelled", ("api_calls",), name="normalize_endpoint",
    source="SELECT event_id AS id, url FROM api_calls UNION ALL SELECT -1 - page_id, url FROM pages", labelled=ENDPOINT_SQL,
)
def endpoints(spark, d):
    pages = spark.read.parquet(f"{d}/pages.parquet").select((-1 - F.col("page_id")).alias("id"), "url")
    urls = load(spark, d, "api_calls").select(F.col("event_id").alias("id"), "url").unionByName(pages)
    base = r"^https?://[^/?#]+(/api)?(/v\d+)?"
    return urls.select("id", normalize_endpoint(F.col("url"), base).alias("endpoint"))


_DEFAULT_PATH = "string_split(trim(split_part(regexp_replace(url, '^https?://[^/?]+(?:/api)?/v[0-9]+(/|\\?|$)', '\\1'), '?', 1), '/'), '/')"


@check(
    "SELECT id, endpoint FROM labelled", ("api_calls",),
    source="SELECT event_id AS id, url FROM api_calls UNION ALL SELECT -1 - page_id, url FROM pages", labelled=ENDPOINT_SQL.replace(_PATH, _DEFAULT_PATH),
)
def normalize_endpoint_default_base(spark, d):
    pages = spark.read.parquet(f"{d}/pages.parquet").select((-1 - F.col("page_id")).alias("id"), "url")
    urls = load(spark, d, "api_calls").select(F.col("event_id").alias("id"), "url").unionByName(pages)
    return urls.select("id", normalize_endpoint(F.col("url")).alias("endpoint"))


COST_SQL = """
    SELECT *, CASE WHEN outcome <> 'ok' THEN 0 ELSE CASE endpoint WHEN '/deals/detail/changelog' THEN 20 WHEN '/dealFields' THEN 20 WHEN '/users' THEN 20
        WHEN '/users/detail' THEN 5 WHEN '/deals' THEN 10 WHEN '/stages' THEN 5 WHEN '/pipelines' THEN 5 WHEN '/persons/detail' THEN 1
        WHEN '/persons' THEN 10 ELSE 10 END END AS cost FROM labelled"""
CALLS = dict(source="SELECT * FROM api_calls", labelled=ENDPOINT_SQL, costed=COST_SQL)


@check("SELECT event_id, endpoint, CAST(cost AS BIGINT) AS cost FROM costed", ("api_calls",), **CALLS)
def endpoint_cost(spark, d):
    return api_log.endpoint_cost(load(spark, d, "api_calls")).select("event_id", "endpoint", "cost")


# Custom field key -> column, as the field metadata would give it.
MAPPING = {"f1": "origem", "f2": "pontos", "f3": "local_do_acidente", "f4": "pontos", "f5": "etiquetas"}
_ADDRESS_PARTS = {"route": "nome_da_rua", "locality": "cidade_municipio_vila_localidade", "country": "pais", "latitude": "latitude"}


def flat_sql(source: str) -> str:
    """Custom columns of each record."""
    line = "coalesce(nullif(record->>'$.custom_fields.f3.formatted_address', ''), record->>'$.custom_fields.f3.value')"
    parts = [f"record->>'$.custom_fields.f3.{p}' AS local_do_acidente_{s}" for p, s in _ADDRESS_PARTS.items()]
    return f"""SELECT *, record->>'$.custom_fields.f1' AS origem, coalesce(record->>'$.custom_fields.f4', record->>'$.custom_fields.f2.value') AS pontos,
        {line} AS local_do_acidente, record->>'$.custom_fields.f5' AS etiquetas, {', '.join(parts)} FROM {source}"""


@check(
    "SELECT k AS seq, origem, pontos, local_do_acidente, etiquetas, local_do_acidente_pais FROM flat", ("deal_json",), flat=flat_sql("deal_json"),
)
def flatten_custom_fields(spark, d):
    flat = custom_fields.flatten_custom_fields(load_records(spark, d, "deal_json"), MAPPING, address_columns={"local_do_acidente_pais"})
    return flat.drop("record")


@check(
    """SELECT k AS seq, local_do_acidente AS casa, CAST(NULL AS VARCHAR) AS casa_numero_da_casa, local_do_acidente_nome_da_rua AS casa_nome_da_rua,
        CAST(NULL AS VARCHAR) AS casa_distrito_sub_localidade, local_do_acidente_cidade_municipio_vila_localidade AS casa_cidade_municipio_vila_localidade,
        CAST(NULL AS VARCHAR) AS casa_estado, CAST(NULL AS VARCHAR) AS casa_regiao, local_do_acidente_pais AS casa_pais,
        CAST(NULL AS VARCHAR) AS casa_cep_codigo_postal, local_do_acidente_latitude AS casa_latitude, CAST(NULL AS VARCHAR) AS casa_longitude FROM flat""",
    ("deal_json",), flat=flat_sql("deal_json"),
)
def flatten_address(spark, d):
    held = load_records(spark, d, "deal_json").select("seq", get(F.col("record"), "custom_fields", "f3").alias("f3"))
    return custom_fields.flatten_address(held, "f3", "casa").drop("f3")


CONFORMED = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("status", T.StringType()), T.StructField("stage_id", T.LongType()),
    T.StructField("label", T.StringType()), T.StructField("value", T.DoubleType()),
])


@check("SELECT id, status, stage_id, CAST(NULL AS VARCHAR) AS label, CAST(value AS DOUBLE) AS value FROM deals", ("deals",))
def conform_columns(spark, d):
    return catalogs.conform_columns(load(spark, d, "deals"), CONFORMED)[0]


@check(
    "SELECT id, titulo, status, stage_id, CAST(NULL AS VARCHAR) AS label, CAST(value AS DOUBLE) AS value FROM deals", ("deals",),
)
def ensure_columns(spark, d):
    return catalogs.ensure_columns(load(spark, d, "deals").select("id", "titulo", "status", "stage_id", "value"), CONFORMED)


def _type_sql(column: str, f: str) -> str:
    kind = f"json_type(record, '$.{f}')"
    group = f"CASE WHEN {kind} IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'HUGEINT') THEN 'NUMERIC(18,4)' WHEN {kind} = 'BOOLEAN' THEN 'BOOLEAN' WHEN {kind} <> 'NULL' THEN 'TEXT' END"
    return f"""SELECT '{column}' AS "column", CASE WHEN min({group}) = max({group}) THEN min({group}) ELSE 'TEXT' END AS type FROM deal_json"""


@check(
    " UNION ALL ".join(_type_sql(c, c) for c in ("person_id", "value", "currency", "owner_id", "won_time"))
    + """ UNION ALL SELECT 'added', 'TIMESTAMPTZ' UNION ALL SELECT 'big', 'BOOLEAN'""",
    ("deal_json",),
)
def select_new_column_types(spark, d):
    raw = load_records(spark, d, "deal_json")
    fields = ["person_id", "value", "currency", "owner_id", "won_time"]
    extras = raw.select(
        *[get(F.col("record"), f).alias(f) for f in fields], safe_timestamp(text(get(F.col("record"), "add_time"))).alias("added"),
        (F.col("seq") > 5).alias("big"),
    )
    return catalogs.select_new_column_types(extras, [*fields, "added", "big"])


_SYSTEM = ", ".join(f"'{k}'" for k in SYSTEM_FIELD_KEYS)


@check(
    f"""SELECT api_key, "column", count(*) OVER (PARTITION BY "column") > 1 AS collides FROM (
        SELECT key AS api_key, {slug_sql('name')} AS "column" FROM field_meta WHERE name <> '' AND key NOT IN ({_SYSTEM})) c
        WHERE "column" NOT IN ('_invalid_normalized_name', 'titulo') AND NOT starts_with("column", '{HISTORY_PREFIX}')""",
    ("field_meta",),
)
def custom_field_catalog(spark, d):
    return catalogs.custom_field_catalog(load(spark, d, "field_meta"))


@check(
    f"""SELECT id AS stage_id, '{HISTORY_PREFIX}' || {slug_sql('name')} || '_' || id AS "column" FROM stage_meta
        WHERE id <> 0 AND id <> 4""",
    ("stage_meta",),
)
def stage_column_catalog(spark, d):
    stages = load(spark, d, "stage_meta")
    name = F.concat(F.lit(HISTORY_PREFIX), F.lit("negociacao_"), "id", F.lit("_"), "id")
    taken = stages.filter("id % 23 = 4").select(name.alias("column"))
    return catalogs.stage_column_catalog(stages, taken)


