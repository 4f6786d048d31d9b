"""CRM-shaped inputs derived from whole test tables.

Each input is one SQL text that Spark and DuckDB both run, so both engines see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

K = "o_orderkey"
STAGE_IDS = range(1, 25)
HISTORY = sorted(f"moved_to_stage_negociacao_{i}_{i}" for i in STAGE_IDS)


def _history_id(column: str) -> int:
    return int(column.rsplit("_", 1)[1])


def _obj(**fields: str) -> str:
    """SQL text building a JSON object; a value is an SQL expression giving JSON text."""
    parts = ["'{{'"]
    for i, (name, value) in enumerate(fields.items()):
        parts += [f"""'{"," if i else ""}"{name}":'""", value]
    parts.append("'}}'")
    return f"concat({', '.join(parts)})"


def _str(expr: str) -> str:
    return f"""concat('"', {expr}, '"')"""


_STATUS = f"""CASE WHEN {K} % 101 = 0 THEN NULL WHEN {K} % 97 = 0 THEN 'archived' WHEN {K} % 89 = 0 THEN 'deleted'
    WHEN o_orderstatus = 'F' THEN 'won' WHEN o_orderstatus = 'P' THEN 'lost' ELSE 'open' END"""
_HOURS = f"CAST(({K} * 37) % 2000 - 20 AS INT)"
_UPDATED = f"(o_orderdate + INTERVAL '1' HOUR * {_HOURS})"
_CLOSED = f"(o_orderdate + INTERVAL '24' HOUR * CAST({K} % 400 - 5 AS INT))"
_PERSON = f"(o_custkey + CASE WHEN {K} % 83 = 0 THEN 10000000 ELSE 0 END)"
_STAGE_NAME = "concat('Negociação (', CAST(n_nationkey AS STRING), ')')"


def _text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


_ID = f"""CASE WHEN {K} % 103 = 0 THEN {_str(f"concat({_text(K)}, '.0')")} WHEN {K} % 107 = 0 THEN concat({_text(K)}, '.5')
    WHEN {K} % 109 = 0 THEN 'null' ELSE {_text(K)} END"""
_ADDRESS = _obj(
    formatted_address=f"CASE WHEN {K} % 8 = 0 THEN {_str("''")} ELSE {_str(f"concat('R. ', {_text(K)})")} END",
    value=_str(f"concat('v', {_text(K)})"),
    locality=_str("c_name"),
    country=_str("'BR'"),
    route=f"CASE WHEN {K} % 9 = 0 THEN 'null' ELSE {_str(f"concat('r', {_text(K + ' % 7')})")} END",
    latitude=f"concat('-', {_text(f'{K} % 90')}, '.5')",
)
_CUSTOM = f"""CASE WHEN {K} % 157 = 0 THEN 'null' ELSE {_obj(
    f1=_str(f"concat('c', {_text(f'{K} % 11')})"),
    f2=_obj(value=_text(f"{K} % 13")),
    f3=_ADDRESS,
    f4=f"CASE WHEN {K} % 2 = 0 THEN 'null' ELSE {_text(f'{K} % 17')} END",
    f5=f"concat('[', {_text(f'{K} % 5')}, ',2]')",
)} END"""
_TIME_TEXT = f"""CASE WHEN {K} % 127 = 0 THEN {_str("''")}
    WHEN {K} % 131 = 0 THEN {_str("concat(replace(CAST(o_orderdate AS STRING), ' ', 'T'), 'Z')")}
    ELSE {_str(_text('o_orderdate'))} END"""
_RECORD = _obj(
    id=_ID,
    title=f"CASE WHEN {K} % 10 = 0 THEN 'null' WHEN {K} % 113 = 0 THEN '7' ELSE {_str(f"concat('Order ', {_text(K)})")} END",
    status=f"""coalesce('"' || ({_STATUS}) || '"', 'null')""",
    currency=f"CASE WHEN {K} % 7 = 0 THEN 'null' ELSE {_str("'BRL'")} END",
    value=f"""CASE WHEN {K} % 53 = 0 THEN {_str("'n/a'")} WHEN {K} % 59 = 0 THEN 'null'
        WHEN {K} % 61 = 0 THEN {_str(_text('CAST(o_totalprice AS DECIMAL(18,2))'))}
        ELSE {_text('CAST(o_totalprice AS DECIMAL(18,2))')} END""",
    add_time=_TIME_TEXT,
    update_time=_str(_text(_UPDATED)),
    close_time=f"""CASE WHEN {K} % 137 = 0 THEN {_str("'soon'")} WHEN {K} % 3 = 0 THEN {_str(_text(_CLOSED))} ELSE 'null' END""",
    expected_close_date=f"CASE WHEN {K} % 12 = 5 THEN {_str('substr(CAST(' + _CLOSED + ' AS STRING), 1, 10)')} ELSE 'null' END",
    creator_user_id=f"""CASE WHEN {K} % 3 = 0 THEN {_obj(id=_text(f"{K} % 150"), name=_str("'u'"))} ELSE {_text(f"{K} % 150")} END""",
    owner_id=f"""CASE WHEN {K} % 5 = 0 THEN {_obj(id=_text(f"({K} * 7) % 150"))} ELSE {_text(f"({K} * 7) % 150")} END""",
    person_id=_text(_PERSON),
    org_id=_text(f"({K} * 13) % 2500"),
    stage_id=f"""CASE WHEN {K} % 149 = 0 THEN {_obj(id="'3'")} WHEN {K} % 139 = 0 THEN {_str("'3'")} ELSE {_text(f"{K} % 27")} END""",
    pipeline_id=_text(f"{K} % 6"),
    probability=f"CASE WHEN {K} % 151 = 0 THEN {_str("'high'")} ELSE {_text(f'{K} % 101')} END",
    lost_reason=f"CASE WHEN {K} % 4 = 0 THEN {_str("'price'")} ELSE 'null' END",
    visible_to=f"CASE WHEN {K} % 8 = 0 THEN 'null' ELSE '3' END",
    custom_fields=_CUSTOM,
)

_DEAL_COLUMNS, _DEAL_ROWS = f"SELECT {K} AS k, {_RECORD} AS record", "{orders} JOIN {customer} ON o_custkey = c_custkey"

_EVENT_K = "CAST(replace(replace(props, '{{\"k\": ', ''), '}}', '') AS INT)"
_DAY_SEQ = "((EXTRACT(YEAR FROM o_orderdate) * 12 + EXTRACT(MONTH FROM o_orderdate)) * 31 + EXTRACT(DAY FROM o_orderdate))"
_PRIORITY = "CAST(substr(o_orderpriority, 1, 1) AS INT)"

# Name -> SQL over `{table}` placeholders (test tables or other inputs).
INPUTS: dict[str, str] = {
    "deals": f"""
        SELECT {_text(K)} AS id,
            CASE WHEN {K} % 10 = 0 THEN NULL ELSE concat('Order ', {_text(K)}) END AS titulo,
            {_STATUS} AS status,
            CASE WHEN {K} % 7 = 0 THEN NULL ELSE 'BRL' END AS currency,
            CASE WHEN {K} % 59 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS value,
            CASE WHEN {K} % 67 = 0 THEN NULL ELSE o_orderdate END AS add_time,
            CASE WHEN {K} % 61 = 0 THEN NULL ELSE {_UPDATED} END AS update_time,
            CASE WHEN {K} % 3 = 0 THEN {_CLOSED} ELSE NULL END AS close_time,
            {K} % 150 AS creator_user_id,
            CASE WHEN {K} % 71 = 0 THEN NULL ELSE ({K} * 7) % 150 END AS owner_id,
            {_PERSON} AS person_id,
            {K} % 27 AS stage_id,
            {K} % 6 AS pipeline_id,
            ({K} * 13) % 2500 AS org_id
        FROM {{orders}}""",
    "changes": """
        SELECT CASE WHEN l_linenumber = 7 THEN concat('n', CAST(l_orderkey AS STRING)) ELSE CAST(l_orderkey AS STRING) END AS id,
            concat('Line ', CAST(l_linenumber AS STRING)) AS titulo,
            CASE WHEN l_returnflag = 'R' THEN 'lost' ELSE 'won' END AS status,
            CASE WHEN l_linestatus = 'O' THEN 'USD' ELSE 'BRL' END AS currency,
            CAST(l_extendedprice AS DECIMAL(18,2)) AS value,
            l_shipdate AS add_time,
            CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_shipdate END AS update_time,
            l_partkey % 27 AS stage_id,
            l_partkey AS part, l_suppkey AS supplier, CAST(l_linenumber AS INT) AS line
        FROM {lineitem}""",
    "deal_json": f"{_DEAL_COLUMNS} FROM {_DEAL_ROWS}",
    "page_json": f"""
        SELECT {K} AS k, {_obj(
            entity=_str(f"concat('e', {_text('o_custkey')})"),
            page_no=_text(K),
            success=f"CASE WHEN {K} % 23 = 0 THEN 'false' ELSE 'true' END",
            data=f"CASE WHEN {K} % 19 = 0 THEN '[]' WHEN {K} % 2 = 0 THEN concat('[', record, ',', record, ']') ELSE concat('[', record, ']') END",
            additional_data=f'''CASE WHEN {K} % 4 < 2 THEN {_obj(pagination=_obj(
                more_items_in_collection=f"CASE WHEN {K} % 8 = 0 THEN 'false' ELSE 'true' END",
                next_start=f"CASE WHEN {K} % 9 = 0 THEN 'null' ELSE {_text(K)} END"))}
                ELSE {_obj(next_cursor=f"CASE WHEN {K} % 5 = 0 THEN 'null' ELSE {_str(f"concat('c', {_text(K)})")} END")} END''',
        )} AS value
        FROM (SELECT k AS {K}, record, o_custkey FROM {{deal_json}} JOIN {{orders}} ON k = o_orderkey) p""",
    # two fetch runs for each entity; pages left out, starts and cursors that do not follow, failed, empty and final pages
    "chain_json": f"""
        SELECT {_obj(
            entity=_str(f"concat('e', {_text('c')})"),
            run_id=f"CASE WHEN r = 2 THEN 'null' ELSE {_str(f"concat('run', {_text('r')})")} END",
            page_no=_text("n"),
            success=f"CASE WHEN {K} % 53 = 0 THEN 'false' ELSE 'true' END",
            cursor=f"CASE WHEN r = 1 THEN 'null' ELSE {_str(f"concat('c', {_text(f'n + CASE WHEN {K} % 41 = 0 THEN 7 ELSE 0 END')})")} END",
            data=f"CASE WHEN {K} % 47 = 0 THEN '[]' WHEN {K} % 2 = 0 THEN '[{{{{}}}},{{{{}}}}]' ELSE '[1]' END",
            additional_data=f"CASE WHEN r = 1 THEN {_obj(pagination=_obj(
                start=_text(f"100 * n + CASE WHEN {K} % 43 = 0 THEN 1 ELSE 0 END"),
                more_items_in_collection=f"CASE WHEN {K} % 11 = 0 THEN 'false' ELSE 'true' END",
                next_start=f"CASE WHEN {K} % 37 = 0 THEN 'null' ELSE {_text('100 * n + 100')} END"))} ELSE {_obj(
                next_cursor=f"CASE WHEN {K} % 13 = 0 THEN 'null' ELSE {_str(f"concat('c', {_text('n + 1')})")} END")} END",
        )} AS value
        FROM (SELECT o_orderkey, c, r, row_number() OVER (PARTITION BY c, r ORDER BY o_orderkey) AS n
            FROM (SELECT o_orderkey, o_custkey % 97 AS c, 1 + o_orderkey % 2 AS r FROM {{orders}}) o) p WHERE {K} % 29 <> 0""",
    "users": "SELECT s_suppkey AS user_id, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_name END AS user_name, s_acctbal >= 0 AS is_active FROM {supplier}",
    "persons": "SELECT c_custkey AS person_id, c_name AS person_name, CAST(c_nationkey AS BIGINT) AS org_id FROM {customer}",
    "stages": f"""SELECT CAST(n_nationkey AS BIGINT) AS stage_id, {_STAGE_NAME} AS stage_name,
        CASE WHEN n_nationkey % 6 = 5 THEN NULL ELSE lower(n_name) END AS normalized_name FROM {{nation}}""",
    "pipelines": "SELECT CAST(r_regionkey AS BIGINT) AS pipeline_id, r_name AS pipeline_name, true AS is_active FROM {region}",
    "orgs": "SELECT p_partkey AS org_id, p_name AS org_name FROM {part}",
    "stage_meta": f"SELECT CAST(n_nationkey AS BIGINT) AS id, {_STAGE_NAME} AS name FROM {{nation}}",
    "field_meta": """
        SELECT CASE WHEN p_partkey % 50 = 0 THEN 'value' ELSE concat('f', CAST(p_partkey AS STRING)) END AS key,
            CASE WHEN p_partkey % 11 = 0 THEN '' WHEN p_partkey % 13 = 0 THEN '***' WHEN p_partkey % 17 = 0 THEN 'Título'
                WHEN p_partkey % 19 = 0 THEN concat('moved_to_stage_', p_name) ELSE concat('Área ', p_name, ' / ', CAST(p_partkey % 40 AS STRING)) END AS name
        FROM {part}""",
    "user_json": f"""SELECT s_suppkey AS k, concat('{{{{"id":', {_text('s_suppkey')},
        CASE WHEN s_suppkey % 7 = 0 THEN '' WHEN s_suppkey % 11 = 0 THEN ',"name":null' ELSE concat(',"name":', {_str('s_name')}) END,
        CASE WHEN s_suppkey % 5 = 0 THEN '' WHEN s_acctbal >= 5000 THEN ',"active_flag":true' ELSE ',"active_flag":false' END, '}}}}') AS record FROM {{supplier}}""",
    "person_json": f"""SELECT c_custkey AS k, concat('{{{{"id":', {_text('c_custkey')},
        CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN ',"name":"  "' ELSE concat(',"name":" ', c_name, ' "') END,
        CASE WHEN c_custkey % 3 = 0 THEN concat(',"org_id":', {_obj(value=_text('c_nationkey'))}) WHEN c_custkey % 3 = 1 THEN concat(',"org_id":', {_text('c_nationkey')})
            ELSE ',"org_id":null' END, '}}}}') AS record FROM {{customer}}""",
    "stage_json": f"""SELECT n_nationkey AS k, concat('{{{{"id":', {_text('n_nationkey')},
        CASE WHEN n_nationkey % 6 = 1 THEN concat(',"name":"moved_to_stage_', n_name, '"') WHEN n_nationkey % 6 = 2 THEN ',"name":null'
            WHEN n_nationkey % 6 = 3 THEN '' ELSE concat(',"name":', {_str(_STAGE_NAME)}) END,
        ',"pipeline_id":', {_text('n_regionkey')}, ',"order_nr":', {_text('n_nationkey % 5')}, '}}}}') AS record FROM {{nation}}""",
    "pipeline_json": f"""SELECT r_regionkey AS k, concat('{{{{"id":', {_text('r_regionkey')}, ',"name":', {_str('r_name')},
        CASE WHEN r_regionkey = 2 THEN ',"active_flag":false' ELSE '' END, '}}}}') AS record FROM {{region}}""",
    "org_json": f"""SELECT p_partkey AS k, concat('{{{{"id":', {_text('p_partkey')},
        CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 11 = 0 THEN ',"name":null' ELSE concat(',"name":', {_str('p_name')}) END, '}}}}') AS record FROM {{part}}""",
    "changelog": f"""
        SELECT user_id AS deal_id, CASE WHEN event_type IN ('signup', 'error') THEN 'value' ELSE 'stage_id' END AS field_key,
            CASE WHEN event_id % 41 = 0 THEN 'x' ELSE CAST({_EVENT_K} % 27 AS STRING) END AS new_value,
            CASE WHEN event_id % 43 = 0 THEN 'bad' ELSE substr(CAST(ts AS STRING), 1, 19) END AS time
        FROM {{events}}""",
    "tracked": f"""
        SELECT {_text(K)} AS id, CASE WHEN {K} % 67 = 0 THEN NULL ELSE o_orderdate END AS add_time,
            {', '.join(f"CASE WHEN {K} % 5 = 0 OR ({K} + {_history_id(c)}) % 3 = 0 THEN o_orderdate ELSE NULL END AS {c}" for c in HISTORY)}
        FROM {{orders}}""",
    "api_calls": """
        SELECT event_id, ts, concat('job', CAST(user_id % 3 AS STRING)) AS job, 'GET' AS method,
            concat('https://crm.example.com', CASE event_type
                WHEN 'view' THEN '/api/v2/deals?limit=500'
                WHEN 'click' THEN concat('/v1/deals/', CAST(user_id AS STRING), '/changelog')
                WHEN 'signup' THEN concat('/api/v2/persons/', CAST(user_id AS STRING))
                WHEN 'purchase' THEN '/v1/users' ELSE '/v1/organizations/search' END) AS url,
            CASE WHEN event_type <> 'error' THEN 200 WHEN event_id % 4 = 0 THEN 429 WHEN event_id % 4 = 1 THEN 500 ELSE NULL END AS status_code,
            CASE WHEN event_type <> 'error' THEN 'ok' WHEN event_id % 4 < 2 THEN 'request_exception'
                WHEN event_id % 4 = 2 THEN 'timeout' ELSE 'connection_error' END AS outcome,
            value / 10 AS duration_s,
            CASE WHEN event_id % 7 = 0 THEN NULL ELSE 10000 - event_id % 10000 END AS rate_remaining,
            event_id % 60 AS rate_reset
        FROM {events}""",
    "runs": f"""
        SELECT substr(CAST(o_orderdate AS STRING), 1, 7) AS experiment,
            CAST({_DAY_SEQ} * 10 + {_PRIORITY} AS BIGINT) AS seq,
            CASE WHEN {_PRIORITY} < 3 THEN 'sync' ELSE 'backfill' END AS flow_type,
            o_orderdate AS start_ts, o_orderdate + INTERVAL '1' HOUR * {_PRIORITY} AS end_ts,
            CASE WHEN min({K}) % 17 = 0 THEN 'error' ELSE 'success' END AS status,
            CAST(300 + 100 * (min({K}) % 8) AS INT) AS batch_size,
            count(*) AS fetched,
            CASE WHEN min({K}) % 19 = 0 THEN CAST(0 AS BIGINT) ELSE count(*) END AS loaded,
            CAST(sum({K} % 50) * 200 + 1 AS DOUBLE) AS duration_s,
            CAST(sum({K} % 900) * 5 + 50 AS DOUBLE) AS peak_memory_mb,
            CASE WHEN min({K}) % 29 = 0 THEN -1 WHEN min({K}) % 4 = 0 THEN CAST(min({K}) % 5 AS INT) ELSE 0 END AS data_quality_issues
        FROM {{orders}} GROUP BY o_orderdate, o_orderpriority""",
    "batches": """
        SELECT l_orderkey AS run_id, CAST(l_linenumber AS INT) AS batch_id, concat('flow', CAST(l_orderkey % 3 AS STRING)) AS flow_type,
            CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS original,
            CAST(sum(CASE WHEN l_returnflag = 'R' AND l_discount > 0.055 THEN 1 ELSE 0 END) AS BIGINT) AS schema_failed,
            CAST(sum(CASE WHEN l_returnflag = 'R' AND l_discount < 0.055 AND l_tax > 0.045 THEN 1 ELSE 0 END) AS BIGINT) AS transform_failed,
            CAST(sum(l_quantity) AS BIGINT) AS loaded, CAST(sum(l_quantity) AS BIGINT) / 100.0E0 AS transform_s,
            CAST(sum(l_quantity) AS BIGINT) / 50.0E0 AS load_s
        FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "backfill_batches": """
        SELECT l_orderkey AS run_id, CAST(l_linenumber AS INT) AS batch_id,
            CASE WHEN l_orderkey % 13 = 0 THEN CAST(-1 AS BIGINT) ELSE CAST(100 AS BIGINT) END AS initial,
            CAST(l_quantity AS BIGINT) AS processed,
            CASE WHEN l_discount > 0.085 THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS api_errors,
            CASE WHEN l_tax > 0.075 THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS processing_errors,
            CASE WHEN l_discount > 0.085 OR l_tax > 0.075 THEN 'partial_success' WHEN l_returnflag = 'N' THEN 'skipped' ELSE 'success' END AS status
        FROM {lineitem}""",
    "db_ops": """
        SELECT ts, event_type AS operation, value / 10 AS duration_s, CAST(event_id % 8 AS INT) AS active, CAST(user_id % 5 AS INT) AS idle
        FROM {events}""",
    "sync_runs": f"""
        SELECT o_orderdate AS ts, CASE {_PRIORITY} WHEN 1 THEN 'users' WHEN 2 THEN 'persons' WHEN 3 THEN 'stages' WHEN 4 THEN 'pipelines' ELSE 'organizations' END AS entity_type,
            CASE WHEN {K} % 17 = 0 THEN 'error' ELSE 'success' END AS status, {K} % 1000 AS records
        FROM {{orders}}""",
    "cache_events": "SELECT ts, event_type AS entity, event_id % 3 <> 0 AS hit FROM {events}",
    # a NULL group, infinities, not-a-number and an outlier
    "odd_ops": """
        SELECT CASE WHEN operation = 'click' AND active < 3 THEN NULL ELSE operation END AS operation,
            CASE WHEN operation = 'view' AND active = 1 THEN CAST('infinity' AS DOUBLE) WHEN operation = 'purchase' AND active = 2 THEN CAST('-infinity' AS DOUBLE)
                WHEN operation = 'signup' AND active = 3 THEN CAST('nan' AS DOUBLE) WHEN operation = 'click' AND active = 7 AND idle = 1 THEN 1e9 + duration_s ELSE duration_s END AS duration_s
        FROM {db_ops}""",
    "odd_samples": "SELECT ts, CASE WHEN series LIKE '%2' THEN NULL ELSE series END AS series, value FROM {counter_samples}",
    "odd_runs": "SELECT seq, CASE WHEN seq % 7 < 2 THEN NULL ELSE flow_type END AS flow_type, start_ts, batch_size, duration_s, peak_memory_mb FROM {runs}",
    "counter_samples": "SELECT ts, concat(event_type, CAST(user_id % 3 AS STRING)) AS series, CAST(event_id % 500 AS DOUBLE) AS value FROM {events}",
}


#: Rows of a table that one task takes where an input deals them out.
TASK_ROWS = 250_000
#: Input -> the table whose rows are dealt out before the input is built from them, and the keys by which (none: evenly).
_DEALT = {"batches": ("lineitem", ["l_orderkey", "l_linenumber"]), "field_meta": ("part", []), "deal_json": ("orders", [K])}
#: Input -> its columns and the joined rows it is made of, where the joined rows are dealt out: a later join by the key then shuffles no text.
_JOINED = {"deal_json": (_DEAL_COLUMNS, _DEAL_ROWS)}


def parts_for(rows: int, each: int, least: int = 1) -> int:
    """How many parts of about `each` rows."""
    return max(least, -(-rows // each))


def load(spark: SparkSession, sf_dir: str, name: str, parts: int | None = None) -> DataFrame:
    """A test table or a derived input, made in `parts` parts where rows are dealt out; without it their number follows the rows."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = INPUTS[name]
    used = {n: load(spark, sf_dir, n, parts) for n in [*TABLES, *INPUTS] if "{" + n + "}" in sql}
    if name not in _DEALT:
        return spark.sql(sql, **used)
    table, keys = _DEALT[name]
    parts = parts or _parts(used[table])
    if name in _JOINED:
        columns, rows = _JOINED[name]
        return spark.sql(f"{columns} FROM {{dealt}}", dealt=spark.sql(f"SELECT * FROM {rows}", **used).repartition(parts, *keys))
    used[table] = used[table].repartition(parts, *keys)
    return spark.sql(sql, **used)


def _parts(table: DataFrame) -> int:
    """Every core has a share and no task more than TASK_ROWS, as a test table comes as few files or row groups."""
    return parts_for(table.count(), TASK_ROWS, table.sparkSession.sparkContext.defaultParallelism)


def _spread(df: DataFrame) -> DataFrame:
    """Give every core a share, as a test table comes as fewer files than there are cores."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


#: Bytes of a method that the JVM still compiles.
_METHOD_BYTES = 8000


def compiled(spark: SparkSession) -> SparkSession:
    """The session, set to generate methods that the JVM compiles: the code that reads records is large, and one method runs many times slower."""
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > _METHOD_BYTES:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", _METHOD_BYTES)
    return spark


def load_records(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A JSON input with its `record` as VARIANT and its key as arrival order `seq`."""
    lines = load(compiled(spark), sf_dir, name)
    lines = lines if name in _DEALT else _spread(lines)
    return lines.select(F.parse_json("record").alias("record"), F.col("k").cast("bigint").alias("seq"))


def with_inputs(names: list[str], query: str, **more: str) -> str:
    """DuckDB text of a query over derived inputs; `more` adds CTEs of its own."""
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        sql = INPUTS[name]
        for other in INPUTS:
            if "{" + other + "}" in sql:
                add(other)
        ordered[name] = sql.format(**{n: n for n in [*TABLES, *INPUTS]})

    for name in names:
        add(name)
    ordered.update(more)
    parts = ", ".join(f"{n} AS ({s})" for n, s in ordered.items())
    return f"WITH {parts} {query}" if parts else query
