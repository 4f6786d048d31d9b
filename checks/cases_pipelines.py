"""End-to-end pipelines and their streaming twins."""

from pyspark.sql import functions as F

from funnelwise.operators import catalogs, merge
from funnelwise.plans import backfill, metadata, sync, transform
from funnelwise.schema import BASE_COLUMNS, BASE_NAMES, SYSTEM_FIELD_KEYS, deal_schema
from funnelwise.sources import tables
from funnelwise.sources.scratch import delete, forget, keep
from funnelwise.sources.scratch import new_folder as scratch_folder
from funnelwise.streaming import streams

from .cases_fields import CALLS, MAPPING, STATUS_SQL, checked_sql, flat_sql, slug_sql
from .cases_logs import _INCREASE, _STEPS, ENTRIES, FIRST_SQL, HISTORY, WIDE_SQL, ANY_NULL, catalog, filled_sql
from .cases_tables import DIM_SQL, DIMS, ENRICHED_SQL, LATEST_SQL, NOW, OLD_PERSONS_SQL, RAW, TIES, UPSERTED_SQL, at, dims, landed, old_persons
from .inputs import load, load_records
from .registry import check

SCHEMA = deal_schema(["origem", "pontos", "etiquetas"])
_SHOWN = {"VARCHAR": "StringType", "BIGINT": "LongType", "DOUBLE": "DecimalType", "TIMESTAMP": "TimestampType", "DATE": "DateType"}
SQL_TYPES = {n: next(k for k, v in _SHOWN.items() if type(t).__name__ == v) for n, t in BASE_COLUMNS}

_TYPED = f"""SELECT k, record, CAST(k AS VARCHAR) AS id, coalesce(record->>'$.title', '') AS titulo, {STATUS_SQL.format("(record->>'$.status')")} AS status,
    coalesce(record->>'$.currency', 'USD') AS currency, coalesce(CAST(record->>'$.value' AS DOUBLE), 0) AS value,
    TRY_CAST(rtrim(record->>'$.add_time', 'Z') AS TIMESTAMP) AS add_time, TRY_CAST(record->>'$.update_time' AS TIMESTAMP) AS update_time,
    TRY_CAST(record->>'$.close_time' AS TIMESTAMP) AS close_time, TRY_CAST(record->>'$.expected_close_date' AS DATE) AS expected_close_date,
    TRY_CAST(record->>'$.probability' AS DOUBLE) AS probability, coalesce(record->>'$.lost_reason', '') AS lost_reason, coalesce(record->>'$.visible_to', '') AS visible_to,
    CAST(coalesce(record->>'$.creator_user_id.id', record->>'$.creator_user_id') AS BIGINT) AS creator_user_id,
    CAST(coalesce(record->>'$.owner_id.id', record->>'$.owner_id') AS BIGINT) AS owner_id, CAST(record->>'$.person_id' AS BIGINT) AS person_id,
    CAST(record->>'$.org_id' AS BIGINT) AS org_id, CAST(record->>'$.stage_id' AS BIGINT) AS stage_id, CAST(record->>'$.pipeline_id' AS BIGINT) AS pipeline_id
    FROM checked WHERE reasons = ''"""
_MADE = set("""id titulo status currency value add_time update_time close_time expected_close_date probability lost_reason visible_to creator_user_id owner_id person_id
    org_id stage_id pipeline_id creator_user_name owner_name stage_name pipeline_name person_name org_name local_do_acidente local_do_acidente_nome_da_rua
    local_do_acidente_cidade_municipio_vila_localidade local_do_acidente_pais local_do_acidente_latitude origem pontos etiquetas""".split())
COLUMNS = [f.name for f in SCHEMA.fields]
_TRANSFORMED = "SELECT " + ", ".join(c if c in _MADE else f"CAST(NULL AS {SQL_TYPES[c]}) AS {c}" for c in COLUMNS) + " FROM enriched"
STEPS = dict(checked=checked_sql(), typed=_TYPED, flat=flat_sql("typed"), enriched=ENRICHED_SQL.format(source="flat"), batch=_TRANSFORMED)
INPUTS = ("deal_json", *DIMS)


@check("SELECT * FROM batch", INPUTS, **STEPS)
def transform_deals(spark, d):
    return transform.transform_deals(load_records(spark, d, "deal_json"), dims(spark, d), MAPPING, SCHEMA, seq=["seq"])


_HELD = "id titulo status currency value add_time update_time stage_id".split()


def held_deals(spark, d):
    """A stored deal table to sync into: the newest change of each id, in the declared columns."""
    newest = merge.latest_per_id(load(spark, d, "changes"), seq=TIES).select(*_HELD)
    return catalogs.conform_columns(newest, SCHEMA)[0]


def stored_deals(spark, d, schema=SCHEMA) -> str:
    """Folder of the held deals as a stored table; they are made once, although a snapshot counts its rows first."""
    folder, held = scratch_folder(spark), keep(held_deals(spark, d).select([f.name for f in schema.fields]))
    tables.write_snapshot(held, folder)
    forget(held)
    return folder


HELD_SQL = "SELECT " + ", ".join(
    ("CAST(value AS DOUBLE) AS value" if c == "value" else c) if c in _HELD else f"CAST(NULL AS {SQL_TYPES.get(c, 'VARCHAR')}) AS {c}" for c in COLUMNS
) + " FROM latest"


def synced_sql(batch: str = "batch", held: str = "held", columns=COLUMNS, kept=("add_time",)) -> str:
    wins = "(s.id IS NOT NULL AND (t.id IS NULL OR t.update_time IS NULL OR s.update_time >= t.update_time))"
    cells = []
    for c in columns[1:]:
        new = f"coalesce(t.{c}, s.{c})" if c in kept else f"s.{c}"
        cells.append(f"CASE WHEN {wins} THEN {new} ELSE t.{c} END AS {c}")
    return f"SELECT coalesce(t.id, s.id) AS id, {', '.join(cells)} FROM {held} t FULL OUTER JOIN {batch} s ON t.id = s.id"


SYNC = dict(**STEPS, latest=LATEST_SQL, held=HELD_SQL)


@check("SELECT * FROM synced", (*INPUTS, "changes"), **SYNC, synced=synced_sql())
def sync_deals(spark, d):
    return sync.sync_deals(held_deals(spark, d), load_records(spark, d, "deal_json"), dims(spark, d), MAPPING, SCHEMA)[0]


_SINCE = "1996-06-01 00:00:00"


@check(
    "SELECT * FROM synced", (*INPUTS, "changes"), **SYNC, late=f"SELECT * FROM batch WHERE update_time >= TIMESTAMP '{_SINCE}'", synced=synced_sql("late"),
)
def sync_deals_since(spark, d):
    since = F.lit(_SINCE).cast("timestamp")
    return sync.sync_deals(held_deals(spark, d), load_records(spark, d, "deal_json"), dims(spark, d), MAPPING, SCHEMA, since)[0]


_CELLS = HISTORY[:2]
_TRACKED = deal_schema(["origem", "pontos", "etiquetas"], _CELLS)
_HISTORY_STEPS = dict(
    **SYNC, held2=f"SELECT *, add_time AS {_CELLS[0]}, CASE WHEN stage_id % 2 = 0 THEN update_time END AS {_CELLS[1]} FROM held",
    batch2=f"SELECT *, CAST(NULL AS TIMESTAMP) AS {_CELLS[0]}, CAST(NULL AS TIMESTAMP) AS {_CELLS[1]} FROM batch",
)


def _with_history(spark, d, rule):
    held = held_deals(spark, d).withColumns({_CELLS[0]: F.col("add_time"), _CELLS[1]: F.when(F.col("stage_id") % 2 == 0, F.col("update_time"))})
    return sync.sync_deals(held, load_records(spark, d, "deal_json"), dims(spark, d), MAPPING, _TRACKED, history=rule)[0]


@check("SELECT * FROM synced", (*INPUTS, "changes"), **_HISTORY_STEPS, synced=synced_sql("batch2", "held2", [*COLUMNS, *_CELLS]))
def sync_deals_history_overwrite(spark, d):
    return _with_history(spark, d, "overwrite")


@check("SELECT * FROM synced", (*INPUTS, "changes"), **_HISTORY_STEPS, synced=synced_sql("batch2", "held2", [*COLUMNS, *_CELLS], ["add_time", *_CELLS]))
def sync_deals_history_preserve(spark, d):
    return _with_history(spark, d, "preserve")


@check("SELECT * FROM batch", INPUTS, **STEPS)
def transform_deals_evolve(spark, d):
    """Two custom columns that the table does not declare yet are loaded in the same run."""
    raw = load_records(spark, d, "deal_json")
    return transform.transform_deals(raw, dims(spark, d), MAPPING, deal_schema(["origem"]), seq=["seq"], evolve=True)


@check(
    """SELECT column_name AS "column", 'TEXT' AS type FROM (SELECT unnest(['pontos', 'etiquetas']) AS column_name) c WHERE (SELECT count(*) FROM deal_json) > 0""", ("deal_json",),
)
def evolved_column_types(spark, d):
    schema = deal_schema(["origem"])
    flat = transform.transform_deals(load_records(spark, d, "deal_json"), dims(spark, d), MAPPING, schema, seq=["seq"], evolve=True)
    return catalogs.select_new_column_types(flat, transform.undeclared_columns(MAPPING, schema))


_FIELD_SQL = f"""SELECT key AS api_key, {slug_sql('name')} AS slug FROM field_meta WHERE name <> '' AND key NOT IN ({", ".join(f"'{k}'" for k in SYSTEM_FIELD_KEYS)})"""


@check(
    f"""SELECT 'mapping' AS part, api_key AS name, slug AS kind FROM fields WHERE slug <> '_invalid_normalized_name'
        UNION ALL SELECT DISTINCT 'column', slug, 'text' FROM fields WHERE slug NOT IN ('_invalid_normalized_name', {", ".join(f"'{n}'" for n in BASE_NAMES)}) AND NOT starts_with(slug, 'moved_to_stage_')
        UNION ALL SELECT 'column', 'moved_to_stage_negociacao_' || id || '_' || id, 'time' FROM stage_meta WHERE id <> 0""",
    ("field_meta", "stage_meta"), fields=_FIELD_SQL,
)
def deal_plan(spark, d):
    """The declarations made from metadata, as rows."""
    return metadata.deal_plan(load(spark, d, "field_meta"), load(spark, d, "stage_meta")).rows()


@check(
    """SELECT count(*) AS fetched, count(*) FILTER (reasons = '') AS validated, count(*) FILTER (reasons = '') AS loaded, count(*) FILTER (reasons <> '') AS failed,
        'success' AS status, 'ETL completed. Fetched=' || count(*) || ', Validated=' || count(*) FILTER (reasons = '') || ', Loaded=' || count(*) FILTER (reasons = '')
        || ', Failed=' || count(*) FILTER (reasons <> '') || '.' AS message, max(CAST(record->>'$.update_time' AS TIMESTAMP)) + INTERVAL 1 SECOND AS watermark FROM checked""",
    ("deal_json",), checked=checked_sql(),
)
def sync_deals_summary(spark, d):
    return sync.sync_deals(held_deals(spark, d), load_records(spark, d, "deal_json"), dims(spark, d), MAPPING, SCHEMA)[1]


@check("SELECT * FROM synced", (*INPUTS, "changes"), **SYNC, synced=synced_sql())
def sync_deals_stored(spark, d):
    """The same sync into a stored table, appending the merged rows of the batch's ids only."""
    folder = stored_deals(spark, d)
    sync.sync_into_table(folder, 1, load_records(spark, d, "deal_json"), dims(spark, d), MAPPING, SCHEMA)
    return tables.read_table(spark, folder, schema=SCHEMA)


_CHOSEN = f"SELECT id FROM tracked WHERE {ANY_NULL} ORDER BY add_time ASC NULLS LAST, id LIMIT 5000"
_SOME_WIDE = WIDE_SQL.replace("FROM entries", "FROM entries WHERE CAST(deal_id AS VARCHAR) IN (SELECT id FROM chosen)")


@check("SELECT * FROM filled", ("tracked", "changelog"), entries=ENTRIES, chosen=_CHOSEN, wide=_SOME_WIDE, filled=filled_sql())
def backfill_stage_history(spark, d):
    return backfill.backfill_stage_history(load(spark, d, "tracked"), load(spark, d, "changelog"), catalog(spark, d), HISTORY, 5000)[0]


@check(
    f"SELECT (SELECT count(*) FROM tracked WHERE {ANY_NULL}) AS initial, (SELECT count(*) FROM chosen) AS processed, (SELECT count(*) FROM filled WHERE {ANY_NULL}) AS remaining",
    ("tracked", "changelog"), entries=ENTRIES, chosen=_CHOSEN, wide=_SOME_WIDE, filled=filled_sql(),
)
def backfill_stage_history_progress(spark, d):
    return backfill.backfill_stage_history(load(spark, d, "tracked"), load(spark, d, "changelog"), catalog(spark, d), HISTORY, 5000)[1]


_DIM_KEYS = {"users": ("user_id", "user_name"), "persons": ("person_id", "person_name"), "stages": ("stage_id", "stage_name"), "pipelines": ("pipeline_id", "pipeline_name"), "orgs": ("org_id", "org_name")}


@check(
    " UNION ALL ".join(
        f"SELECT '{e}' AS entity, {k} AS id, {n} AS name, TIMESTAMP '{NOW}' AS last_synced_at FROM dim_{e} "
        f"UNION ALL SELECT '{e}', {k}, {n}, TIMESTAMP '2020-01-01 00:00:00' FROM {e} WHERE {k} NOT IN (SELECT {k} FROM dim_{e})"
        for e, (k, n) in _DIM_KEYS.items()
    ),
    (*RAW.values(), *DIMS), **{f"dim_{e}": s for e, s in DIM_SQL.items()},
)
def sync_dimensions(spark, d):
    targets = {n: t.withColumn("last_synced_at", at("2020-01-01 00:00:00")) for n, t in dims(spark, d).items()}
    raws = {e: load_records(spark, d, r) for e, r in RAW.items()}
    tables, _ = sync.sync_dimensions(targets, raws, at(NOW))
    out = None
    for entity, (key, name) in _DIM_KEYS.items():
        part = tables[entity].select(F.lit(entity).alias("entity"), F.col(key).alias("id"), F.col(name).alias("name"), "last_synced_at")
        out = part if out is None else out.unionByName(part)
    return out


@check(UPSERTED_SQL, ("person_json",), fresh=DIM_SQL["persons"], old=OLD_PERSONS_SQL)
def sync_dimensions_later_run(spark, d):
    """Two fetches whose pages count from 1: the later one wins, whatever its page numbers."""
    def fetch(day, first_page, shown):
        lines = load(spark, d, "person_json").withColumn("record", F.replace("record", F.lit('"name":"'), F.lit(f'"name":"{shown}')))
        seq = F.struct(F.lit(day).cast("timestamp").alias("landed_at"), (F.col("k") % 7 + first_page).alias("page_no"), F.col("k").alias("place"))
        return lines.select(F.parse_json("record").alias("record"), seq.alias("seq"))

    raw = fetch("2024-01-01", 500, "stale ").unionByName(fetch("2024-01-02", 1, ""))
    return sync.sync_dimensions({"persons": old_persons(spark, d)}, {"persons": raw}, at(NOW))[0]["persons"]


# --- Streams: landed files in several micro-batches, results as in batch

_KEPT = "k % 23 <> 0 AND k % 19 <> 0"
_STREAMED = {**STEPS, "typed": f"{_TYPED} AND {_KEPT}"}


def _run(query):
    query.awaitTermination()


def _run_pages(spark, d, start):
    """Start a stream of landed pages and wait for its end: three micro-batches, whatever the number of files, each with a file for every core.

    What it leaves holds no page, so the files go as it ends.
    """
    folder, files = landed(spark, d, files=3 * spark.sparkContext.defaultParallelism)
    try:
        _run(start(streams.stream_deals(spark, folder, max_files=-(-files // 3))))
    finally:
        delete(spark, folder)


@check(
    f"SELECT record->>'$.title' AS title, CAST(sum(CASE WHEN k % 2 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS n FROM deal_json WHERE {_KEPT} GROUP BY record->>'$.title'", ("deal_json",),
)
def stream_deals(spark, d):
    out, marks = scratch_folder(spark), scratch_folder(spark)
    title = F.try_variant_get("record", "$.title", "string").alias("title")
    _run_pages(spark, d, lambda s: s.select(title).writeStream.format("parquet").option("path", out).option("checkpointLocation", marks).trigger(availableNow=True).start())
    return spark.read.parquet(out).groupBy("title").agg(F.count("*").alias("n"))


@check("SELECT * FROM synced", (*INPUTS, "changes"), **{**_STREAMED, "latest": LATEST_SQL, "held": HELD_SQL}, synced=synced_sql())
def stream_sync(spark, d):
    folder = stored_deals(spark, d)
    _run_pages(spark, d, lambda s: streams.stream_sync(s, folder, dims(spark, d), MAPPING, SCHEMA, scratch_folder(spark)))
    return tables.read_table(spark, folder, schema=SCHEMA)


NARROW = deal_schema(["origem"])


@check("SELECT * FROM synced", (*INPUTS, "changes"), **{**_STREAMED, "latest": LATEST_SQL, "held": HELD_SQL}, synced=synced_sql())
def stream_sync_evolving(spark, d):
    """The same into a table that lacks two custom columns, which the batches add."""
    folder = stored_deals(spark, d, NARROW)
    _run_pages(spark, d, lambda s: streams.stream_sync(s, folder, dims(spark, d), MAPPING, NARROW, scratch_folder(spark), fold_every=2, evolve=True))
    return tables.read_table(spark, folder, schema=tables.table_schema(spark, folder, NARROW))


@check(f"SELECT max(CAST(record->>'$.update_time' AS TIMESTAMP)) + INTERVAL 1 SECOND AS watermark FROM deal_json WHERE {_KEPT}", ("deal_json",))
def stream_watermark(spark, d):
    out = scratch_folder(spark)
    _run_pages(spark, d, lambda s: streams.stream_watermark(s, out, scratch_folder(spark)))
    return streams.read_watermark(spark, out)


@check('SELECT deal_id, "column", ts FROM first_entries', ("changelog",), entries=ENTRIES, first_entries=FIRST_SQL)
def stream_first_entry(spark, d):
    log, folder, out = load(spark, d, "changelog"), scratch_folder(spark), scratch_folder(spark)
    log.repartition(3).write.parquet(folder)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    _run(streams.stream_first_entry(stream, catalog(spark, d), out, scratch_folder(spark)))
    return streams.read_first_entry(spark, out)


@check(UPSERTED_SQL, ("person_json",), fresh=DIM_SQL["persons"], old=OLD_PERSONS_SQL)
def stream_dim_sync(spark, d):
    held = scratch_folder(spark)
    tables.write_snapshot(old_persons(spark, d), held, "person_id")
    lines, folder = load(spark, d, "person_json"), scratch_folder(spark)
    lines.repartition(3).write.parquet(folder)
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    records = stream.select(F.parse_json("record").alias("record"), F.col("k").alias("seq"))
    _run(streams.stream_dim_sync(records, "persons", held, at(NOW), scratch_folder(spark)))
    return tables.read_table(spark, held, "person_id")


@check(
    f"""SELECT CAST(sum(n) AS BIGINT) AS fetched, CAST(sum(n) FILTER (reasons = '') AS BIGINT) AS valid, CAST(sum(n) FILTER (reasons <> '') AS BIGINT) AS failed
        FROM (SELECT *, CASE WHEN k % 2 = 0 THEN 2 ELSE 1 END AS n FROM checked WHERE {_KEPT}) c""", ("deal_json",), checked=checked_sql(),
)
def stream_batch_stats(spark, d):
    out = scratch_folder(spark)
    _run_pages(spark, d, lambda s: streams.stream_batch_stats(s, out, scratch_folder(spark)))
    return spark.read.parquet(out).agg(*[F.sum(c).alias(c) for c in ("fetched", "valid", "failed")])


@check(
    """SELECT time_bucket(INTERVAL '5 minutes', ts) AS bucket, endpoint, count(*) AS calls, count(*) FILTER (outcome <> 'ok') AS errors, sum(duration_s) AS total_s
        FROM labelled GROUP BY 1, 2""",
    ("api_calls",), **CALLS,
)
def stream_api_metrics(spark, d):
    calls, folder, out = load(spark, d, "api_calls"), scratch_folder(spark), scratch_folder(spark)
    calls.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(folder)
    stream = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)
    _run(streams.stream_api_metrics(stream, out, scratch_folder(spark)))
    return streams.read_api_metrics(spark, out)


@check(_INCREASE, ("odd_samples",), steps=_STEPS)
def stream_counter_increase(spark, d):
    """Samples in three files, each of all times: what comes late lies within the lateness."""
    samples, folder, out = load(spark, d, "odd_samples"), scratch_folder(spark), scratch_folder(spark)
    samples.withColumn("ts", F.col("ts").cast("timestamp")).repartition(3).write.parquet(folder)
    stream = spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", 1).parquet(folder)
    _run(streams.stream_counter_increase(stream, out, scratch_folder(spark), lateness="10000 days"))
    return streams.read_counter_increase(spark, out)
