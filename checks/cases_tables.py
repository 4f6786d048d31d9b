"""Scans, lookups, dimensions, merging and reconciliation."""

from pyspark.sql import functions as F

from funnelwise.operators import dimensions, lookups, merge, quality, scan
from funnelwise.sources import pages
from funnelwise.sources.export import export_run_metrics_csv
from funnelwise.sources import tables
from funnelwise.sources.scratch import keep, shuffles_dropped
from funnelwise.sources.scratch import new_folder as scratch_folder

from .cases_fields import slug_sql
from .inputs import compiled, load, load_records, parts_for
from .registry import check

SINCE = "1999-06-01 00:00:00"
TODAY = "2001-01-01 00:00:00"


def at(text: str):
    return F.lit(text).cast("timestamp_ntz")


#: Page lines of a landed file.
FILE_LINES = 50_000


def landed(spark, d, files: int = 4) -> tuple[str, int]:
    """The page lines written out as landed files, about `files` of them or as many as the orders need; returns their folder and number.

    The orders are dealt out by key before their lines are built, so no line is shuffled. Files are compressed, and one is read as a whole.
    """
    folder, number = scratch_folder(spark), parts_for(load(spark, d, "orders").count(), FILE_LINES, files)
    lines = load(compiled(spark), d, "page_json", number).select("value")
    with shuffles_dropped(spark):
        lines.write.option("compression", "gzip").option("maxRecordsPerFile", 2 * FILE_LINES).text(folder)
    return folder, len(spark.read.text(folder).inputFiles())


_DATA = "(value->>'$.success') = 'true' AND json_array_length(value, '$.data') > 0"


@check(
    f"""SELECT value->>'$.entity' AS entity, CAST(value->>'$.page_no' AS BIGINT) AS page_no, value->>'$.additional_data.next_cursor' AS "cursor",
        item->>'$.title' AS title FROM (SELECT value, unnest(CAST(json_extract(value, '$.data[*]') AS JSON[])) AS item FROM page_json WHERE {_DATA}) p""",
    ("page_json",),
)
def read_pages(spark, d):
    records = pages.read_pages(spark, landed(spark, d, spark.sparkContext.defaultParallelism)[0])
    return records.select("entity", "page_no", "cursor", F.try_variant_get("record", "$.title", "string").alias("title"))


_HEADS = """SELECT value->>'$.entity' AS entity, value->>'$.run_id' AS run_id, CAST(value->>'$.page_no' AS BIGINT) AS page_no, (value->>'$.success') = 'true' AS ok,
        CAST(json_array_length(value, '$.data') AS BIGINT) AS size, value->>'$.cursor' AS cursor, CAST(value->>'$.additional_data.pagination.start' AS BIGINT) AS start,
        coalesce((value->>'$.additional_data.pagination.more_items_in_collection') = 'true', false) AS more,
        CAST(value->>'$.additional_data.pagination.next_start' AS BIGINT) AS next_start, value->>'$.additional_data.next_cursor' AS next_cursor
    FROM chain_json"""
_LINKED = """SELECT *, CASE WHEN ok THEN size ELSE 0 END AS items, CASE WHEN NOT ok THEN 'unsuccessful' WHEN size = 0 THEN 'no_data'
        WHEN (more AND next_start IS NOT NULL) OR next_cursor IS NOT NULL THEN CASE WHEN lead(page_no) OVER w > page_no + 1 OR lead(start) OVER w <> next_start OR lead(cursor) OVER w <> next_cursor THEN 'gap' END
        WHEN more THEN 'missing_next_start' ELSE 'complete' END AS reason FROM heads WINDOW w AS (PARTITION BY entity, run_id ORDER BY page_no)"""


@check(
    """SELECT entity, run_id, count(*) AS pages, CAST(sum(items) AS BIGINT) AS items, coalesce(min(page_no) FILTER (reason IS NOT NULL), max(page_no)) AS last_page,
        coalesce(arg_min(reason, page_no) FILTER (reason IS NOT NULL), 'missing_page') AS end_reason FROM linked GROUP BY entity, run_id""",
    ("chain_json",), heads=_HEADS, linked=_LINKED,
)
def page_chain_audit(spark, d):
    return pages.page_chain_audit(pages.parse_page_heads(load(spark, d, "chain_json")))


@check(f"SELECT id, update_time, status FROM deals WHERE update_time >= TIMESTAMP '{SINCE}'", ("deals",))
def incremental_scan(spark, d):
    return scan.incremental_scan(load(spark, d, "deals"), at(SINCE)).select("id", "update_time", "status")


@check(
    f"SELECT id, update_time FROM deals WHERE update_time >= TIMESTAMP '{SINCE}' ORDER BY update_time, id LIMIT 500", ("deals",), name="incremental_scan_limit",
)
def incremental_limit(spark, d):
    return scan.incremental_scan(load(spark, d, "deals"), at(SINCE), 500).select("id", "update_time")


@check("SELECT id, titulo, status, CAST(value AS DOUBLE) AS value FROM deals WHERE id = '42'", ("deals",))
def point_lookup(spark, d):
    return scan.point_lookup(load(spark, d, "deals"), 42).select("id", "titulo", "status", "value")


@check("SELECT id FROM deals", ("deals",))
def all_ids(spark, d):
    return scan.all_ids(load(spark, d, "deals"))


@check("SELECT count(*) AS records FROM deals", ("deals",))
def count_records(spark, d):
    return scan.count_records(load(spark, d, "deals"))


@check("SELECT stage_id AS id, stage_name AS name, normalized_name FROM stages", ("stages",))
def stages_listing(spark, d):
    return dimensions.stages_listing(load(spark, d, "stages"))


@check("SELECT id, titulo, status, CAST(value AS DOUBLE) AS value, update_time FROM deals", ("deals",))
def write_snapshot(spark, d):
    deals = load(spark, d, "deals").select("id", "titulo", "status", "value", "update_time")
    folder = scratch_folder(spark)
    tables.write_snapshot(deals, folder)
    return tables.read_table(spark, folder)


@check("SELECT experiment, seq, batch_size, loaded, duration_s FROM runs", ("runs",), name="export_run_metrics_csv")
def export_csv(spark, d):
    runs, folder = load(spark, d, "runs").select("experiment", "seq", "batch_size", "loaded", "duration_s"), scratch_folder(spark)
    export_run_metrics_csv(runs, folder)
    return spark.read.schema(runs.schema).option("header", True).csv(folder)


DIMS = ["users", "persons", "stages", "pipelines", "orgs"]
ENRICHED_SQL = """SELECT f.*, coalesce(c.user_name, 'Desconhecido') AS creator_user_name, coalesce(o.user_name, 'Desconhecido') AS owner_name,
    coalesce(s.normalized_name, 'Desconhecido') AS stage_name, coalesce(l.pipeline_name, 'Desconhecido') AS pipeline_name,
    coalesce(p.person_name, 'Desconhecido') AS person_name, coalesce(g.org_name, 'Desconhecido') AS org_name
    FROM {source} f LEFT JOIN users c ON f.creator_user_id = c.user_id LEFT JOIN users o ON f.owner_id = o.user_id
    LEFT JOIN stages s ON f.stage_id = s.stage_id LEFT JOIN pipelines l ON f.pipeline_id = l.pipeline_id
    LEFT JOIN persons p ON f.person_id = p.person_id LEFT JOIN orgs g ON f.org_id = g.org_id"""
NAMES = "creator_user_name, owner_name, stage_name, pipeline_name, person_name, org_name"


def dims(spark, d):
    return {n: load(spark, d, n) for n in DIMS}


@check(f"SELECT id, {NAMES} FROM enriched", ("deals", *DIMS), enriched=ENRICHED_SQL.format(source="deals"))
def enrich_deals(spark, d):
    return lookups.enrich_deals(load(spark, d, "deals"), **dims(spark, d)).select("id", *NAMES.split(", "))


@check(f"SELECT id, {NAMES} FROM enriched", ("deals", *DIMS), enriched=ENRICHED_SQL.format(source="deals"))
def enrich_deals_large_dims(spark, d):
    """The plan for dimensions beyond the broadcast limit."""
    large = {n: t.hint("merge") for n, t in dims(spark, d).items()}
    return lookups.enrich_deals(load(spark, d, "deals"), **large).select("id", *NAMES.split(", "))


_NEEDED = """SELECT DISTINCT dim, id FROM (SELECT 'users' AS dim, creator_user_id AS id FROM deals UNION ALL SELECT 'users', owner_id FROM deals
    UNION ALL SELECT 'persons', person_id FROM deals UNION ALL SELECT 'stages', stage_id FROM deals UNION ALL SELECT 'pipelines', pipeline_id FROM deals
    UNION ALL SELECT 'orgs', org_id FROM deals) n WHERE id IS NOT NULL"""


@check("SELECT dim, id FROM needed", ("deals",), needed=_NEEDED)
def needed_ids(spark, d):
    return lookups.needed_ids(load(spark, d, "deals"))


@check("SELECT person_id, person_name, org_id FROM persons WHERE person_id IN (SELECT id FROM needed WHERE dim = 'persons')", ("deals", "persons"), needed=_NEEDED)
def lookup_subset(spark, d):
    ids = lookups.needed_ids(load(spark, d, "deals")).filter("dim = 'persons'")
    return lookups.lookup_subset(load(spark, d, "persons"), "person_id", ids)


@check(
    """SELECT n.dim, count(*) AS needed, count(h.id) AS found, count(*) - count(h.id) AS missing FROM needed n LEFT JOIN (
        SELECT 'users' AS dim, user_id AS id FROM users UNION ALL SELECT 'persons', person_id FROM persons UNION ALL SELECT 'stages', stage_id FROM stages
        UNION ALL SELECT 'pipelines', pipeline_id FROM pipelines UNION ALL SELECT 'orgs', org_id FROM orgs) h ON n.dim = h.dim AND n.id = h.id GROUP BY n.dim""",
    ("deals", *DIMS), needed=_NEEDED,
)
def lookup_coverage(spark, d):
    keys = {"users": "user_id", "persons": "person_id", "stages": "stage_id", "pipelines": "pipeline_id", "orgs": "org_id"}
    return lookups.lookup_coverage(load(spark, d, "deals"), {n: (t, keys[n]) for n, t in dims(spark, d).items()})


TIES = ["line", "part", "supplier", "value"]
LATEST_SQL = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY update_time DESC NULLS LAST, line DESC, part DESC, supplier DESC, value DESC) AS rn
    FROM changes) c WHERE rn = 1"""


@check("SELECT id, titulo, CAST(value AS DOUBLE) AS value, update_time, part, supplier FROM latest", ("changes",), latest=LATEST_SQL)
def latest_per_id(spark, d):
    newest = merge.latest_per_id(load(spark, d, "changes"), seq=TIES)
    return newest.select("id", "titulo", "value", "update_time", "part", "supplier")


@check("SELECT id, part, supplier, line FROM changes WHERE id NOT IN (SELECT id FROM deals)", ("changes", "deals"))
def new_records(spark, d):
    return merge.new_records(load(spark, d, "changes"), load(spark, d, "deals")).select("id", "part", "supplier", "line")


_MERGED = "id titulo status currency value add_time update_time stage_id close_time".split()


def merged_sql() -> str:
    wins = "(s.id IS NOT NULL AND (t.id IS NULL OR t.update_time IS NULL OR s.update_time >= t.update_time))"
    columns = ["coalesce(t.id, s.id) AS id"]
    for c in "titulo status currency value update_time stage_id".split():
        new = f"CASE WHEN {wins} THEN s.{c} ELSE t.{c} END"
        columns.append(f"CAST({new} AS DOUBLE) AS value" if c == "value" else f"{new} AS {c}")
    columns += [f"CASE WHEN {wins} THEN coalesce(t.add_time, s.add_time) ELSE t.add_time END AS add_time", "t.close_time AS close_time"]
    return f"SELECT {', '.join(columns)} FROM deals t FULL OUTER JOIN latest s ON t.id = s.id"


def _merge(spark, d):
    target = load(spark, d, "deals").select(*_MERGED)
    source = merge.latest_per_id(load(spark, d, "changes"), seq=TIES).drop(*TIES[:3])
    return merge.merge_deals(target, source)


@check(merged_sql(), ("deals", "changes"), latest=LATEST_SQL)
def merge_deals(spark, d):
    return _merge(spark, d)


@check(merged_sql(), ("deals", "changes"), latest=LATEST_SQL)
def merge_deals_small_source(spark, d):
    """All changes, of each id the newest, as one stored batch that is merged into a stored table in 64 partitions."""
    folder = scratch_folder(spark)
    tables.write_snapshot(load(spark, d, "deals").select(*_MERGED), folder, parts=64)
    source = keep(merge.latest_per_id(load(spark, d, "changes"), seq=TIES).drop(*TIES[:3]))
    tables.apply_changes(source, folder, 1, merge.merge_deals)
    return tables.read_table(spark, folder)


@check(merged_sql(), ("deals", "changes"), latest=LATEST_SQL)
def stale_update_guard(spark, d):
    """Merging an older batch again changes nothing."""
    once = _merge(spark, d)
    source = merge.latest_per_id(load(spark, d, "changes"), seq=TIES).drop(*TIES[:3])
    stale = source.filter(F.col("update_time").isNotNull()).withColumn("update_time", F.col("update_time") - F.expr("INTERVAL '30' DAY"))
    return merge.merge_deals(once, stale.withColumn("titulo", F.lit("stale")))


_NAME_SQL = "CASE WHEN json_exists(record, '$.name') THEN record->>'$.name' ELSE 'Desconhecido' END"
_ACTIVE_SQL = "CASE WHEN json_exists(record, '$.active_flag') THEN (record->>'$.active_flag') = 'true' ELSE true END"
DIM_SQL = {
    "users": f"SELECT CAST(record->>'$.id' AS BIGINT) AS user_id, {_NAME_SQL} AS user_name, {_ACTIVE_SQL} AS is_active FROM user_json",
    "persons": f"SELECT CAST(record->>'$.id' AS BIGINT) AS person_id, {_NAME_SQL} AS person_name, CAST(coalesce(record->>'$.org_id.value', record->>'$.org_id') AS BIGINT) AS org_id FROM person_json",
    "stages": f"""SELECT stage_id, stage_name, CASE WHEN stage_name <> 'Desconhecido' THEN {slug_sql('stage_name')} END AS normalized_name, pipeline_id, order_nr, true AS is_active FROM (
        SELECT CAST(record->>'$.id' AS BIGINT) AS stage_id, regexp_replace(coalesce(record->>'$.name', 'Desconhecido'), '^moved_to_stage_', '') AS stage_name,
        CAST(record->>'$.pipeline_id' AS BIGINT) AS pipeline_id, CAST(record->>'$.order_nr' AS BIGINT) AS order_nr FROM stage_json) s""",
    "pipelines": f"SELECT CAST(record->>'$.id' AS BIGINT) AS pipeline_id, {_NAME_SQL} AS pipeline_name, {_ACTIVE_SQL} AS is_active FROM pipeline_json",
    "orgs": f"SELECT CAST(record->>'$.id' AS BIGINT) AS org_id, {_NAME_SQL} AS org_name FROM org_json",
}
RAW = {"users": "user_json", "persons": "person_json", "stages": "stage_json", "pipelines": "pipeline_json", "orgs": "org_json"}


def _register_dim(entity):
    mapper = getattr(dimensions, f"dim_{entity}")
    check(DIM_SQL[entity], (RAW[entity],), name=f"dim_{entity}")(lambda spark, d: mapper(load_records(spark, d, RAW[entity])))


for _entity in DIMS:
    _register_dim(_entity)


@check(
    f"""SELECT 'users' AS entity, CAST(record->>'$.id' AS BIGINT) AS id, {_NAME_SQL} AS name FROM user_json
        UNION ALL SELECT 'persons', CAST(record->>'$.id' AS BIGINT), trim(record->>'$.name') FROM person_json
        WHERE trim(record->>'$.name') <> '' AND CAST(record->>'$.id' AS BIGINT) <> 0""",
    ("user_json", "person_json"),
)
def id_name_map(spark, d):
    users = dimensions.id_name_map(load_records(spark, d, "user_json"), drop_empty=False)
    persons = dimensions.id_name_map(load_records(spark, d, "person_json"), drop_empty=True)
    return users.select(F.lit("users").alias("entity"), "*").unionByName(persons.select(F.lit("persons").alias("entity"), "*"))


NOW = "2024-05-01 12:00:00"
OLD_PERSONS_SQL = "SELECT c_custkey * 2 AS person_id, concat('old ', c_name) AS person_name, CAST(0 AS BIGINT) AS org_id, TIMESTAMP '2020-01-01 00:00:00' AS last_synced_at FROM customer"
UPSERTED_SQL = f"""SELECT *, TIMESTAMP '{NOW}' AS last_synced_at FROM fresh
    UNION ALL SELECT * FROM old WHERE person_id NOT IN (SELECT person_id FROM fresh)"""


def old_persons(spark, d):
    return load(spark, d, "customer").select(
        (F.col("c_custkey") * 2).alias("person_id"), F.concat(F.lit("old "), "c_name").alias("person_name"),
        F.lit(0).cast("bigint").alias("org_id"), at("2020-01-01 00:00:00").alias("last_synced_at"),
    )


@check(UPSERTED_SQL, ("person_json",), fresh=DIM_SQL["persons"], old=OLD_PERSONS_SQL)
def upsert_dim(spark, d):
    fresh = dimensions.dim_persons(load_records(spark, d, "person_json"))
    return dimensions.upsert_dim(old_persons(spark, d), fresh, "person_id", at(NOW))


_SIDES = dict(
    src="SELECT CAST(o_orderkey * 2 AS STRING) AS id FROM orders", tgt="SELECT CAST(l_orderkey AS STRING) AS id FROM lineitem",
)


@check(
    """SELECT (SELECT count(DISTINCT id) FROM src) AS source_ids, (SELECT count(DISTINCT id) FROM tgt) AS target_ids,
        (SELECT count(DISTINCT id) FROM src WHERE id NOT IN (SELECT id FROM tgt)) AS missing_ids,
        (SELECT count(DISTINCT id) FROM tgt WHERE id NOT IN (SELECT id FROM src)) AS extra_ids,
        (SELECT count(*) FROM src) = (SELECT count(*) FROM tgt) AS count_match""", **_SIDES,
)
def reconcile_ids(spark, d):
    source = load(spark, d, "orders").select((F.col("o_orderkey") * 2).alias("id"))
    return quality.reconcile_ids(source, load(spark, d, "lineitem").select(F.col("l_orderkey").alias("id")))


FIELDS = ["value", "currency", "status", "stage_id"]


def mismatch_sql() -> str:
    shown = {"value": "CAST({0}.value AS DECIMAL(18,2))", "stage_id": "{0}.stage_id"}
    one = lambda f, side: f"CAST({shown.get(f, '{0}.' + f).format(side)} AS VARCHAR)"
    parts = [
        f"SELECT s.id, '{f}' AS field, {one(f, 's')} AS source, {one(f, 't')} AS target FROM latest s JOIN deals t ON s.id = t.id WHERE s.{f} IS DISTINCT FROM t.{f}"
        for f in FIELDS
    ]
    parts.append("SELECT s.id, NULL, NULL, NULL FROM latest s WHERE s.id NOT IN (SELECT id FROM deals)")
    return " UNION ALL ".join(parts)


@check("SELECT * FROM mismatches", ("deals", "changes"), latest=LATEST_SQL, mismatches=mismatch_sql())
def field_mismatches(spark, d):
    source = merge.latest_per_id(load(spark, d, "changes"), seq=TIES)
    return quality.field_mismatches(source, load(spark, d, "deals"), FIELDS)


@check("SELECT * FROM mismatches", ("deals", "changes"), latest=LATEST_SQL, mismatches=mismatch_sql())
def field_mismatches_by_range(spark, d):
    source = merge.latest_per_id(load(spark, d, "changes"), seq=TIES)
    return quality.field_mismatches(source, load(spark, d, "deals"), FIELDS, ranges=quality.RANGES)


@check(
    """SELECT (SELECT count(*) FROM latest) AS source_ids, (SELECT count(*) FROM deals) AS target_ids,
        (SELECT count(*) FROM latest WHERE id NOT IN (SELECT id FROM deals)) AS missing_ids,
        (SELECT count(*) FROM deals WHERE id NOT IN (SELECT id FROM latest)) AS extra_ids,
        (SELECT count(*) FROM latest) = (SELECT count(*) FROM deals) AS count_match""", ("deals", "changes"), latest=LATEST_SQL,
)
def reconcile_unique_ids(spark, d):
    source = keep(merge.latest_per_id(load(spark, d, "changes"), seq=TIES).select("id"))
    return quality.reconcile_unique_ids(source, load(spark, d, "deals").select("id"))


_DATES = f"SELECT count(*) AS issues FROM deals WHERE add_time > TIMESTAMP '{TODAY}' OR update_time < add_time OR close_time < add_time"


@check("SELECT issues FROM dates", ("deals",), dates=_DATES)
def date_consistency(spark, d):
    return quality.date_consistency(load(spark, d, "deals"), at(TODAY))


@check(
    """SELECT missing + extra + fields + dates AS data_quality_issues, rows_match AS count_match, missing AS missing_ids_count, extra AS extra_ids_count,
        dates AS date_issues, sample AS detailed_issues_sample FROM (SELECT (SELECT count(*) FROM latest WHERE id NOT IN (SELECT id FROM deals)) AS missing,
        (SELECT count(*) FROM deals WHERE id NOT IN (SELECT id FROM latest)) AS extra, (SELECT count(field) FROM mismatches) AS fields, (SELECT issues FROM dates) AS dates,
        (SELECT count(*) FROM latest) = (SELECT count(*) FROM deals) AS rows_match,
        (SELECT string_agg(message, '; ' ORDER BY id, f) FROM (SELECT id, coalesce(field, '') AS f, CASE WHEN field IS NULL THEN 'Missing record ' || id
            ELSE 'Field mismatch ' || field || ': ' || coalesce(source, 'None') || ' vs ' || coalesce(target, 'None') END AS message FROM mismatches ORDER BY id, f LIMIT 5) m) AS sample) r""",
    ("deals", "changes"), latest=LATEST_SQL, mismatches=mismatch_sql(), dates=_DATES,
)
def data_quality_report(spark, d):
    source = merge.latest_per_id(load(spark, d, "changes"), seq=TIES)
    return quality.data_quality_report(source, load(spark, d, "deals"), at(TODAY), fields=FIELDS)


@check(
    "SELECT id, field, source, target FROM mismatches ORDER BY id, field NULLS FIRST LIMIT 5", ("deals", "changes"), latest=LATEST_SQL, mismatches=mismatch_sql(),
)
def failed_sample(spark, d):
    source = merge.latest_per_id(load(spark, d, "changes"), seq=TIES)
    return quality.failed_sample(quality.field_mismatches(source, load(spark, d, "deals"), FIELDS), order=["id", "field"])
