"""Stage history and operational logs."""

from pyspark.sql import functions as F

from funnelwise.operators import api_log, catalogs, histograms, history, run_log, scoring
from funnelwise.schema import API_SECONDS_EDGES, BATCH_ROWS_EDGES, DB_SECONDS_EDGES, RUN_SECONDS_EDGES

from .cases_fields import CALLS
from .inputs import HISTORY, load
from .registry import check

ENTRIES = """SELECT deal_id, 'moved_to_stage_negociacao_' || new_value || '_' || new_value AS "column", TRY_CAST(time AS TIMESTAMP) AS ts FROM changelog
    WHERE field_key = 'stage_id' AND time <> 'bad' AND deal_id > 0 AND TRY_CAST(new_value AS BIGINT) BETWEEN 1 AND 24"""
FIRST_SQL = 'SELECT deal_id, "column", min(ts) AS ts FROM entries GROUP BY 1, 2'
WIDE_SQL = "SELECT deal_id, " + ", ".join(f"min(ts) FILTER (\"column\" = '{c}') AS {c}" for c in HISTORY) + " FROM entries GROUP BY deal_id"


def catalog(spark, d):
    return catalogs.stage_column_catalog(load(spark, d, "stage_meta"))


@check('SELECT deal_id, "column", ts FROM first_entries', ("changelog",), entries=ENTRIES, first_entries=FIRST_SQL)
def first_stage_entry(spark, d):
    return history.first_stage_entry(load(spark, d, "changelog"), catalog(spark, d))


@check("SELECT * FROM wide", ("changelog",), entries=ENTRIES, wide=WIDE_SQL)
def stage_history_wide(spark, d):
    stages = catalog(spark, d)
    return history.stage_history_wide(history.stage_entries(load(spark, d, "changelog"), stages), catalogs.history_columns(stages))


def filled_sql(table: str = "tracked") -> str:
    cells = ", ".join(f"coalesce(t.{c}, w.{c}) AS {c}" for c in HISTORY)
    return f"SELECT t.id, t.add_time, {cells} FROM {table} t LEFT JOIN wide w ON t.id = CAST(w.deal_id AS VARCHAR)"


@check("SELECT * FROM filled", ("tracked", "changelog"), entries=ENTRIES, wide=WIDE_SQL, filled=filled_sql())
def fill_stage_history(spark, d):
    wide = history.stage_history_wide(history.stage_entries(load(spark, d, "changelog"), catalog(spark, d)), HISTORY)
    return history.fill_stage_history(load(spark, d, "tracked"), wide)


ANY_NULL = "(" + " OR ".join(f"{c} IS NULL" for c in HISTORY) + ")"


@check(f"SELECT id FROM tracked WHERE {ANY_NULL} ORDER BY add_time ASC NULLS LAST, id LIMIT 200", ("tracked",))
def backfill_candidates(spark, d):
    return history.backfill_candidates(load(spark, d, "tracked"), HISTORY, 200)


@check(f"SELECT count(*) AS needing_backfill FROM tracked WHERE {ANY_NULL}", ("tracked",))
def backfill_count(spark, d):
    return history.backfill_count(load(spark, d, "tracked"), HISTORY)


@check(
    """SELECT run_id, CAST(sum(processed) AS BIGINT) AS processed, CASE WHEN max(initial) >= 0 THEN greatest(0, max(initial) - CAST(sum(processed) AS BIGINT)) END AS remaining,
        CAST(sum(api_errors) AS BIGINT) AS api_errors, CAST(sum(processing_errors) AS BIGINT) AS processing_errors,
        CASE WHEN bool_or(status NOT IN ('success', 'skipped')) THEN 'completed_with_errors' ELSE 'completed' END AS status FROM backfill_batches GROUP BY run_id""",
    ("backfill_batches",),
)
def backfill_progress(spark, d):
    return history.backfill_progress(load(spark, d, "backfill_batches"))


# --- API calls


@check(
    """SELECT job, endpoint, CAST(sum(cost) AS BIGINT) AS cost FROM costed GROUP BY job, endpoint
        UNION ALL SELECT job, NULL, CAST(sum(cost) AS BIGINT) FROM costed GROUP BY job""", ("api_calls",), **CALLS,
)
def token_cost_by_endpoint(spark, d):
    return api_log.token_cost_by_endpoint(load(spark, d, "api_calls"))


@check(
    """SELECT job, CAST(sum(cost) AS BIGINT) AS used, 1800000 - CAST(sum(cost) AS BIGINT) AS remaining,
        (1800000 - CAST(sum(cost) AS BIGINT)) / 1800000.0e0 * 100 AS remaining_pct FROM costed GROUP BY job""", ("api_calls",), **CALLS,
)
def token_budget(spark, d):
    return api_log.token_budget(load(spark, d, "api_calls"))


@check("SELECT endpoint, method, status_code, count(*) AS calls FROM labelled WHERE status_code IS NOT NULL GROUP BY 1, 2, 3", ("api_calls",), **CALLS)
def calls_by_endpoint(spark, d):
    return api_log.calls_by_endpoint(load(spark, d, "api_calls"))


@check(
    """SELECT endpoint, outcome AS error_type, coalesce(CAST(status_code AS VARCHAR), 'N/A') AS status, count(*) AS errors
        FROM labelled WHERE outcome <> 'ok' GROUP BY 1, 2, 3""", ("api_calls",), **CALLS,
)
def errors_by_type(spark, d):
    return api_log.errors_by_type(load(spark, d, "api_calls"))


@check(
    """SELECT endpoint, count(*) FILTER (outcome = 'timeout') AS retries, count(*) FILTER (outcome = 'request_exception') AS retry_failures
        FROM labelled GROUP BY endpoint""", ("api_calls",), **CALLS,
)
def retry_counts(spark, d):
    return api_log.retry_counts(load(spark, d, "api_calls"))


@check(
    """SELECT job, max(r) AS remaining, max(s) AS reset_seconds FROM (SELECT job, endpoint, arg_max(rate_remaining, ts) FILTER (rate_remaining IS NOT NULL) AS r,
        arg_max(rate_reset, ts) AS s FROM labelled WHERE outcome = 'ok' GROUP BY 1, 2) l GROUP BY job""", ("api_calls",), **CALLS,
)
def rate_limit_status(spark, d):
    return api_log.rate_limit_status(load(spark, d, "api_calls"), ["job"])


@check(
    "SELECT entity, count(*) FILTER (hit) AS hits, count(*) FILTER (NOT hit) AS misses, avg(hit::INT) AS ratio FROM cache_events GROUP BY entity", ("cache_events",),
)
def cache_hit_ratio(spark, d):
    return api_log.cache_hit_ratio(load(spark, d, "cache_events"))


# --- Distributions


def hist_sql(table: str, value: str, edges, by: str, where: str = "true") -> str:
    parts = [f"SELECT {by} AS series, CAST({e} AS DOUBLE) AS le, count(*) FILTER ({value} <= {e}) AS \"count\" FROM {table} WHERE {where} GROUP BY {by}" for e in edges]
    parts.append(f"SELECT {by}, CAST('inf' AS DOUBLE), count({value}) FROM {table} WHERE {where} GROUP BY {by}")
    return " UNION ALL ".join(parts)


_SERIES = [
    ("run", "runs", "duration_s", RUN_SECONDS_EDGES, "flow_type", "true"),
    ("db", "db_ops", "duration_s", DB_SECONDS_EDGES, "operation", "true"),
    ("batch", "batches", "loaded", BATCH_ROWS_EDGES, "flow_type", "true"),
    ("api", "api_calls", "duration_s", API_SECONDS_EDGES, "job", "outcome = 'ok'"),
]
_ALL_HISTS = " UNION ALL ".join(f"SELECT '{n}' AS metric, series, le, \"count\" FROM ({hist_sql(t, v, e, b, w)}) h" for n, t, v, e, b, w in _SERIES)


@check(
    "SELECT series.endpoint AS endpoint, series.method AS method, series.status_code AS status_code, le, \"count\" FROM hist", ("api_calls",), **CALLS,
    hist=hist_sql("labelled", "duration_s", API_SECONDS_EDGES, "{'endpoint': endpoint, 'method': method, 'status_code': status_code}", "status_code IS NOT NULL"),
)
def api_latency_by_endpoint(spark, d):
    return api_log.latency_by_endpoint(load(spark, d, "api_calls"))


def _hist(spark, d, name):
    _, table, value, edges, by, where = next(s for s in _SERIES if s[0] == name)
    rows = load(spark, d, table).filter(where).withColumn("series", F.col(by))
    return histograms.duration_histogram(rows, value, edges, ["series"])


@check(_ALL_HISTS, ("runs", "db_ops", "batches", "api_calls"))
def duration_histogram(spark, d):
    out = None
    for name, *_ in _SERIES:
        part = _hist(spark, d, name).select(F.lit(name).alias("metric"), "series", "le", "count")
        out = part if out is None else out.unionByName(part)
    return out


_QUANTILE_SQL = """SELECT series, q, CASE WHEN isinf(le) THEN below_le ELSE coalesce(below_le, 0) + (le - coalesce(below_le, 0)) *
    CASE WHEN "count" = coalesce(below, 0) THEN 0 ELSE (rank - coalesce(below, 0)) / ("count" - coalesce(below, 0)) END END AS value
    FROM (SELECT *, row_number() OVER (PARTITION BY series, q ORDER BY le) AS pick FROM (
        SELECT series, le, "count", q, lag(le) OVER (PARTITION BY series, q ORDER BY le) AS below_le, lag("count") OVER (PARTITION BY series, q ORDER BY le) AS below,
            q * max("count") OVER (PARTITION BY series, q) AS rank FROM hist, (SELECT CAST(0.5 AS DOUBLE) AS q UNION ALL SELECT 0.95) qs) a
        WHERE "count" >= rank) b WHERE pick = 1"""


def _quantiles(hist):
    return histograms.histogram_quantile(hist, 0.5, ["series"]).unionByName(histograms.histogram_quantile(hist, 0.95, ["series"]))


@check(_QUANTILE_SQL, ("db_ops",), hist=hist_sql("db_ops", "duration_s", DB_SECONDS_EDGES, "operation"))
def histogram_quantile(spark, d):
    return _quantiles(_hist(spark, d, "db"))


@check(
    _QUANTILE_SQL.replace("SELECT series, q,", "SELECT series AS bucket, q,", 1), ("api_calls",), name="histogram_quantile_over_time",
    hist=hist_sql("api_calls", "duration_s", API_SECONDS_EDGES, "date_trunc('hour', ts)", "outcome = 'ok'"),
)
def quantile_over_time(spark, d):
    calls = load(spark, d, "api_calls").filter("outcome = 'ok'").withColumn("series", F.window("ts", "1 hour")["start"])
    return _quantiles(histograms.duration_histogram(calls, "duration_s", API_SECONDS_EDGES, ["series"])).withColumnRenamed("series", "bucket")


_PLACES = """SELECT operation, q, min(v) FILTER (n = floor(place)) AS a, min(v) FILTER (n = ceil(place)) AS b, any_value(place - floor(place)) AS share FROM (
    SELECT *, q * (total - 1) AS place FROM (SELECT operation, duration_s AS v, row_number() OVER w - 1 AS n, count(*) OVER (PARTITION BY operation) AS total
        FROM odd_ops WHERE duration_s IS NOT NULL WINDOW w AS (PARTITION BY operation ORDER BY duration_s)) r, (SELECT unnest([0.0, 0.5, 0.95, 1.0])::DOUBLE AS q) qs) p GROUP BY operation, q"""


@check("SELECT operation, q, CASE WHEN a = b OR share = 0 THEN a ELSE a + (b - a) * share END AS value FROM places", ("odd_ops",), places=_PLACES)
def exact_quantiles(spark, d):
    return histograms.exact_quantiles(load(spark, d, "odd_ops"), "duration_s", [0.0, 0.5, 0.95, 1.0], ["operation"])


_STEPS = """SELECT series, ts, value, before_ts, CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END AS step
    FROM (SELECT *, lag(value) OVER w AS before, lag(ts) OVER w AS before_ts FROM odd_samples WINDOW w AS (PARTITION BY series ORDER BY ts, value)) a"""
_INCREASE = """SELECT series, bucket, sum(step) AS increase, sum(step) / 300 AS rate
    FROM (SELECT *, time_bucket(INTERVAL '5 minutes', ts) AS bucket FROM steps) s GROUP BY series, bucket"""


@check(_INCREASE, ("odd_samples",), steps=_STEPS)
def counter_increase(spark, d):
    return histograms.counter_increase(load(spark, d, "odd_samples"))


_RANGES = """SELECT series, start, count(*) - 1 AS gaps, date_diff('microsecond', start, min(ts)) / 1e6 AS head, date_diff('microsecond', max(ts), start + INTERVAL '15 minutes') / 1e6 AS tail,
        date_diff('microsecond', min(ts), max(ts)) / 1e6 AS between, arg_min(value, (ts, value)) AS value, sum(CASE WHEN before_ts >= start THEN step ELSE 0 END) AS growth
    FROM (SELECT *, unnest(generate_series(time_bucket(INTERVAL '5 minutes', ts) - INTERVAL '10 minutes', time_bucket(INTERVAL '5 minutes', ts), INTERVAL '5 minutes')) AS start FROM steps) s
    GROUP BY series, start HAVING max(ts) > min(ts)"""
_SLIDING = """SELECT series, start, start + INTERVAL '15 minutes' AS stop, growth * ((between + least(head2, CASE WHEN growth > 0 AND value >= 0 THEN between * (value / growth) END) + tail2) / between) AS increase
    FROM (SELECT *, CASE WHEN head >= between / gaps * 1.1e0 THEN between / gaps / 2 ELSE head END AS head2,
        CASE WHEN tail >= between / gaps * 1.1e0 THEN between / gaps / 2 ELSE tail END AS tail2 FROM ranges) r"""


@check("SELECT *, increase / 900 AS rate FROM sliding", ("odd_samples",), steps=_STEPS, ranges=_RANGES, sliding=_SLIDING)
def sliding_increase(spark, d):
    return histograms.sliding_increase(load(spark, d, "odd_samples"))


@check(
    """SELECT deal_id, stage, entered_at, next_stage, left_at, CAST(date_diff('second', entered_at, left_at) AS BIGINT) AS seconds FROM (
        SELECT *, lead(stage) OVER w AS next_stage, lead(entered_at) OVER w AS left_at FROM (SELECT DISTINCT deal_id, "column" AS stage, ts AS entered_at FROM entries) e
        WINDOW w AS (PARTITION BY deal_id ORDER BY entered_at, stage)) t""", ("changelog",), entries=ENTRIES,
)
def stage_transitions(spark, d):
    return history.stage_transitions(history.stage_entries(load(spark, d, "changelog"), catalog(spark, d)))


@check(
    """SELECT CASE WHEN count(*) FILTER (status = 'won') > 0 THEN date_trunc('second', max(update_time) + INTERVAL 1 SECOND) END AS watermark FROM deals""", ("deals",),
)
def run_watermark(spark, d):
    deals = load(spark, d, "deals")
    return run_log.run_watermark(deals, deals.filter("status = 'won'"))


@check(
    """SELECT f AS fetched, f - x AS validated, l AS loaded, x AS failed, 'success' AS status,
        'ETL completed. Fetched=' || f || ', Validated=' || (f - x) || ', Loaded=' || l || ', Failed=' || x || '.' AS message
        FROM (SELECT count(*) AS f, count(*) FILTER (status IS NULL) AS x, count(*) FILTER (status = 'won') AS l FROM deals) c""", ("deals",),
)
def run_summary(spark, d):
    deals = load(spark, d, "deals")
    return run_log.run_summary(deals, deals.filter("status IS NULL"), deals.filter("status = 'won'"))


@check(
    """SELECT f AS fetched, f - x AS validated, l AS loaded, greatest(x, f - l) AS failed, 'error' AS status, 'Critical ETL failure: disk full' AS message
        FROM (SELECT count(*) AS f, count(*) FILTER (status IS NULL) AS x, count(*) FILTER (status = 'won') AS l FROM deals) c""", ("deals",),
)
def run_summary_error(spark, d):
    """A run that broke off after loading a part."""
    deals = load(spark, d, "deals")
    return run_log.run_summary(deals, deals.filter("status IS NULL"), deals.filter("status = 'won'"), "disk full")


@check(
    """SELECT run_id, batch_id, original AS size, schema_failed, transform_failed, schema_failed + transform_failed AS failed,
        CASE WHEN original > 0 THEN (schema_failed + transform_failed) / original END AS error_rate, original = 0 AS is_empty FROM batches""", ("batches",),
)
def batch_quality(spark, d):
    return run_log.batch_quality(load(spark, d, "batches"))


@check(
    """SELECT flow_type, 'transform' AS stage, count(*) AS runs, sum(transform_s) AS total_s, avg(transform_s) AS mean_s FROM batches GROUP BY 1
        UNION ALL SELECT flow_type, 'load', count(*), sum(load_s), avg(load_s) FROM batches GROUP BY 1""", ("batches",),
)
def stage_times(spark, d):
    return run_log.stage_times(load(spark, d, "batches"))


@check(
    """SELECT operation, count(*) AS operations, sum(duration_s) AS total_s, max(active) AS max_active, max(idle) AS max_idle FROM db_ops GROUP BY operation""", ("db_ops",),
)
def db_op_stats(spark, d):
    return run_log.db_op_stats(load(spark, d, "db_ops"))


@check(
    """SELECT entity_type, count(*) AS runs, count(*) FILTER (status <> 'success') AS failures, CAST(sum(CASE WHEN status = 'success' THEN records ELSE 0 END) AS BIGINT) AS records
        FROM sync_runs GROUP BY entity_type""", ("sync_runs",),
)
def aux_sync_totals(spark, d):
    return run_log.aux_sync_totals(load(spark, d, "sync_runs"))


@check(
    """SELECT flow_type, count(*) AS runs, count(*) FILTER (status <> 'success') AS failures, max(end_ts) AS last_finish, max(end_ts) FILTER (status = 'success') AS last_success,
        arg_max(peak_memory_mb, (end_ts, seq)) AS last_peak_memory_mb FROM runs GROUP BY flow_type""", ("runs",),
)
def flow_run_health(spark, d):
    return run_log.flow_run_health(load(spark, d, "runs"))


@check(
    """SELECT seq, breaches FROM (SELECT seq, concat_ws(',', CASE WHEN duration_s >= 3600 THEN 'duration' END, CASE WHEN peak_memory_mb >= 4096 THEN 'memory' END,
        CASE WHEN fetched > 0 AND loaded = 0 THEN 'nothing_loaded' END) AS breaches FROM runs) b WHERE breaches <> ''""", ("runs",),
)
def sla_breaches(spark, d):
    return run_log.sla_breaches(load(spark, d, "runs")).select("seq", F.array_join("breaches", ",").alias("breaches"))


_BEST = """SELECT r.experiment, coalesce(b.batch_size, 1000) AS batch_size, b.score FROM (SELECT DISTINCT experiment FROM runs) r LEFT JOIN (
    SELECT experiment, batch_size, score, row_number() OVER (PARTITION BY experiment ORDER BY score DESC, seq) AS pick FROM scored) b ON r.experiment = b.experiment AND pick = 1"""
_BALANCED = """SELECT *, 0.4e0 * (1 - duration_s / max(duration_s) OVER e) + 0.4e0 * (1 - peak_memory_mb / max(peak_memory_mb) OVER e)
    + 0.2e0 * CASE WHEN max(data_quality_issues) OVER e > 0 THEN 1 - data_quality_issues / max(data_quality_issues) OVER e ELSE 1 END AS score
    FROM runs WHERE data_quality_issues <> -1 AND duration_s > 0 WINDOW e AS (PARTITION BY experiment)"""
_THROUGHPUT = """SELECT *, 0.7e0 * CASE WHEN max(loaded / duration_s) OVER e > 0 THEN loaded / duration_s / max(loaded / duration_s) OVER e ELSE 0 END
    + 0.3e0 * (1 - peak_memory_mb / max(peak_memory_mb) OVER e) AS score
    FROM runs WHERE status = 'success' AND data_quality_issues = 0 AND duration_s > 0 WINDOW e AS (PARTITION BY experiment)"""


@check(_BEST, ("runs",), scored=_BALANCED)
def score_runs_balanced(spark, d):
    return scoring.score_runs_balanced(load(spark, d, "runs"))


@check(_BEST, ("runs",), scored=_THROUGHPUT)
def score_runs_throughput(spark, d):
    return scoring.score_runs_throughput(load(spark, d, "runs"))


@check("SELECT batch_size, count(*) AS runs, avg((status = 'success')::INT) AS success_rate FROM runs GROUP BY batch_size", ("runs",))
def experiment_success_rate(spark, d):
    return scoring.experiment_success_rate(load(spark, d, "runs"))


@check(
    """SELECT seq, CAST(CASE WHEN peak_memory_mb > 2400 THEN greatest(100, floor(batch_size * 0.7e0)) WHEN n > 5 AND recent > 5000 THEN greatest(100, floor(batch_size * 0.7e0))
        WHEN n > 5 THEN least(2000, floor(batch_size * 1.2e0)) ELSE batch_size END AS INT) AS advice FROM (SELECT *, row_number() OVER (PARTITION BY flow_type ORDER BY start_ts, seq) AS n,
        avg(duration_s) OVER (PARTITION BY flow_type ORDER BY start_ts, seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS recent FROM odd_runs) r""", ("odd_runs",),
)
def batch_size_advice(spark, d):
    return run_log.batch_size_advice(load(spark, d, "odd_runs"), max_memory_mb=3000, duration_threshold=5000.0).select("seq", "advice")
