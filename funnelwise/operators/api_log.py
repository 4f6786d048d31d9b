"""Cost, errors and limits from the API call log.

Call log: ts, job, url, method, status_code, outcome, duration_s, rate_remaining, rate_reset.
`outcome` is ok, timeout, connection_error or request_exception (any HTTP error included).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.endpoints import normalize_endpoint
from ..schema import API_SECONDS_EDGES, DAILY_TOKEN_BUDGET, DEFAULT_ENDPOINT_COST, ENDPOINT_COSTS
from .histograms import duration_histogram

OK = "ok"


def _labelled(calls: DataFrame) -> DataFrame:
    return calls if "endpoint" in calls.columns else calls.withColumn("endpoint", normalize_endpoint(F.col("url")))


def _succeeded() -> Column:
    return F.col("outcome") == OK


def endpoint_cost(calls: DataFrame, costs: dict[str, int] = ENDPOINT_COSTS, default: int = DEFAULT_ENDPOINT_COST) -> DataFrame:
    """Add `endpoint` and the token `cost`; a failed call costs nothing."""
    prices = F.create_map(*[F.lit(x) for pair in costs.items() for x in pair])
    price = F.coalesce(prices[F.col("endpoint")], F.lit(default)).cast("bigint")
    return _labelled(calls).withColumn("cost", F.when(_succeeded(), price).otherwise(F.lit(0).cast("bigint")))


def token_cost_by_endpoint(calls: DataFrame, costs: dict[str, int] = ENDPOINT_COSTS) -> DataFrame:
    """Token cost by job and endpoint, and with a NULL endpoint the total of each job."""
    job, endpoint = F.col("job"), F.col("endpoint")
    spent = endpoint_cost(calls, costs).groupingSets([(job, endpoint), (job,)], job, endpoint)
    return spent.agg(F.sum("cost").alias("cost")).select("job", "endpoint", "cost")


def token_budget(calls: DataFrame, costs: dict[str, int] = ENDPOINT_COSTS, budget: int = DAILY_TOKEN_BUDGET) -> DataFrame:
    """Tokens left per job, absolute and in percent."""
    used = endpoint_cost(calls, costs).groupBy("job").agg(F.sum("cost").alias("used"))
    left = F.lit(budget) - F.col("used")
    return used.select("job", "used", left.alias("remaining"), (left / budget * 100).alias("remaining_pct"))


def calls_by_endpoint(calls: DataFrame) -> DataFrame:
    """Answered calls by endpoint, method and status code."""
    answered = _labelled(calls.filter(F.col("status_code").isNotNull()))
    return answered.groupBy("endpoint", "method", "status_code").agg(F.count("*").alias("calls"))


def latency_by_endpoint(calls: DataFrame, edges: list[float] = API_SECONDS_EDGES) -> DataFrame:
    """Cumulative counts of answer times by endpoint, method and status code -> (endpoint, method, status_code, le, count)."""
    answered = _labelled(calls.filter(F.col("status_code").isNotNull()))
    return duration_histogram(answered, "duration_s", edges, ["endpoint", "method", "status_code"])


def errors_by_type(calls: DataFrame) -> DataFrame:
    """Failed calls by endpoint, error type and status ('N/A' without an answer)."""
    failed = _labelled(calls.filter(~_succeeded()))
    status = F.coalesce(F.col("status_code").cast("string"), F.lit("N/A"))
    return failed.groupBy("endpoint", F.col("outcome").alias("error_type"), status.alias("status")).agg(F.count("*").alias("errors"))


def retry_counts(calls: DataFrame) -> DataFrame:
    """Per endpoint: timeouts count as retries, other request failures as retry failures."""
    return _labelled(calls).groupBy("endpoint").agg(
        F.count_if(F.col("outcome") == "timeout").alias("retries"),
        F.count_if(F.col("outcome") == "request_exception").alias("retry_failures"),
    )


def rate_limit_status(calls: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Highest of the endpoints' latest quota and reset values, per `by` (overall if empty)."""
    by = by or []
    answered = _labelled(calls.filter(_succeeded()))
    latest = answered.groupBy(*dict.fromkeys([*by, "endpoint"])).agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col("ts"))).alias(c) for c in ("rate_remaining", "rate_reset")
    ])
    return latest.groupBy(*by).agg(F.max("rate_remaining").alias("remaining"), F.max("rate_reset").alias("reset_seconds"))


def cache_hit_ratio(events: DataFrame) -> DataFrame:
    """Lookup cache log (entity, hit) -> hits, misses and ratio per entity."""
    counts = events.groupBy("entity").agg(F.count_if(F.col("hit")).alias("hits"), F.count_if(~F.col("hit")).alias("misses"))
    return counts.withColumn("ratio", F.try_divide(F.col("hits"), F.col("hits") + F.col("misses")))
