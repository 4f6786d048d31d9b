"""Endpoint labels of call-log URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ACTIONS, SUBRESOURCES

BASE_URL = r"^https?://[^/?]+(/api)?/v\d+(?=/|\?|$)"


def normalize_endpoint(url: Column, base_url: str = BASE_URL) -> Column:
    """Low-cardinality label of a URL: ids become `detail`, unknown tails are cut."""
    local = F.regexp_replace(url, base_url, "")
    parts = F.split(F.btrim(F.substring_index(local, "?", 1), F.lit("/")), "/")
    first, second, third, fourth = (F.get(parts, i) for i in range(4))
    number = r"^\d+$"
    resource = F.concat(F.lit("/"), first)
    detail = F.concat(resource, F.lit("/detail"))
    nested = (
        F.when(third.isin(SUBRESOURCES), F.concat(detail, F.lit("/"), third))
        .when(fourth.rlike(number), F.concat(detail, F.lit("/"), third, F.lit("/detail")))
        .otherwise(detail)
    )
    return (
        F.when(url.isNull(), None)
        .when(F.length(first) == 0, F.lit("/"))
        .when(second.rlike(number), nested)
        .when(second.isin(ACTIONS), F.concat(resource, F.lit("/"), second))
        .otherwise(resource)
    )
