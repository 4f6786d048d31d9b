"""Column functions."""

from .endpoints import normalize_endpoint
from .records import unwrap_id
from .text import normalize_name
from .values import (
    canonical_nulls,
    cast_on_load,
    default_fill,
    recode_status,
    safe_date,
    safe_numeric,
    safe_timestamp,
)

__all__ = [
    "canonical_nulls", "cast_on_load", "default_fill", "normalize_endpoint", "normalize_name",
    "recode_status", "safe_date", "safe_numeric", "safe_timestamp", "unwrap_id",
]
