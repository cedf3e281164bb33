"""Column-expression building blocks (all JVM-side, no Python UDFs)."""

from strata.functions.hashing import business_key, row_hash, surrogate_key, value_text
from strata.functions.numeric import cents_to_amount, double_text, in_bounds, safe_ratio, to_int
from strata.functions.temporal import (
    as_date,
    as_timestamp,
    has_offset,
    on_day,
    parse_iso,
    partition_date,
    within_last_days,
)
from strata.functions.text import non_blank, parse_float, parse_int, strip, strip_lower, to_boolean

__all__ = [
    "as_date",
    "as_timestamp",
    "business_key",
    "cents_to_amount",
    "double_text",
    "has_offset",
    "in_bounds",
    "non_blank",
    "on_day",
    "parse_float",
    "parse_int",
    "parse_iso",
    "partition_date",
    "row_hash",
    "safe_ratio",
    "strip",
    "strip_lower",
    "surrogate_key",
    "to_boolean",
    "to_int",
    "value_text",
    "within_last_days",
]
