"""Numeric validation and canonical number text (O8f, O14, O29, hash input)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._util import as_col
from strata.registry import Bounds


def in_bounds(c, bounds: Bounds) -> Column:
    """Lenient cast to double, null outside the interval.

    Text that is not a number becomes null (``try_cast``); with ``exclusive`` both given
    ends are strict.
    """
    text = as_col(c).cast("string")
    # the cast also reads the type suffixes of a number literal ("5d", "2f"); they are not numbers here
    x = F.when(~text.rlike(r"(?i)[0-9.][df]\s*$"), as_col(c).try_cast("double"))
    lo, hi, strict = bounds.low, bounds.high, bounds.exclusive
    cond = None
    if lo is not None:
        cond = (x > F.lit(float(lo))) if strict else (x >= F.lit(float(lo)))
    if hi is not None:
        upper = (x < F.lit(float(hi))) if strict else (x <= F.lit(float(hi)))
        cond = upper if cond is None else (cond & upper)
    if cond is None:
        return x
    return F.when(cond & ~F.isnan(x), x)


def to_int(c) -> Column:
    """Store a cleaned double in an INTEGER column: round half to even, null on overflow."""
    return F.bround(as_col(c).try_cast("double"), 0).try_cast("int")


def cents_to_amount(c) -> Column:
    """O8f: prices above 100 are in cents."""
    x = as_col(c)
    return F.when(x > 100, x / 100).otherwise(x)


def safe_ratio(num, den) -> Column:
    """Num / den, null when den is 0 or null (a bare /0 raises under ANSI)."""
    return F.try_divide(as_col(num), F.nullif(as_col(den), F.lit(0)))


def double_text(c) -> Column:
    """Shortest decimal text of a double, e.g. 1500.0 -> '1500.0', 0.0005 -> '0.0005'.

    Spark's own double-to-string switches to scientific notation at 1e7; going through a
    wide decimal gives plain digits. Trailing zeros are cut, keeping one after the point.
    Values too large for the decimal fall back to Spark's text.
    """
    x = as_col(c).cast("double")
    plain = x.try_cast("decimal(38,20)").cast("string")
    trimmed = F.regexp_replace(F.regexp_replace(plain, "0+$", ""), r"\.$", ".0")
    return F.when(x.isNull(), F.lit(None).cast("string")).when(
        plain.isNull(), x.cast("string")
    ).otherwise(trimmed)
