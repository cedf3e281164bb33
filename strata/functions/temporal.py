"""Dates: ISO parsing, partition date text, date windows (O4, O8g, O9)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._util import as_col

# ISO 8601 forms read as timestamps: a calendar date, optionally a 'T' or ' ' and a time
# of hours:minutes[:seconds[.fraction]], optionally an offset ('Z' was already rewritten).
_ISO_TEXT = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"(?:[T ][0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,6})?)?)?"
    r"(?:[+-][0-9]{2}:?[0-9]{2})?)?$"
)
_HAS_OFFSET = r"[+-][0-9]{2}:?[0-9]{2}$"


def _iso_text(c) -> Column:
    return F.replace(as_col(c).cast("string"), F.lit("Z"), F.lit("+00:00"))


def parse_iso(c) -> Column:
    """O8g: timestamp from ISO text ('Z', '+hh:mm' or no offset); null on failure.

    Text without an offset is read as UTC wall-clock time.
    """
    text = _iso_text(c)
    # the cast wants minutes, seconds and an offset with a colon; most values have them
    spelled_out = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        text, r"([+-][0-9]{2})([0-9]{2})$", "$1:$2"), r"^(.{10}[T ][0-9]{2})(?=[+-]|$)", "$1:00"), r"^(.{10}[T ][0-9]{2}:[0-9]{2})(?=[+-]|$)", "$1:00")
    plain = (F.length(text) == 10) | ((F.substring(text, 14, 1) == ":") & (F.substring(text, 17, 1) == ":") & (F.substring(text, -5, 1) != "+") & (F.substring(text, -5, 1) != "-"))
    return F.when(text.rlike(_ISO_TEXT), F.try_to_timestamp(F.when(plain, text).otherwise(spelled_out)))


def has_offset(c) -> Column:
    """True when ISO text carries a time-zone offset (a zone-aware value)."""
    text = _iso_text(c)
    return text.rlike(_ISO_TEXT) & text.rlike(_HAS_OFFSET)


def partition_date(c) -> Column:
    """Partition folder text, YYYY-MM-DD."""
    return F.date_format(as_col(c), "yyyy-MM-dd")


def as_timestamp(value) -> Column:
    """A literal batch time (strings, dates and datetimes accepted) as TIMESTAMP."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, dt.datetime):
        return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    if isinstance(value, dt.date):
        return F.lit(value.isoformat()).cast("timestamp")
    return F.lit(str(value)).cast("timestamp")


def as_date(value) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, (dt.date, dt.datetime)):
        return F.lit(value.strftime("%Y-%m-%d")).cast("date")
    return F.lit(str(value)).cast("date")


def within_last_days(c, now, days: int) -> Column:
    """O9 LAST_X_DAYS: value >= now - days."""
    return as_col(c) >= as_timestamp(now) - F.make_interval(days=F.lit(int(days)))


def on_day(c, day) -> Column:
    """O9 SPECIFIC_DATE: the whole UTC day, start and last microsecond included."""
    start = as_date(day).cast("timestamp")
    return (as_col(c) >= start) & (as_col(c) < start + F.expr("INTERVAL 1 DAY"))
