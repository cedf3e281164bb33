"""Change-detection hash and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions._util import as_col
from strata.functions.numeric import double_text

HASH_SEPARATOR = "|"
KEY_SEPARATOR = "~"


def value_text(c, dtype: T.DataType | None = None) -> Column:
    """Text of a value as it enters the hash: doubles in shortest plain form, booleans
    as true/false, integers and strings as they are."""
    col = as_col(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return double_text(col)
    return col.cast("string")


def row_hash(columns, df: DataFrame | None = None) -> Column:
    """md5 hex of the '|'-joined text of the columns, null read as ''.

    ``concat_ws`` alone would skip nulls (and so shift the fields), hence the coalesce.
    When ``df`` is given, each column's type picks its text form.
    """
    types = {f.name: f.dataType for f in df.schema.fields} if df is not None else {}
    parts = [F.coalesce(value_text(name, types.get(name)), F.lit("")) for name in columns]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *parts))


def business_key(*parts) -> Column:
    """A || '~' || b; null if any part is null (concat, not concat_ws)."""
    pieces = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(KEY_SEPARATOR))
        pieces.append(as_col(p).cast("string"))
    return F.concat(*pieces)


def surrogate_key(*parts) -> Column:
    """md5 of the business key; null if any part is null."""
    return F.md5(business_key(*parts))
