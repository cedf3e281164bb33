"""Keyed merges of a batch into a stored table.

Both sides are unique by key (the stored table by its primary key, the batch by O20), so a
join on the key can never be skewed: every key meets at most one row from each side. One
full outer join reads each side once. A stored table that is bucketed by its key
(``sources/tables.py``) is joined where its buckets lie: only the batch is exchanged, however
large the table is.

With ``mark`` each result row carries ``__changed``: true if the merge inserted it or took its
values from the batch. Tables keep the mark as their change feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import registry as R
from strata.functions import as_timestamp

_S, _I = "s__", "i__"
CHANGED = "__changed"


def _prefixed(df: DataFrame, prefix: str, marker: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns], F.lit(True).alias(marker))


def _join(stored: DataFrame, batch: DataFrame, keys) -> DataFrame:
    s = _prefixed(stored, _S, "_s")
    i = _prefixed(batch, _I, "_i")
    cond = None
    for k in keys:
        eq = F.col(_S + k) == F.col(_I + k)
        cond = eq if cond is None else (cond & eq)
    return s.join(i, cond, "full_outer")


def _present(marker: str) -> Column:
    return F.coalesce(F.col(marker), F.lit(False))


def _guarded_select(registry, keys, batch_ts, hash_col, recency_col, mark) -> list[Column]:
    s_in, i_in = _present("_s"), _present("_i")
    accept = i_in & (~s_in | (F.col(_I + recency_col) >= F.col(_S + recency_col)))
    changed = F.coalesce(F.col(_I + hash_col) != F.col(_S + hash_col), F.lit(False))
    insert = i_in & ~s_in
    out = []
    for c in registry:
        n = c.name
        if c.merge == R.MERGE_KEY:
            v = F.coalesce(F.col(_S + n), F.col(_I + n))
        elif c.merge == R.MERGE_ALWAYS:
            v = F.when(accept, F.col(_I + n)).otherwise(F.col(_S + n))
        elif c.merge == R.MERGE_MANAGED:
            v = F.when(insert | (accept & changed), as_timestamp(batch_ts)).otherwise(F.col(_S + n))
        else:
            v = F.when(insert | (accept & changed), F.col(_I + n)).otherwise(F.col(_S + n))
        out.append(v.cast(c.dtype).alias(n))
    return [*out, *([(insert | (accept & changed)).alias(CHANGED)] if mark else [])]


def upsert_hash_guarded(
    stored: DataFrame,
    batch: DataFrame,
    registry=R.LISTINGS,
    *,
    batch_ts=None,
    hash_col: str = R.HASH_COLUMN,
    recency_col: str = R.RECENCY_COLUMN,
    mark: bool = False,
) -> DataFrame:
    """Hash-aware guarded upsert; returns the new state of the stored table.

    * key only in the batch -> inserted;
    * key only stored -> kept;
    * batch row older than the stored row -> stored row kept whole;
    * equal or newer, same hash -> stored row, with the batch's always-update columns
      (``row_hash``, ``scraped_at``);
    * equal or newer, different hash -> the batch row, nulls included.
    """
    keys = R.key_columns(registry)
    cols = R.names(registry, managed=True)
    stored = stored.select(*[c for c in cols if c in stored.columns])
    batch = batch.select(*[c for c in cols if c in batch.columns])
    return _join(stored, batch, keys).select(*_guarded_select(registry, keys, batch_ts, hash_col, recency_col, mark))


def guarded_effect(
    stored: DataFrame, batch: DataFrame, registry=R.LISTINGS, *, hash_col: str = R.HASH_COLUMN, recency_col: str = R.RECENCY_COLUMN,
) -> DataFrame:
    """The batch rows by which :func:`upsert_hash_guarded` changes anything: rows of new keys, and
    rows that are not older than the stored one and differ from it in the hash or an
    always-update column. Reads the keys, the hash and those columns of the stored side only."""
    keys = R.key_columns(registry)
    told = list(dict.fromkeys([hash_col, recency_col, *[c.name for c in registry if c.merge == R.MERGE_ALWAYS]]))
    old = stored.select(*[F.col(c).alias(_S + c) for c in [*keys, *told]], F.lit(True).alias("_s"))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(_S + k))
    differs = F.lit(False)
    for c in told:
        differs = differs | ~F.col(c).eqNullSafe(F.col(_S + c))
    accept = F.coalesce(F.col(recency_col) >= F.col(_S + recency_col), F.lit(False))
    return batch.join(old, same, "left").where(~_present("_s") | (accept & differs)).select(*batch.columns)


def replace_by_key(stored: DataFrame, rows: DataFrame, keys) -> DataFrame:
    """``stored`` with the rows of the same key replaced by ``rows`` (same columns), and rows of new keys added."""
    given = _present("_i")
    out = [F.when(given, F.col(_I + c)).otherwise(F.col(_S + c)).alias(c) for c in stored.columns]
    return _join(stored, rows, list(keys)).select(*out)


def upsert_overwrite(stored: DataFrame, batch: DataFrame, registry=R.NEIGHBOURHOODS, *, batch_ts, mark: bool = False) -> DataFrame:
    """The batch wins for every key it holds (nulls included), managed columns get the
    batch time; stored keys absent from the batch are unchanged."""
    keys = R.key_columns(registry)
    cols = R.names(registry, managed=True)
    stored = stored.select(*[c for c in cols if c in stored.columns])
    batch = batch.select(*[c for c in R.names(registry) if c in batch.columns])
    given = _present("_i")
    out = []
    for c in registry:
        new = as_timestamp(batch_ts) if c.merge == R.MERGE_MANAGED else F.col(_I + c.name)
        out.append(F.when(given, new).otherwise(F.col(_S + c.name)).cast(c.dtype).alias(c.name))
    return _join(stored, batch, keys).select(*out, *([given.alias(CHANGED)] if mark else []))
