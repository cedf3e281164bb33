"""Rows of a key in time order, cut into chunks of time so that a hot key spreads over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_per_tie(df: DataFrame, keys, chunk: str, ts: str, tiebreak) -> DataFrame:
    """One row per (key, ts): the last by ``tiebreak``; uses the (key, chunk) partitioning
    (a row is kept when the next row in (ts, tiebreak) order has another ts)."""
    w = Window.partitionBy(*keys, chunk).orderBy(F.col(ts).asc(), *[F.col(c).asc() for c in tiebreak])
    nxt = F.lead(ts).over(w)
    return df.withColumn("_next_ts", nxt).where(F.col("_next_ts").isNull() | (F.col("_next_ts") != F.col(ts))).drop(
        "_next_ts"
    )
