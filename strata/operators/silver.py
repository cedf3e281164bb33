"""Bronze -> silver cleaning.

Plan shape of :func:`transform_to_silver` on a partitioned bronze scan:

    scan (pruned columns, partition filters) -> Filter(keys) -> Project(cleaning, one node)
    -> [partial WindowGroupLimit] -> Exchange(hash listing key) -> WindowGroupLimit/Window
    -> Project(row hash, casts)

The dedup is a ``row_number() == 1`` filter, which Spark plans with a partial
``WindowGroupLimit`` *before* the shuffle: every map task keeps only its latest row per
key, so a key that holds a third of the input still sends one row per task.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import registry as R
from strata.functions import in_bounds, non_blank, row_hash, strip, strip_lower, to_boolean, to_int


class SilverFrames(NamedTuple):
    listings: DataFrame
    neighbourhoods: DataFrame


def fill_missing_columns(df: DataFrame, schema: T.StructType = R.BRONZE_SCHEMA) -> DataFrame:
    """Add every schema column the frame lacks as a typed null."""
    present = set(df.columns)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in present}
    return df.withColumns(missing) if missing else df


def key_is_valid(keys) -> Column:
    """O12 predicate: every key present and not blank after stripping."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & non_blank(F.col(k).cast("string"))
    return cond


def drop_invalid_keys(df: DataFrame, keys) -> DataFrame:
    """Drop rows with a null or blank key; the kept key is not stripped."""
    return df.where(key_is_valid(keys))


def cleaning_exprs(df: DataFrame, registry=R.LISTINGS, extra_bounds=(R.NEIGHBOURHOODS,)) -> dict:
    """O13-O16 for every registry column present in ``df``, as one column dict.

    The expressions are unresolved (by column name), so they are built once per set of
    present columns and reused: building ~50 nested expressions costs more driver time
    than analysing them.
    """
    return dict(_cleaning_exprs(frozenset(df.columns), tuple(registry), tuple(extra_bounds)))


@lru_cache(maxsize=64)
def _cleaning_exprs(present: frozenset, registry: tuple, extra_bounds: tuple) -> tuple:
    exprs: dict[str, Column] = {}
    for c in registry:
        if c.name not in present:
            continue
        if c.clean == R.CLEAN_STRIP:
            exprs[c.name] = strip(c.name)
        elif c.clean == R.CLEAN_LOWER:
            exprs[c.name] = strip_lower(c.name)
        elif c.clean == R.CLEAN_BOOL:
            exprs[c.name] = to_boolean(c.name)
    for name, bounds in R.bounded_columns(registry, *extra_bounds).items():
        exprs[name] = in_bounds(name, bounds)
    return tuple(exprs.items())


def clean(df: DataFrame, registry=R.LISTINGS, extra_bounds=(R.NEIGHBOURHOODS,)) -> DataFrame:
    """All cleaning in a single projection (Catalyst keeps it one Project node)."""
    exprs = cleaning_exprs(df, registry, extra_bounds)
    return df.withColumns(exprs) if exprs else df


def _orderable(df: DataFrame, exclude) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if f.name not in skip and not isinstance(f.dataType, T.MapType)
    ]


def keep_latest(
    df: DataFrame,
    keys,
    order_by=(R.RECENCY_COLUMN,),
    tiebreak=None,
) -> DataFrame:
    """One row per key, the latest by ``order_by`` (descending, nulls last).

    Ties are broken by ``tiebreak`` ascending (default: all remaining columns) so the
    result does not depend on partitioning.
    """
    keys = list(keys)
    if tiebreak is None:
        tiebreak = _orderable(df, [*keys, *order_by])
    ordering = [F.col(c).desc_nulls_last() for c in order_by]
    ordering += [F.col(c).asc_nulls_last() for c in tiebreak]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def extract_entities(
    df: DataFrame,
    columns,
    keys,
    order_by=(R.RECENCY_COLUMN,),
    tiebreak=("listing_id", "website"),
) -> DataFrame:
    """One row per entity key (null keys dropped, blank kept), from the latest row."""
    keys = list(keys)
    extra = [c for c in [*order_by, *tiebreak] if c in df.columns and c not in columns]
    base = df.select(*columns, *extra).dropna(subset=keys)
    ties = [c for c in tiebreak if c in base.columns]
    return keep_latest(base, keys, order_by=order_by, tiebreak=ties).select(*columns)


def cast_to(col: Column, current: T.DataType, target: T.DataType) -> Column:
    if current == target:
        return col
    if isinstance(target, T.IntegerType) and isinstance(current, (T.DoubleType, T.FloatType, T.DecimalType)):
        return to_int(col)
    if isinstance(target, (T.ArrayType, T.MapType, T.StructType)) or isinstance(current, T.NullType):
        return col.cast(target)
    return col.try_cast(target)


def select_registry(df: DataFrame, registry, *, managed: bool = False) -> DataFrame:
    """Exactly the registry's columns, in its order, cast to its types."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for c in registry:
        if c.merge == R.MERGE_MANAGED and not managed:
            continue
        if c.name in types:
            cols.append(cast_to(F.col(c.name), types[c.name], c.dtype).alias(c.name))
        else:
            cols.append(F.lit(None).cast(c.dtype).alias(c.name))
    return df.select(*cols)


def with_row_hash(df: DataFrame, registry=R.LISTINGS) -> DataFrame:
    """Add ``row_hash`` over the registry's hashed columns, in registry order."""
    return df.withColumn(R.HASH_COLUMN, row_hash(R.hashed_columns(registry), df))


def latest_rows(bronze: DataFrame, *, tiebreak=None) -> DataFrame:
    """O11 -> O12 -> O20 -> O17: one cleaned row per listing key.

    The dedup reads only the raw key and scraped_at, which cleaning leaves alone, so it
    runs first: cleaning then happens after the shuffle, spread over its partitions and
    only on the surviving rows.
    """
    keys = R.key_columns(R.LISTINGS)
    df = fill_missing_columns(bronze)
    df = drop_invalid_keys(df, keys)
    return clean(keep_latest(df, keys, tiebreak=tiebreak))


def frames_from_latest(latest: DataFrame) -> SilverFrames:
    """{O21, O19 -> O18}: both silver frames from the deduplicated, cleaned rows."""
    hood_cols = R.names(R.NEIGHBOURHOODS)
    hoods = extract_entities(latest, hood_cols, R.key_columns(R.NEIGHBOURHOODS))
    hoods = select_registry(hoods, R.NEIGHBOURHOODS)
    listings = select_registry(with_row_hash(latest), R.LISTINGS)
    return SilverFrames(listings, hoods)


def transform_to_silver(bronze: DataFrame, *, tiebreak=None) -> SilverFrames:
    """O11 -> O12 -> O20 -> O17 -> {O21, O19 -> O18}: bronze rows to the two silver frames."""
    return frames_from_latest(latest_rows(bronze, tiebreak=tiebreak))
