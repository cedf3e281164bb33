"""Gold layer: fact view over the SCD2 history and the insert-only dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import registry as R
from strata.functions import safe_ratio, surrogate_key

# Columns the history tracks: the silver listing columns without description and images.
HISTORY_COLUMNS = tuple(c for c in R.names(R.LISTINGS) if c not in ("description", "images"))

HOOD_SK = "neighbourhood_sk"
DIM_COLUMNS = (HOOD_SK, "neighbourhood", "city", "walk_score", "transit_score", "bike_score", "loaded_at")


def fact_view(history: DataFrame) -> DataFrame:
    """One row per listing version.

    ``city`` and ``neighbourhood`` are replaced by the dimension key, ``price_per_sqft``
    is rent over a non-zero size, ``is_current`` marks the open version.
    """
    cols = []
    for name in HISTORY_COLUMNS:
        if name == "city":
            continue
        if name == "neighbourhood":
            cols.append(surrogate_key("neighbourhood", "city").alias(HOOD_SK))
            continue
        cols.append(F.col(name))
        if name == "move_in_date":
            cols.append(safe_ratio("rent", "size_sqft").alias("price_per_sqft"))
    return history.select(
        F.col("scd_id"),
        *cols,
        F.col("valid_from"),
        F.col("valid_to"),
        F.col("valid_to").isNull().alias("is_current"),
        F.col("updated_at"),
    )


def dim_rows(neighbourhoods: DataFrame) -> DataFrame:
    """Dimension projection of the silver neighbourhoods (surrogate key first)."""
    extra = [c for c in neighbourhoods.columns if c not in DIM_COLUMNS]
    return neighbourhoods.select(
        surrogate_key("neighbourhood", "city").alias(HOOD_SK),
        *[c for c in DIM_COLUMNS[1:] if c in neighbourhoods.columns],
        *extra,
    )


def dim_new_rows(dim: DataFrame | None, neighbourhoods: DataFrame) -> DataFrame:
    """The dimension rows that :func:`dim_insert_only` appends."""
    rows = dim_rows(neighbourhoods).where(F.col(HOOD_SK).isNotNull())
    return rows if dim is None else rows.join(dim.select(HOOD_SK), HOOD_SK, "left_anti")


def dim_insert_only(dim: DataFrame | None, neighbourhoods: DataFrame) -> DataFrame:
    """Append neighbourhoods whose key is not in the dimension; stored rows never change.

    ``NOT IN`` semantics: a row whose key is null is never inserted (the stored key is
    never null, a data test checks it). The first run (``dim`` is None) loads all rows.
    Columns new in the source are appended (missing values null).
    """
    fresh = dim_new_rows(dim, neighbourhoods)
    return fresh if dim is None else dim.unionByName(fresh, allowMissingColumns=True)
