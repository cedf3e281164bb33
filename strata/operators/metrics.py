"""Run metrics: per partition (O33) and the roll-up of a whole run.

All partitions are measured by one aggregation job; a wanted partition without data comes
from a left join of the wanted-partition frame (O4) and reports ``completed_no_data``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import registry as R
from strata.operators.silver import key_is_valid

PARTITION_COLUMNS = ("source", "city", "dt")


def partition_metrics(
    bronze: DataFrame,
    wanted: DataFrame | None = None,
    *,
    partition_cols=PARTITION_COLUMNS,
    keys=None,
    entity_keys=("neighbourhood", "city"),
    entity_clean=None,
    tiebreak=None,
    required=(),
) -> DataFrame:
    """Per partition, rows read, rows with a valid key, listings and entities loaded.

    ``rows_loaded`` counts distinct valid keys of the partition (rows left after the
    partition's dedup), ``neighbourhoods_loaded`` distinct non-null entity keys among them.
    A partition in which a kept row lacks a ``required`` column has status ``error`` and
    loads nothing.
    """
    partition_cols = list(partition_cols)
    keys = list(keys or R.key_columns(R.LISTINGS))
    ent = entity_clean or {}
    if tiebreak is None:
        tiebreak = [f.name for f in bronze.schema.fields if f.name not in (*partition_cols, *keys, R.RECENCY_COLUMN) and not isinstance(f.dataType, T.MapType)]
    # One pass: a row per (partition, key) with its row count and what its latest row holds
    # (largest struct: latest time, then the tie-break ascending), then a row per partition.
    entity = F.struct(*[ent.get(c, F.col(c)).alias("_e_" + c) for c in entity_keys])
    broken = F.lit(False)
    for c in required or ():
        if c in bronze.columns:
            broken = broken | F.col(c).isNull()
    wide = bronze.select(
        *partition_cols, key_is_valid(keys).alias("_ok"), F.struct(*keys).alias("_key"), entity.alias("_entity"), broken.alias("_broken"),
        # latest time first, then the tie-break ascending, nulls last
        F.struct(
            F.col(R.RECENCY_COLUMN).isNull().alias("n"), (-F.unix_micros(F.col(R.RECENCY_COLUMN).cast("timestamp"))).alias("t"),
            *[x for i, c in enumerate(tiebreak) for x in (F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}"))],
        ).alias("_order"),
    )
    per_key = wide.groupBy(*partition_cols, "_ok", "_key").agg(F.count(F.lit(1)).alias("_n"), F.min_by(F.struct("_entity", "_broken"), "_order").alias("_kept"))
    present = F.lit(True)
    for c in entity_keys:
        present = present & F.col(f"_kept._entity._e_{c}").isNotNull()
    stats = per_key.groupBy(*partition_cols).agg(
        F.sum("_n").alias("rows_read"),
        F.count_if("_ok").alias("rows_loaded"),
        F.count_distinct(F.when(F.col("_ok") & present, F.col("_kept._entity"))).alias("neighbourhoods_loaded"),
        F.sum(F.when(~F.col("_ok"), F.col("_n")).otherwise(0)).alias("dropped_invalid_key"),
        F.sum(F.when(F.col("_ok"), F.col("_n") - 1).otherwise(0)).alias("dropped_duplicate"),
        F.count_if(F.col("_ok") & F.col("_kept._broken")).alias("rows_broken"),
    )
    failed = F.col("rows_broken") > 0
    for c in ("rows_loaded", "neighbourhoods_loaded"):  # nothing of a failing partition loads
        stats = stats.withColumn(c, F.when(failed, F.lit(0)).otherwise(F.col(c)))
    outcome = F.when(failed, F.lit(R.STATUS_ERROR)).otherwise(F.lit(R.STATUS_SUCCESS))
    if wanted is None:
        return stats.withColumn("status", outcome).drop("rows_broken")
    joined = wanted.join(stats, partition_cols, "left")
    counts = ["rows_read", "rows_loaded", "neighbourhoods_loaded", "dropped_invalid_key", "dropped_duplicate"]
    return joined.select(
        *partition_cols,
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.when(F.col("rows_read").isNull(), F.lit(R.STATUS_NO_DATA)).otherwise(outcome).alias("status"),
    )


#: 2^12 registers: about 1.6 % standard error, exact for small sets, 2 kB a partition.
SKETCH_BITS = 12


def partition_states(bronze: DataFrame, *, partition_cols=PARTITION_COLUMNS, keys=None, entity_keys=("neighbourhood", "city"), entity_clean=None) -> DataFrame:
    """O33 as mergeable state: per partition the rows with and without a valid key, and
    sketches of its distinct listings and neighbourhoods.

    A run appends the states of its partitions to a small table; totals over any set of
    partitions and runs then come from :func:`merge_states`, without reading bronze again.
    One partial aggregation; a partition may hold any share of the rows.
    """
    keys = list(keys or R.key_columns(R.LISTINGS))
    ent = entity_clean or {}
    ok = key_is_valid(keys)
    hood = F.concat_ws("\x1f", *[ent.get(c, F.col(c)) for c in entity_keys])
    named = F.lit(True)
    for c in entity_keys:
        named = named & ent.get(c, F.col(c)).isNotNull()
    return bronze.groupBy(*partition_cols).agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~ok).alias("dropped_invalid_key"),
        F.hll_sketch_agg(F.when(ok, F.concat_ws("\x1f", *keys)), F.lit(SKETCH_BITS)).alias("listings"),
        F.hll_sketch_agg(F.when(ok & named, hood), F.lit(SKETCH_BITS)).alias("neighbourhoods"),
    )


def merge_states(states: DataFrame, by=()) -> DataFrame:
    """O32 over stored states: exact row counts and estimated distinct listings and neighbourhoods, by any columns."""
    merged = states.groupBy(*by).agg(
        F.count(F.lit(1)).alias("partitions"), *[F.sum(c).alias(c) for c in ("rows_read", "dropped_invalid_key")],
        *[F.hll_union_agg(c).alias(c) for c in ("listings", "neighbourhoods")],
    )
    return merged.withColumns({c: F.hll_sketch_estimate(c) for c in ("listings", "neighbourhoods")})


def rollup(metrics: DataFrame) -> DataFrame:
    """Totals, partitions by status and the overall status.

    ERROR if any partition errored, COMPLETED_NO_DATA if nothing was read, else SUCCESS.
    """
    agg = metrics.agg(
        F.coalesce(F.sum("rows_read"), F.lit(0)).cast("long").alias("total_read"),
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).cast("long").alias("total_loaded"),
        F.coalesce(F.sum("neighbourhoods_loaded"), F.lit(0)).cast("long").alias("total_neighbourhoods_loaded"),
        F.count_if(F.col("status") == R.STATUS_SUCCESS).alias("partitions_ok"),
        F.count_if(F.col("status") == R.STATUS_ERROR).alias("partitions_error"),
        F.count_if(F.col("status") == R.STATUS_NO_DATA).alias("partitions_no_data"),
    )
    return agg.select(
        F.when(F.col("partitions_error") > 0, F.lit(R.STATUS_ERROR))
        .when(F.col("total_read") == 0, F.lit(R.STATUS_NO_DATA))
        .otherwise(F.lit(R.STATUS_SUCCESS))
        .alias("status"),
        "*",
    )


def coverage(df: DataFrame, wanted: DataFrame, partition_cols) -> DataFrame:
    """O4 + O33: rows per wanted partition; a wanted partition without rows reports
    ``completed_no_data``. Counting is one partial aggregation; the wanted frame is
    parameter-sized (dates x values), so its join is a broadcast."""
    return coverage_of(df.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("record_count")), wanted, partition_cols)


def coverage_of(counts: DataFrame, wanted: DataFrame, partition_cols) -> DataFrame:
    """The same from counts that are stored already, such as a layer's manifest: no data is read."""
    partition_cols = list(partition_cols)
    counts = counts.select(*partition_cols, "record_count")
    joined = wanted.join(counts, partition_cols, "left")
    return joined.select(
        *wanted.columns,
        F.coalesce(F.col("record_count"), F.lit(0)).alias("record_count"),
        F.when(F.col("record_count").isNull(), F.lit(R.STATUS_NO_DATA)).otherwise(F.lit(R.STATUS_SUCCESS)).alias("status"),
    )
