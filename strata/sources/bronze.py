"""Bronze layer: partitioned Parquet sink and scan, manifest, partition selector.

Layout: ``<root>/source=<s>/city=<c>/dt=<yyyy-mm-dd>/part-*.parquet`` and, beside it, the
manifest under ``<root>/_manifest/...`` (folders starting with ``_`` are skipped by the
Parquet scan, so the manifest never mixes with data).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import registry as R
from strata.functions import as_timestamp
from strata.sources import files

PARTITION_COLUMNS = ("source", "city", "dt")
MANIFEST_DIR = "_manifest"


def with_partition_columns(df: DataFrame, *, source, city=None, day) -> DataFrame:
    """Attach the partition values (source, city, dt); ``city`` defaults to the row's."""
    return df.withColumns(
        {
            "source": F.lit(source) if isinstance(source, str) else source,
            "city": F.col("city") if city is None else (F.lit(city) if isinstance(city, str) else city),
            "dt": F.lit(_day_text(day)) if not hasattr(day, "_jc") else day,
        }
    )


def _day_text(day) -> str:
    if isinstance(day, (dt.date, dt.datetime)):
        return day.strftime("%Y-%m-%d")
    return str(day)


def write_bronze(df: DataFrame, root: str, partition_cols=PARTITION_COLUMNS) -> None:
    """O2: write rows under their partition folders; a rerun replaces only the partitions
    it writes (dynamic overwrite), so reruns are idempotent and other days stay.

    Rows are rebalanced on the partition columns first: a small partition becomes one file,
    a large one is split over several tasks."""
    (
        df.hint("rebalance", *partition_cols).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(root)
    )


def bronze_schema(partition_cols=PARTITION_COLUMNS, data_schema: T.StructType = R.BRONZE_SCHEMA) -> T.StructType:
    """Read schema: data columns plus the partition columns as strings (the path value wins
    for ``city``, which is also a data column)."""
    fields = [f for f in data_schema.fields if f.name not in partition_cols]
    fields += [T.StructField(c, T.StringType(), True) for c in partition_cols]
    return T.StructType(fields)


def read_bronze(
    spark: SparkSession,
    root: str,
    *,
    source=None,
    cities=None,
    dates=None,
    schema: T.StructType | None = None,
    partition_cols=PARTITION_COLUMNS,
) -> DataFrame:
    """O1: scan only the wanted partitions; an empty frame when nothing is there.

    The predicates are on partition columns, so Catalyst prunes folders at planning time
    (``PartitionFilters`` in the plan); non-Parquet and ``_``-prefixed files are skipped.
    """
    schema = schema or bronze_schema(partition_cols)
    return read_partitioned(spark, root, schema, source=source, city=cities, dt=dates)


def read_partitioned(spark: SparkSession, root: str, schema: T.StructType, **wanted) -> DataFrame:
    """O1 for any partition layout: ``column=value`` or ``column=[values]`` predicates on
    partition columns (pruned at planning time). A root that does not exist is an empty
    frame; any other error is raised."""
    if not files.exists(spark, root):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(root)
    for col, value in wanted.items():
        if value is None:
            continue
        if isinstance(value, (list, tuple, set)):
            df = df.where(F.col(col).isin([_day_text(v) for v in value]))
        else:
            df = df.where(F.col(col) == F.lit(_day_text(value)))
    return df


def read_wanted(spark: SparkSession, root: str, wanted: DataFrame, schema: T.StructType, partition_cols=PARTITION_COLUMNS) -> DataFrame:
    """O1 + O4 with the wanted partitions as a frame (from a selector, a table, a query).

    The frame is a few thousand rows at most (dates times cities); broadcast to the join, it
    prunes the scan's folders while the query runs (``dynamicpruning``), so which partitions
    are read need not be known when the plan is made. A wanted partition counts once.
    """
    df = read_partitioned(spark, root, schema)
    # a side with a filter is what the planner prunes by
    keys = wanted.select(*partition_cols).where(F.col(partition_cols[-1]) > "").distinct()
    return df.join(F.broadcast(keys), list(partition_cols), "left_semi").select(*df.columns)


def read_manifest(spark: SparkSession, root: str, partition_cols=PARTITION_COLUMNS) -> DataFrame:
    """O3: the stored manifest of a layer, a row a partition (the partition values as text)."""
    fields = [T.StructField("record_count", T.LongType()), T.StructField("saved_at", T.TimestampType()), T.StructField("mode", T.StringType())]
    return read_partitioned_json(spark, f"{root.rstrip('/')}/{MANIFEST_DIR}", T.StructType(fields + [T.StructField(c, T.StringType()) for c in partition_cols]))


def read_partitioned_json(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(root) if files.exists(spark, root) else spark.createDataFrame([], schema)


def union_frames(frames) -> DataFrame:
    """Union of same-schema frames by column name; differing schemas are an error."""
    frames = list(frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=False), frames)


def manifest(
    df: DataFrame,
    *,
    mode: str,
    days: int,
    specific_date=None,
    max_pages: int,
    saved_at,
    partition_cols=PARTITION_COLUMNS,
) -> DataFrame:
    """O3: one manifest row per written partition (record count from one aggregation)."""
    counts = df.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("record_count"))
    return counts.select(
        *partition_cols,
        F.lit(mode).alias("mode"),
        F.lit(int(days)).alias("days"),
        (F.lit(_day_text(specific_date)).cast("date") if specific_date else F.lit(None).cast("date")).alias(
            "specific_date"
        ),
        F.lit(int(max_pages)).alias("max_pages"),
        F.col("record_count"),
        as_timestamp(saved_at).alias("saved_at"),
    )


def write_manifest(manifest_df: DataFrame, root: str, partition_cols=PARTITION_COLUMNS) -> None:
    """O3 sink: JSON documents under ``<root>/_manifest/<partition>/``."""
    (
        manifest_df.repartition(*partition_cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .json(f"{root.rstrip('/')}/{MANIFEST_DIR}")
    )


def wanted_dates(*, mode: str, days: int = 1, specific_date=None, today=None) -> list[str]:
    """The partition dates of a run, newest first (pure parameter arithmetic)."""
    if mode == R.MODE_SPECIFIC_DATE:
        if not specific_date:
            raise ValueError("specific_date is required when mode is SPECIFIC_DATE")
        return [_day_text(specific_date)]
    today = dt.datetime.now(dt.timezone.utc) if today is None else today
    base = today if isinstance(today, dt.date) else dt.date.fromisoformat(str(today)[:10])
    if isinstance(base, dt.datetime):
        base = base.date()
    return [(base - dt.timedelta(days=d)).isoformat() for d in range(int(days))]


def wanted_partitions(
    spark: SparkSession,
    *,
    source: str,
    cities=R.CITIES,
    mode: str = R.MODE_LAST_DAYS,
    days: int = 1,
    specific_date=None,
    today=None,
) -> DataFrame:
    """Wanted (source, city, dt) partitions as a frame of ``len(dates) * len(cities)``
    rows (a parameter-sized frame, safe to broadcast); ``rank`` keeps newest-first order."""
    dates = wanted_dates(mode=mode, days=days, specific_date=specific_date, today=today)
    frame = spark.range(len(dates)).select(
        F.col("id").alias("rank"),
        F.element_at(F.array(*[F.lit(d) for d in dates]), (F.col("id") + 1).cast("int")).alias("dt"),
        F.explode(F.array(*[F.lit(c) for c in cities])).alias("city"),
    )
    return frame.select(F.lit(source).alias("source"), "city", "dt", "rank")
