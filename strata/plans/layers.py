"""The three layer runs as plain functions composing the operators.

* :func:`scrape_to_bronze`: pages -> records -> date filter -> partitioned bronze + manifest.
* :func:`bronze_to_silver`: wanted partitions -> pruned scan -> silver frames -> guarded
  merges into versioned tables, with per-partition metrics and the run roll-up.
* :func:`silver_to_gold`: SCD2 snapshot of silver listings, insert-only dimension, fact
  view, and the gold data tests as a gate.

All partitions of a run are one Spark job per sink; a partition that breaks a constraint is
set apart by its metrics. Each merge batch is stored once, so the merge, the gate and the
row count read it instead of recomputing the cleaning and dedup.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import registry as R
from strata.functions import as_timestamp
from strata.operators import checks, gold, merge, metrics, scd2, silver
from strata.session import materialize
from strata.sources import bronze, pages
from strata.sources.tables import Sources, VersionedTable, WriteConflict


@dataclass
class ScrapeResult:
    status: str
    total_listings: int
    failed_listings: int
    manifest: DataFrame | None
    filtered_listings: int = 0


def scrape_to_bronze(
    spark: SparkSession,
    search_pages: DataFrame,
    detail_pages: DataFrame,
    *,
    root: str,
    source: str,
    mode: str = R.MODE_LAST_DAYS,
    days: int = 7,
    specific_date=None,
    max_pages: int = 10,
    now,
) -> ScrapeResult:
    """Extract listings from fetched pages and write them to ``source/city/dt=<run date>``.

    ``filtered_listings`` counts parsed listings outside the wanted dates. ``max_pages`` is
    recorded in the manifest; how many pages were fetched is the fetcher's decision."""
    if mode == R.MODE_SPECIFIC_DATE and not specific_date:
        return ScrapeResult(R.STATUS_ERROR, 0, 0, None)
    found = pages.scrape(search_pages, detail_pages, website=source, scraped_at=now, now=now)
    failed = int(found.summary.agg(F.coalesce(F.sum("failed"), F.lit(0)).alias("f")).first()["f"])
    listings = pages.filter_published(found.listings, mode=mode, now=now, days=days, specific_date=specific_date)
    total = listings.count()
    filtered = found.listings.count() - total
    if total == 0:
        return ScrapeResult(R.STATUS_NO_DATA, 0, failed, None, filtered)
    run_day = str(now)[:10]
    rows = bronze.with_partition_columns(listings, source=source, day=run_day)
    bronze.write_bronze(rows, root)
    man = bronze.manifest(rows, mode=mode, days=days, specific_date=specific_date, max_pages=max_pages, saved_at=now)
    bronze.write_manifest(man, root)
    return ScrapeResult(R.STATUS_SUCCESS, total, failed, man, filtered)


@dataclass
class SilverResult:
    metrics: DataFrame | None
    rollup: DataFrame | None
    rows_loaded: int
    neighbourhoods_loaded: int
    status: str = R.STATUS_SUCCESS
    message: str | None = None


def bronze_to_silver(
    spark: SparkSession,
    *,
    bronze_root: str,
    listings: VersionedTable,
    neighbourhoods: VersionedTable,
    source: str,
    cities=R.CITIES,
    mode: str = R.MODE_LAST_DAYS,
    days: int = 1,
    specific_date=None,
    today=None,
    batch_ts,
    schema: T.StructType | None = None,
    tiebreak=None,
    auto_create: bool = True,
    all_partitions: bool = False,
) -> SilverResult:
    """Read the wanted bronze partitions (or all with ``all_partitions``), clean them and
    merge them into the silver tables. Latest ``scraped_at`` wins for both tables.

    A partition whose kept rows break a NOT NULL constraint is reported as ``error`` and
    left out; the others load. A specific-date run without a date returns an error result.
    """
    from strata.functions import strip, strip_lower

    if all_partitions:
        raw = bronze.read_bronze(spark, bronze_root, schema=schema)
        wanted = None
    else:
        if mode == R.MODE_SPECIFIC_DATE and not specific_date:
            return SilverResult(None, None, 0, 0, R.STATUS_ERROR, "specific_date is required when mode is SPECIFIC_DATE")
        dates = bronze.wanted_dates(mode=mode, days=days, specific_date=specific_date, today=today)
        wanted = bronze.wanted_partitions(
            spark, source=source, cities=cities, mode=mode, days=days, specific_date=specific_date, today=dates[0]
        )
        raw = bronze.read_wanted(spark, bronze_root, wanted, schema or bronze.bronze_schema())
    required = [c.name for c in R.LISTINGS if not c.nullable and c.name in R.BRONZE_COLUMNS]
    part_metrics = materialize(metrics.partition_metrics(
        raw, wanted,
        entity_clean={"neighbourhood": strip("neighbourhood"), "city": strip_lower("city")},
        tiebreak=tiebreak, required=required,
    ), "partition-metrics")
    part = list(metrics.PARTITION_COLUMNS)
    bad = part_metrics.where(F.col("status") == R.STATUS_ERROR).select(*part)
    if bad.limit(1).count():  # a row per failing partition
        raw = raw.join(F.broadcast(bad), part, "left_anti")
    # the deduplicated, cleaned rows are stored once; both silver frames derive from them
    frames = silver.frames_from_latest(materialize(silver.latest_rows(raw, tiebreak=tiebreak), "silver-batch"))
    # stored once: the merge, the gate and the row count all read it
    batch = materialize(frames.listings, "listings-batch")
    hoods = materialize(frames.neighbourhoods, "neighbourhoods-batch")
    for table in (listings, neighbourhoods):
        table.create() if auto_create else table.verify()
    n_listings = listings.merge(batch, lambda old, new: merge.upsert_hash_guarded(old, new, batch_ts=batch_ts, mark=True), effect=merge.guarded_effect)
    n_hoods = neighbourhoods.merge(
        hoods, lambda old, new: merge.upsert_overwrite(old, new, batch_ts=batch_ts, mark=True),
        gate_rows=hoods.withColumn("loaded_at", F.lit(batch_ts).cast("timestamp")),
    )
    rollup = metrics.rollup(part_metrics)
    return SilverResult(part_metrics, rollup, n_listings, n_hoods, rollup.first()["status"])


HISTORY_REGISTRY = tuple(
    [R.ColumnSpec(c.name, c.dtype, True) for c in R.LISTINGS if c.name in gold.HISTORY_COLUMNS]
    + [
        R.ColumnSpec("scd_id", R.STRING, False, key=True, merge=R.MERGE_KEY),
        R.ColumnSpec("updated_at", R.TIMESTAMP),
        R.ColumnSpec("valid_from", R.TIMESTAMP, False),
        R.ColumnSpec("valid_to", R.TIMESTAMP),
    ]
)

DIM_REGISTRY = (
    R.ColumnSpec("neighbourhood_sk", R.STRING, False, key=True, merge=R.MERGE_KEY),
    R.ColumnSpec("neighbourhood", R.STRING, False),
    R.ColumnSpec("city", R.STRING, False),
    R.ColumnSpec("walk_score", R.DOUBLE),
    R.ColumnSpec("transit_score", R.DOUBLE),
    R.ColumnSpec("bike_score", R.DOUBLE),
    R.ColumnSpec("loaded_at", R.TIMESTAMP, False),
)


class History:
    """SCD2 history in one table: current versions in hash buckets of the business key, and
    folders of closed versions.

    A run hands over the versions that it closed and opened, nothing else. Only the buckets
    in which a version opened or closed are written, and one folder with the versions it
    closed; both become visible in the same commit. A run that fails before it leaves
    nothing behind that a reader or a retry would see.
    """

    def __init__(self, spark: SparkSession, root: str, name: str = "listing_history"):
        self.spark = spark
        self.keys = tuple(R.key_columns(R.LISTINGS))
        self.current = VersionedTable(spark, root, HISTORY_REGISTRY, name, bucket_by=self.keys)

    def exists(self) -> bool:
        return self.current.exists()

    def read(self) -> DataFrame:
        return self.current.read_closed().unionByName(self.current.read())

    def stage(self, versions: DataFrame) -> DataFrame:
        """Store the versions that a run closed and opened outside the table."""
        return materialize(versions, "history-run")

    def candidate(self, staged: DataFrame | None, since=None) -> DataFrame:
        """The whole history as it will be once ``staged`` is published; with ``since``, of what is
        stored only the versions that begin no earlier (others cannot meet the new ones)."""
        if staged is None:
            return self.read().where(F.lit(since is None))
        stored = self.read()
        if since is not None:
            stored = stored.where(F.col("valid_from") >= as_timestamp(since))
        closed = staged.where(F.col("valid_to").isNotNull()).select("scd_id")
        return stored.join(closed, "scd_id", "left_anti").unionByName(staged.select(stored.columns))

    def publish(self, staged: DataFrame | None, stream: tuple[str, int] | None = None) -> None:
        touched = self.current.touched(staged) if staged is not None else []
        if not touched:
            if stream and self.current.progress(stream[0]) != stream[1]:
                self.current.replace(None, [], stream=stream)  # one line, no data
            return
        closed, folders = staged.where(F.col("valid_to").isNotNull()), []
        if closed.limit(1).count():
            folders = [f"{self.current.root}/data/{uuid.uuid4().hex}"]
            closed.select(self.current.schema().names).write.parquet(folders[0])
        opened = staged.where(F.col("valid_to").isNull())
        stored = self.current.read(touched)
        held = any(b in self.current.data_folders() for b in touched)
        now = merge.replace_by_key(stored, opened.select(stored.columns), self.keys) if held else opened
        self.current.replace(now, touched if self.exists() else None, closed=folders, stream=stream, laid=held)

    def apply(self, versions: DataFrame) -> None:
        self.publish(self.stage(versions))


@dataclass
class GoldResult:
    fact: DataFrame
    dim: DataFrame
    tests: DataFrame


SILVER_LISTINGS, SILVER_HOODS = ("silver", "rental_listings"), ("silver", "neighbourhoods")


def silver_to_gold(
    spark: SparkSession,
    *,
    listings: VersionedTable | None = None,
    neighbourhoods: VersionedTable | None = None,
    sources: Sources | None = None,
    history: History,
    dimension: VersionedTable,
    batch_ts,
    since=None,
    run_tests: bool = True,
    full_tests: bool = False,
    attempts: int = 3,
) -> GoldResult:
    """Snapshot silver listings into the history (O24), grow the dimension (O26), expose
    the fact view (O29) and gate on the gold data tests (O28).

    Inputs are the named sources (O7) ``silver.rental_listings`` and
    ``silver.neighbourhoods``. Of a stored source only what changed since the version that
    gold holds is read; a run without changes stores nothing. The tests run on what the run
    adds, against the stored keys it could meet (``full_tests``: on the whole candidate
    tables); only a candidate that passes is published, the dimension first (the facts
    refer to it). If another writer publishes meanwhile the run starts again from what is
    there then: neither step adds anything twice.
    """
    sources = sources or Sources({SILVER_LISTINGS: listings, SILVER_HOODS: neighbourhoods})
    for attempt in range(attempts):
        try:
            return _gold_run(sources, history, dimension, batch_ts, since, run_tests, full_tests)
        except WriteConflict:
            if attempt == attempts - 1:
                raise
            history.current.refresh()
            dimension.refresh()


def _gold_run(sources: Sources, history: History, dimension: VersionedTable, batch_ts, since, run_tests: bool, full_tests: bool) -> GoldResult:
    seen_listings, seen_hoods = ".".join(SILVER_LISTINGS), ".".join(SILVER_HOODS)
    changed, version = sources.changes_since(*SILVER_LISTINGS, history.current.progress(seen_listings))
    staged = None
    if changed is not None:
        current = None
        if history.exists():
            current = history.current.read(history.current.touched(changed))
        staged = history.stage(scd2.scd2_snapshot(
            current, changed, key_cols=history.keys, batch_ts=batch_ts, columns=gold.HISTORY_COLUMNS,
            since=since, recency_col=R.RECENCY_COLUMN if since else None, changes_only=True,
        ))
    dim = dimension.read() if dimension.exists() else None
    hoods, hoods_version = sources.changes_since(*SILVER_HOODS, dimension.progress(seen_hoods))
    fresh = materialize(gold.dim_new_rows(dim, hoods), "dimension-run") if hoods is not None else None
    new_dim = fresh if dim is None else dim if fresh is None else dim.unionByName(fresh, allowMissingColumns=True)
    part = history.candidate(staged, None if full_tests else batch_ts)
    tests = checks.gold_tests(gold.fact_view(part), new_dim)
    if run_tests:
        tests = materialize(tests, "gold-tests")
        checks.gate(tests)
    if fresh is not None:
        stream = (seen_hoods, hoods_version) if hoods_version is not None else None
        if dim is None or set(fresh.columns) - set(dim.columns):
            dimension.replace(new_dim, stream=stream)
        else:
            touched = dimension.touched(fresh)
            if touched:
                dimension.replace(dimension.read(touched).unionByName(fresh, allowMissingColumns=True), touched, stream=stream)
            elif stream and dimension.progress(seen_hoods) != hoods_version:
                dimension.replace(None, [], stream=stream)
    if staged is not None:
        history.publish(staged, (seen_listings, version) if version is not None else None)
    return GoldResult(gold.fact_view(history.read()), dimension.read(), tests)
