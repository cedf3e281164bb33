"""Layer runs (O30): a bronze-to-silver run over wanted partitions, then silver-to-gold."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import registry as R
from strata.operators import checks, gold, merge, scd2, silver
from strata.plans import layers
from strata.sources import bronze
from strata.sources.tables import Sources, VersionedTable


def _rows(spark, specs):
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in R.BRONZE_SCHEMA.fields])
    out = []
    for lid, city, hood, rent, day in specs:
        rec = {c: None for c in R.BRONZE_COLUMNS}
        rec.update(listing_id=lid, website="example", url=f"https://x/{lid}", title=" t ", description="d", street="s",
                   city=city, neighbourhood=hood, rent=rent, images=[], published_at=dt.datetime(2026, 3, 1),
                   scraped_at=dt.datetime(2026, 3, day, 12))
        out.append(tuple(rec[c] for c in R.BRONZE_COLUMNS))
    return spark.createDataFrame(out, schema)


def test_bronze_to_silver_to_gold(spark, scratch_dir):
    root = f"{scratch_dir}/bronze"
    day1 = _rows(spark, [("1", "toronto", "A", 100.0, 1), ("2", "toronto", "B", 200.0, 1), ("", "toronto", "A", 1.0, 1)])
    day2 = _rows(spark, [("2", "toronto", "B", 250.0, 2), ("3", "london", "C", 300.0, 2)])
    bronze.write_bronze(bronze.with_partition_columns(day1, source="example", day="2026-03-01"), root)
    bronze.write_bronze(bronze.with_partition_columns(day2, source="example", day="2026-03-02"), root)

    t = {
        "listings": VersionedTable(spark, f"{scratch_dir}/silver/listings", R.LISTINGS, "rental_listings"),
        "hoods": VersionedTable(spark, f"{scratch_dir}/silver/hoods", R.NEIGHBOURHOODS, "neighbourhoods"),
        "history": layers.History(spark, f"{scratch_dir}/gold/history"),
        "dim": VersionedTable(spark, f"{scratch_dir}/gold/dim", layers.DIM_REGISTRY, "dim"),
    }
    missing = layers.bronze_to_silver(spark, bronze_root=root, listings=t["listings"], neighbourhoods=t["hoods"],
                                      source="example", mode="specific_date", batch_ts="2026-03-01 13:00:00")
    assert missing.status == "error" and "specific_date" in missing.message and not t["listings"].exists()
    # the default run looks at today's partitions, which are empty here
    today = layers.bronze_to_silver(spark, bronze_root=root, listings=t["listings"], neighbourhoods=t["hoods"], source="example",
                                    batch_ts="2026-03-01 13:00:00")
    assert today.status == "completed_no_data" and today.rows_loaded == 0

    # run 1: only 2026-03-01, all cities
    r1 = layers.bronze_to_silver(spark, bronze_root=root, listings=t["listings"], neighbourhoods=t["hoods"],
                                 source="example", mode="specific_date", specific_date="2026-03-01",
                                 batch_ts="2026-03-01 13:00:00")
    assert r1.rows_loaded == 2 and r1.neighbourhoods_loaded == 2
    m = {(r.city, r.dt): r for r in r1.metrics.collect()}
    assert m[("toronto", "2026-03-01")].rows_read == 3 and m[("toronto", "2026-03-01")].dropped_invalid_key == 1
    assert m[("london", "2026-03-01")].status == "completed_no_data"
    roll = r1.rollup.first()
    assert (roll.status, roll.total_read, roll.partitions_ok, roll.partitions_no_data) == ("success", 3, 1, 2)
    g1 = layers.silver_to_gold(spark, listings=t["listings"], neighbourhoods=t["hoods"], history=t["history"],
                               dimension=t["dim"], batch_ts="2026-03-01 14:00:00")
    assert g1.fact.count() == 2

    # run 2: the last two days up to 2026-03-02 (both partitions; day 1 again is harmless)
    layers.bronze_to_silver(spark, bronze_root=root, listings=t["listings"], neighbourhoods=t["hoods"],
                            source="example", mode="last_x_days", days=2, today="2026-03-02",
                            batch_ts="2026-03-02 13:00:00")
    silver_rows = {r.listing_id: r for r in t["listings"].read().collect()}
    assert set(silver_rows) == {"1", "2", "3"} and silver_rows["2"].rent == 250.0
    assert silver_rows["1"].title == "t"
    g2 = layers.silver_to_gold(spark, listings=t["listings"], neighbourhoods=t["hoods"], history=t["history"],
                               dimension=t["dim"], batch_ts="2026-03-02 14:00:00")
    fact = g2.fact.collect()
    assert len(fact) == 4  # 1 unchanged, 2 closed + reopened, 3 new
    assert sum(1 for r in fact if r.is_current) == 3
    assert g2.dim.count() == 3
    assert all(r.failures == 0 for r in g2.tests.collect())


def test_a_failing_partition_does_not_stop_the_others(spark, scratch_dir):
    root = f"{scratch_dir}/bronze"
    good = _rows(spark, [("1", "toronto", "A", 100.0, 1)])
    broken = _rows(spark, [("2", "london", "B", 200.0, 1), ("3", "london", "B", 300.0, 1)]).withColumn("title", F.expr("if(listing_id = '2', null, title)"))
    for rows in (good, broken):
        bronze.write_bronze(bronze.with_partition_columns(rows, source="example", day="2026-03-01"), root)
    listings = VersionedTable(spark, f"{scratch_dir}/silver/listings", R.LISTINGS, "rental_listings")
    hoods = VersionedTable(spark, f"{scratch_dir}/silver/hoods", R.NEIGHBOURHOODS, "neighbourhoods")
    run = layers.bronze_to_silver(spark, bronze_root=root, listings=listings, neighbourhoods=hoods, source="example",
                                  mode="specific_date", specific_date="2026-03-01", batch_ts="2026-03-01 13:00:00")
    status = {r.city: (r.status, r.rows_read, r.rows_loaded) for r in run.metrics.collect() if r.status != "completed_no_data"}
    assert status == {"toronto": ("success", 1, 1), "london": ("error", 2, 0)}
    assert run.status == "error" and [r.listing_id for r in listings.read().collect()] == ["1"]


def _versions(spark, *rows):
    """History rows of (listing, rent, valid_from day, valid_to day)."""
    cols = list(gold.HISTORY_COLUMNS)
    types = {c.name: c.dtype for c in layers.HISTORY_REGISTRY}
    schema = T.StructType([T.StructField(c, types[c], True) for c in [*cols, "scd_id", "updated_at", "valid_from", "valid_to"]])
    day = lambda d: d and dt.datetime(2026, 3, d)
    out = []
    for lid, rent, start, stop in rows:
        rec = {c: None for c in schema.names}
        rec.update(listing_id=lid, website="example", rent=rent, scd_id=f"{lid}@{start}", valid_from=day(start), valid_to=day(stop), updated_at=day(start))
        out.append(tuple(rec[c] for c in schema.names))
    return spark.createDataFrame(out, schema)


def test_closed_versions_appear_with_their_run_only(spark, scratch_dir, monkeypatch):
    history = layers.History(spark, f"{scratch_dir}/history")
    history.apply(_versions(spark, ("1", 10.0, 1, None), ("2", 20.0, 1, None)))
    seen = lambda: sorted((r.listing_id, r.valid_from.day, r.valid_to and r.valid_to.day) for r in layers.History(spark, f"{scratch_dir}/history").read().collect())
    assert seen() == [("1", 1, None), ("2", 1, None)]
    run = lambda d: _versions(spark, ("1", 10.0, 1, d), ("1", 11.0, d, None), ("2", 20.0, 1, None))
    commit = VersionedTable._commit
    monkeypatch.setattr(VersionedTable, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):  # dies after the closed rows are written, before the commit
        history.apply(run(2))
    monkeypatch.setattr(VersionedTable, "_commit", commit)
    assert seen() == [("1", 1, None), ("2", 1, None)]
    layers.History(spark, f"{scratch_dir}/history").apply(run(3))  # a retry with a later time
    assert seen() == [("1", 1, 3), ("1", 3, None), ("2", 1, None)]


def test_gold_gate_runs_before_anything_is_published(spark, scratch_dir):
    history = layers.History(spark, f"{scratch_dir}/gold/history")
    dim = VersionedTable(spark, f"{scratch_dir}/gold/dim", layers.DIM_REGISTRY, "dim", evolve=True)
    rows = _rows(spark, [("1", "toronto", "A", 100.0, 1)])
    frames = silver.transform_to_silver(rows)
    hoods = frames.neighbourhoods.withColumn("loaded_at", F.lit("2026-03-01").cast("timestamp"))
    orphan = frames.listings.withColumn("neighbourhood", F.lit("nowhere"))
    make = lambda listings: Sources({("silver", "rental_listings"): listings, ("silver", "neighbourhoods"): hoods.withColumn("region", F.lit("east"))})
    with pytest.raises(checks.GateError):
        layers.silver_to_gold(spark, sources=make(orphan), history=history, dimension=dim, batch_ts="2026-03-01 14:00:00")
    assert not history.exists() and not dim.exists()
    done = layers.silver_to_gold(spark, sources=make(frames.listings), history=history, dimension=dim, batch_ts="2026-03-01 14:00:00")
    assert done.fact.count() == 1 and done.dim.first().region == "east"  # a new column of the source reaches the table


def _gold(spark, scratch_dir):
    listings = VersionedTable(spark, f"{scratch_dir}/silver/listings", R.LISTINGS, "rental_listings")
    hoods = VersionedTable(spark, f"{scratch_dir}/silver/hoods", R.NEIGHBOURHOODS, "neighbourhoods")
    history = layers.History(spark, f"{scratch_dir}/gold/history")
    dim = VersionedTable(spark, f"{scratch_dir}/gold/dim", layers.DIM_REGISTRY, "dim", evolve=True)
    return listings, hoods, history, dim


def _load(spark, listings, hoods, rows, ts):
    frames = silver.transform_to_silver(_rows(spark, rows))
    for table in (listings, hoods):
        table.create()
    listings.merge(frames.listings, lambda s, b: merge.upsert_hash_guarded(s, b, batch_ts=ts, mark=True))
    hoods.merge(
        frames.neighbourhoods, lambda s, b: merge.upsert_overwrite(s, b, batch_ts=ts, mark=True),
        gate_rows=frames.neighbourhoods.withColumn("loaded_at", F.lit(ts).cast("timestamp")),
    )


def _files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names}


def test_a_run_without_changes_stores_nothing(spark, scratch_dir):
    listings, hoods, history, dim = _gold(spark, scratch_dir)
    _load(spark, listings, hoods, [(str(i), "toronto", "A", 100.0 + i, 1) for i in range(60)], "2026-03-01 13:00:00")
    run = lambda ts: layers.silver_to_gold(spark, listings=listings, neighbourhoods=hoods, history=history, dimension=dim, batch_ts=ts)
    run("2026-03-01 14:00:00")
    before, scratch = _files(f"{scratch_dir}/gold"), set(os.listdir(os.path.dirname(scratch_dir)))
    second = run("2026-03-02 14:00:00")
    assert second.fact.count() == 60 and _files(f"{scratch_dir}/gold") == before
    made = set(os.listdir(os.path.dirname(scratch_dir))) - scratch
    assert not [m for m in made if m.startswith(("history-run", "dimension-run"))]

    folders = history.current.data_folders()
    _load(spark, listings, hoods, [("7", "toronto", "A", 999.0, 2)], "2026-03-03 13:00:00")
    third = run("2026-03-03 14:00:00")
    assert third.fact.count() == 61 and third.fact.where("is_current").count() == 60
    moved = [b for b, p in history.current.data_folders().items() if folders[b] != p]
    assert len(moved) == 1  # the bucket of the one listing
    staged = [m for m in os.listdir(os.path.dirname(scratch_dir)) if m.startswith("history-run")]
    rows = [spark.read.parquet(os.path.join(os.path.dirname(scratch_dir), m)).count() for m in staged]
    assert 2 in rows  # the closed and the opened version, not the table


def test_snapshot_join_of_bucketed_tables_has_no_exchange(spark, scratch_dir):
    listings, hoods, history, dim = _gold(spark, scratch_dir)
    _load(spark, listings, hoods, [(str(i), "toronto", "A", 100.0 + i, 1) for i in range(60)], "2026-03-01 13:00:00")
    layers.silver_to_gold(spark, listings=listings, neighbourhoods=hoods, history=history, dimension=dim, batch_ts="2026-03-01 14:00:00")
    joined = scd2.scd2_snapshot(history.current.read(), listings.read(), key_cols=history.keys, batch_ts="2026-03-02", columns=gold.HISTORY_COLUMNS, changes_only=True)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") == 2 and "Exchange" not in plan


def test_gold_starts_again_after_a_conflict(spark, scratch_dir, monkeypatch):
    listings, hoods, history, dim = _gold(spark, scratch_dir)
    _load(spark, listings, hoods, [("1", "toronto", "A", 100.0, 1)], "2026-03-01 13:00:00")
    publish, calls = layers.History.publish, []

    def once(self, *a):
        calls.append(1)
        if len(calls) == 1:  # somebody else publishes first: this run's base is stale
            other = layers.History(spark, f"{scratch_dir}/gold/history")
            layers.silver_to_gold(spark, listings=listings, neighbourhoods=hoods, history=other, dimension=VersionedTable(spark, f"{scratch_dir}/gold/dim", layers.DIM_REGISTRY, "dim", evolve=True), batch_ts="2026-03-01 13:30:00")
        return publish(self, *a)

    monkeypatch.setattr(layers.History, "publish", once)
    done = layers.silver_to_gold(spark, listings=listings, neighbourhoods=hoods, history=history, dimension=dim, batch_ts="2026-03-01 14:00:00")
    assert done.fact.count() == 1 and done.dim.count() == 1 and len(calls) >= 2


@pytest.mark.parametrize("full", [False, True])
def test_gold_tests_of_a_run_find_what_the_full_tests_find(spark, scratch_dir, full):
    listings, hoods, history, dim = _gold(spark, scratch_dir)
    _load(spark, listings, hoods, [("1", "toronto", "A", 100.0, 1), ("2", "toronto", "A", 200.0, 1)], "2026-03-01 13:00:00")
    gold_run = lambda frame, ts: layers.silver_to_gold(
        spark, sources=Sources({layers.SILVER_LISTINGS: frame, layers.SILVER_HOODS: hoods.read()}), history=history, dimension=dim, batch_ts=ts, full_tests=full)
    gold_run(listings.read(), "2026-03-01 14:00:00")
    twice = listings.read().where("listing_id = '1'").withColumn("row_hash", F.lit("x"))
    with pytest.raises(checks.GateError) as err:
        gold_run(twice.unionByName(twice.withColumn("row_hash", F.lit("y"))), "2026-03-02 14:00:00")
    assert {v["test"] for v in err.value.violations} == {"unique", "unique_combination"}
    orphan = listings.read().withColumn("row_hash", F.lit("z")).withColumn("neighbourhood", F.lit("nowhere"))
    with pytest.raises(checks.GateError) as err:
        gold_run(orphan, "2026-03-02 14:00:00")
    assert [(v["test"], v["failures"]) for v in err.value.violations] == [("relationships", 2)]
    assert history.read().count() == 2
