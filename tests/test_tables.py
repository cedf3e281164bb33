"""Versioned keyed sink (O5), constraint gate (O28e), data tests (O28a-d), bronze."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from strata import registry as R
from strata import session
from strata.operators import checks, merge, metrics
from strata.sources import bronze
from strata.sources import files
from strata.sources.tables import Sources, VersionedTable, WriteConflict

REG = (
    R.ColumnSpec("a", R.STRING, False, key=True, merge=R.MERGE_KEY),
    R.ColumnSpec("b", R.STRING, False),
)


def test_sink_counts_and_selects(spark, scratch_dir):
    t = VersionedTable(spark, scratch_dir, REG, "t")
    with pytest.raises(RuntimeError):
        t.verify()
    t.create()
    t.verify()
    batch = spark.createDataFrame([("1", "x", "extra"), ("2", "y", "extra")], "a string, b string, extra string")
    assert t.write(batch, batch=batch) == 2
    assert t.read().columns == ["a", "b"]  # extra column ignored
    assert t.write(batch.limit(0), batch=batch.limit(0)) == 0  # empty: no-op
    assert t.current_version() == 1


def test_gate_blocks_write(spark, scratch_dir):
    t = VersionedTable(spark, scratch_dir, REG, "t")
    t.create()
    bad = spark.createDataFrame([("1", None), ("1", "y")], "a string, b string")
    with pytest.raises(checks.GateError) as err:
        t.write(bad, batch=bad)
    tests = {(v["test"], v["column_name"]): v["failures"] for v in err.value.violations}
    assert tests == {("not_null", "b"): 1, ("primary_key", "a"): 1}
    assert t.current_version() == 0 and t.read().count() == 0  # nothing written


def overwrite(stored, batch):
    return stored.join(batch.select("a"), "a", "left_anti").unionByName(batch)


def rows_of(spark, *pairs):
    return spark.createDataFrame(list(pairs), "a string, b string")


def test_second_writer_is_told_and_a_merge_starts_again(spark, scratch_dir):
    one, two = (VersionedTable(spark, scratch_dir, REG, "t") for _ in range(2))
    one.create()
    two.create()
    assert one.read().count() == two.read().count() == 0  # both start from the same version
    one.write(rows_of(spark, ("1", "x")))
    with pytest.raises(WriteConflict):
        two.write(rows_of(spark, ("2", "y")))
    assert sorted(map(tuple, two.read().collect())) == [("1", "x")]  # nothing is lost, the loser sees it now
    batch = rows_of(spark, ("1", "z"), ("3", "w"))
    raced = []

    def slow(stored, rows):
        if not raced:  # somebody commits while this merge is computed
            raced.append(one.merge(rows_of(spark, ("4", "v")), overwrite))
        return overwrite(stored, rows)

    assert two.merge(batch, slow) == 2
    one.refresh()
    assert sorted(map(tuple, one.read().collect())) == [("1", "z"), ("3", "w"), ("4", "v")]


def test_merge_leaves_untouched_buckets_alone(spark, scratch_dir):
    t = VersionedTable(spark, scratch_dir, REG, "t", buckets=8)
    t.create()
    t.merge(rows_of(spark, *[(str(i), "old") for i in range(200)]), overwrite)
    before = t.data_folders()
    assert len(before) == 8
    t.merge(rows_of(spark, ("17", "new")), overwrite)
    after = t.data_folders()
    assert sum(before[b] != after[b] for b in before) == 1
    assert t.read().count() == 200 and t.read().where("b = 'new'").count() == 1
    t.merge(rows_of(spark, ("18", "new")), overwrite)
    kept = set(t.data_folders().values())
    assert t.expire(keep=1) == 0  # the first folder still holds untouched buckets
    t.merge(rows_of(spark, *[(str(i), "all") for i in range(200)]), overwrite)
    assert t.expire(keep=1) > 0 and t.read().where("b = 'all'").count() == 200
    assert not any(files.exists(spark, p) for p in kept)


VERSIONED = (
    R.ColumnSpec("a", R.STRING, False, key=True, merge=R.MERGE_KEY),
    R.ColumnSpec("b", R.STRING, False),
    R.ColumnSpec("h", R.STRING, False, merge=R.MERGE_ALWAYS),
    R.ColumnSpec("at", R.T.LongType(), False, merge=R.MERGE_ALWAYS),
)


def test_merges_write_only_buckets_that_change(spark, scratch_dir):
    t = VersionedTable(spark, scratch_dir, VERSIONED, "t")
    t.create()

    def load(*rows, stream=None):
        batch = spark.createDataFrame(list(rows), "a string, b string, h string, at long")
        guard = {"hash_col": "h", "recency_col": "at"}
        return t.merge(
            batch, lambda s, b: merge.upsert_hash_guarded(s, b, VERSIONED, mark=True, **guard), stream=stream,
            effect=lambda s, b: merge.guarded_effect(s, b, VERSIONED, **guard),
        )

    first = [(str(i), "old", "h0", 5) for i in range(0, 400, 2)]
    assert load(*first) == 200
    folders, version = t.data_folders(), t.current_version()
    assert load(*first) == 200 and load(("2", "late", "h9", 4)) == 1  # the same batch again, an older row
    assert t.current_version() == version and t.data_folders() == folders  # nothing is written
    assert load(("2", "late", "h9", 4), stream=("s", 7)) == 1
    assert t.data_folders() == folders and t.progress("s") == 7  # progress only
    assert load(*first[2:50], ("2", "new", "h1", 6), ("7", "first", "h0", 1)) == 50
    moved = {b for b, p in t.data_folders().items() if folders.get(b) != p}
    assert moved == set(t.touched(spark.createDataFrame([("2",), ("7",)], "a string")))
    got = {r["a"]: r["b"] for r in t.read().collect()}
    assert len(got) == 201 and got["2"] == "new" and got["7"] == "first" and got["4"] == "old"


def test_small_lookups_skip_row_groups_without_their_keys(spark, scratch_dir):
    t = VersionedTable(spark, scratch_dir, REG, "t", buckets=2)
    t.create()
    t.write(rows_of(spark, *[(f"{i:05d}", "x") for i in range(0, 20_000, 2)]))

    def read_rows(*keys):
        found = t.lookup(["0", "1"], spark.createDataFrame([(k,) for k in keys], "a string"), len(keys))
        run = found._jdf.queryExecution()
        return run.toRdd().count(), sum(leaf.metrics().apply("numOutputRows").value() for leaf in _leaves(run.executedPlan()))

    absent = [f"{i:05d}" for i in range(1001, 1031, 2)]  # inside the range of the stored keys
    assert read_rows(*absent) == (0, 0)
    count, scanned = read_rows("00500", *absent)
    assert count == 1 and 0 < scanned < 10_000  # one bucket of two


def _leaves(plan):
    found = plan.collectLeaves()
    return [found.apply(i) for i in range(found.size())]


def test_scratch_folders_go(spark):
    with session.scratch(spark):
        path = session.workspace(spark, "gone")
        spark.range(3).write.parquet(path)
        assert files.exists(spark, path)
    assert not files.exists(spark, path)
    kept = session.workspace(spark, "kept")
    spark.range(3).write.parquet(kept)
    assert files.exists(spark, kept)


def test_changes_since_a_version(spark, scratch_dir):

    t = VersionedTable(spark, scratch_dir, REG, "t", buckets=8)
    t.create()
    load = lambda *pairs: t.merge(rows_of(spark, *pairs), lambda s, b: merge.upsert_overwrite(s, b, REG, batch_ts=None, mark=True))
    load(*[(str(i), "old") for i in range(200)])
    first = t.current_version()
    assert t.changes_since(first) is None and t.changes_since(None).count() == 200
    load(("17", "new"), ("new", "new"))
    assert sorted(r.a for r in t.changes_since(first).collect()) == ["17", "new"]  # not their whole buckets
    second = t.current_version()
    load(("17", "newer"))
    again = t.changes_since(first).collect()  # a bucket that was rewritten twice is told whole
    assert {"17", "new"} <= {r.a for r in again} and len(again) < 200
    assert [r.a for r in t.changes_since(second).collect()] == ["17"]
    t.expire(keep=1)
    assert t.changes_since(first).count() == 201  # the older version is not known any more


def test_rebucket(spark, scratch_dir):
    t = VersionedTable(spark, scratch_dir, REG, "t", buckets=4)
    t.create()
    t.merge(rows_of(spark, *[(str(i), "old") for i in range(100)]), overwrite)
    assert len(t.data_folders()) == 4 and t.rebucket(32) == 32
    other = VersionedTable(spark, scratch_dir, REG, "t")  # the number of buckets is the table's, not the reader's
    assert other.read().count() == 100 and other.buckets == 32
    other.merge(rows_of(spark, ("5", "new")), overwrite)
    assert other.read().where("b = 'new'").count() == 1 and other.read().count() == 100
    assert other.rebucket() == 16


def test_claim_of_a_dead_writer_is_passed_over(spark, scratch_dir):
    t = VersionedTable(spark, scratch_dir, REG, "t")
    t.create()
    files.create(spark, f"{scratch_dir}/_commits/00000001.json", "")
    t.refresh()
    t.write(rows_of(spark, ("1", "x")))
    assert t.current_version() == 2 and VersionedTable(spark, scratch_dir, REG, "t").read().count() == 1


def test_only_a_missing_folder_reads_as_empty(spark, scratch_dir):
    files.create(spark, f"{scratch_dir}/broken/part-0.parquet", "not parquet")
    with pytest.raises(Exception):  # noqa: B017
        bronze.read_bronze(spark, f"{scratch_dir}/broken", schema=bronze.bronze_schema()).count()


def test_appended_columns_are_stored(spark, scratch_dir):
    t = VersionedTable(spark, scratch_dir, REG, "t", evolve=True)
    t.create()
    t.write(rows_of(spark, ("1", "x")))
    t.write(t.read().withColumn("region", F.lit("north")))
    assert t.read().columns == ["a", "b", "region"] and t.read().first().region == "north"


def test_sources_by_name(spark):
    sources = Sources({("silver", "t"): rows_of(spark, ("1", "x"))})
    assert sources.source("silver", "t").count() == 1
    with pytest.raises(KeyError):
        sources.source("silver", "u")


def test_gold_tests_count_violations(spark):
    fact = spark.createDataFrame(
        [("s1", "1", "w", "n1", "h", dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 1)),
         ("s1", "1", "w", "n9", None, dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 1)),
         ("s2", "2", "w", None, "h", dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2))],
        "scd_id string, listing_id string, website string, neighbourhood_sk string, row_hash string, "
        "scraped_at timestamp, valid_from timestamp",
    )
    dim = spark.createDataFrame([("n1", "A", "toronto", dt.datetime(2026, 1, 1))],
                                "neighbourhood_sk string, neighbourhood string, city string, loaded_at timestamp")
    got = {(r.test, r.column_name): r.failures for r in checks.gold_tests(fact, dim).collect() if r.failures}
    assert got == {
        ("not_null", "row_hash"): 1,
        ("unique", "scd_id"): 1,
        ("relationships", "neighbourhood_sk"): 1,
        ("unique_combination", "listing_id,website,valid_from"): 1,
    }


def test_uniqueness_in_one_grouping(spark):
    rows = [("1", "2:3", None), ("1", "2:3", None), ("12", ":3", None), ("1", None, "x"), ("1", None, "x"), (None, "-", "y"), (None, "-", "z"), ("-", None, "w")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    tests = [("unique", ["a"]), ("unique", ["c"]), ("unique_combination", ["a", "b"]), ("unique_combination", ["a", "b", "c"])]
    found = checks.uniqueness(df, "m", tests)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    single = [checks.unique(df, "m", c[0]) if n == "unique" else checks.unique_combination(df, "m", c) for n, c in tests]
    assert sorted(map(tuple, found.collect())) == sorted(tuple(s.first()) for s in single)


def test_bronze_partitions_roundtrip(spark, scratch_dir):
    rows = spark.createDataFrame(
        [("1", "toronto", "a"), ("2", "toronto", "b"), ("3", "london", "c")], "listing_id string, city string, v string"
    )
    for day in ("2026-03-01", "2026-03-02"):
        bronze.write_bronze(bronze.with_partition_columns(rows, source="example", day=day), scratch_dir)
    # rerun of one day replaces only that day
    bronze.write_bronze(bronze.with_partition_columns(rows.limit(1), source="example", day="2026-03-02"), scratch_dir)
    schema = bronze.bronze_schema(data_schema=rows.schema)
    got = bronze.read_bronze(spark, scratch_dir, source="example", cities=["toronto"], dates=["2026-03-01", "2026-03-02"],
                             schema=schema)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*city[^\]]*toronto", plan)
    assert got.count() == 3
    assert bronze.read_bronze(spark, scratch_dir + "/missing", schema=schema).count() == 0


def test_union_is_strict(spark):
    a = spark.createDataFrame([("1", "x")], "a string, b string")
    b = spark.createDataFrame([("y", "2")], "b string, a string")
    assert sorted(map(tuple, bronze.union_frames([a, b]).collect())) == [("1", "x"), ("2", "y")]
    c = spark.createDataFrame([("3",)], "a string")
    with pytest.raises(Exception):
        bronze.union_frames([a, c]).collect()


def test_manifest_sink(spark, scratch_dir):
    rows = spark.createDataFrame([("1", "toronto"), ("2", "toronto"), ("3", "london")], "listing_id string, city string")
    parts = bronze.with_partition_columns(rows, source="example", day="2026-03-01")
    bronze.write_bronze(parts, scratch_dir)
    man = bronze.manifest(parts, mode="last_x_days", days=7, max_pages=10, saved_at=dt.datetime(2026, 3, 1, 12))
    bronze.write_manifest(man, scratch_dir)
    back = spark.read.json(f"{scratch_dir}/_manifest")
    got = {r.city: r.record_count for r in back.collect()}
    assert got == {"toronto": 2, "london": 1}
    # the manifest folder is invisible to the data scan
    assert bronze.read_bronze(spark, scratch_dir, schema=bronze.bronze_schema(data_schema=rows.schema)).count() == 3


def test_wanted_partitions_and_coverage(spark):
    with pytest.raises(ValueError):
        bronze.wanted_dates(mode="specific_date", today="2026-03-03")
    assert bronze.wanted_dates(mode="last_x_days", days=3, today="2026-03-03") == ["2026-03-03", "2026-03-02", "2026-03-01"]
    wanted = bronze.wanted_partitions(spark, source="example", cities=["toronto", "london"], days=2, today="2026-03-03")
    assert wanted.count() == 4
    data = spark.createDataFrame([("example", "toronto", "2026-03-03")], "source string, city string, dt string")
    cov = {(r.city, r.dt): r.status for r in metrics.coverage(data, wanted, ["source", "city", "dt"]).collect()}
    assert cov[("toronto", "2026-03-03")] == "success"
    assert cov[("london", "2026-03-02")] == "completed_no_data"


def test_wanted_frame_prunes_the_scan(spark, scratch_dir):
    rows = spark.createDataFrame([(str(i), "toronto" if i % 2 else "london", "v") for i in range(20)], "listing_id string, city string, v string")
    for day in range(1, 6):
        bronze.write_bronze(bronze.with_partition_columns(rows, source="example", day=f"2026-03-0{day}"), scratch_dir)
    wanted = bronze.wanted_partitions(spark, source="example", cities=["london"], days=2, today="2026-03-04")
    got = bronze.read_wanted(spark, scratch_dir, wanted.unionByName(wanted), bronze.bronze_schema(data_schema=rows.schema))
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.city, r.dt) for r in got.collect()) == sorted([("london", d) for d in ("2026-03-03", "2026-03-04")] * 10)


def test_states_merge_over_runs(spark):
    rows = [("example", f"c{i % 3}", f"2026-03-0{1 + i % 4}", str(i % 700) if i % 11 else " ", "w", f"n{i % 40}") for i in range(3000)]
    df = spark.createDataFrame(rows, "source string, city string, dt string, listing_id string, website string, neighbourhood string")
    states = metrics.partition_states(df)
    one, two = states.where("dt < '2026-03-03'"), states.where("dt >= '2026-03-03'")
    got = {r.city: r for r in metrics.merge_states(one.unionByName(two), by=["city"]).collect()}
    for city in ("c0", "c1", "c2"):
        own = [r for r in rows if r[1] == city]
        valid = [r for r in own if r[3].strip()]
        assert (got[city].rows_read, got[city].dropped_invalid_key, got[city].partitions) == (len(own), len(own) - len(valid), 4)
        assert abs(got[city].listings / len({r[3] for r in valid}) - 1) < 0.05 and got[city].neighbourhoods == len({r[5] for r in valid})


def test_default_tie_break_keeps_what_the_cleaning_keeps(spark):
    from strata.operators import silver

    day = dt.datetime(2026, 3, 1)
    rows = [("example", "toronto", "d", "1", "w", n, day) for n in ("b", None, "a")] + [("example", "toronto", "d", "2", "w", "x", None), ("example", "toronto", "d", "2", "w", None, day)]
    df = spark.createDataFrame(rows, "source string, city string, dt string, listing_id string, website string, neighbourhood string, scraped_at timestamp")
    found = metrics.partition_metrics(df, required=["neighbourhood"]).first()
    kept = silver.keep_latest(df, ["listing_id", "website"], order_by=["scraped_at"], tiebreak=["neighbourhood"]).collect()
    assert {r.listing_id: r.neighbourhood for r in kept} == {"1": "a", "2": None}
    assert (found.status, found.rows_read, found.dropped_duplicate) == ("error", 5, 3)


def test_rollup_status(spark):
    m = spark.createDataFrame([(5, 4, 1, "success"), (0, 0, 0, "completed_no_data")],
                              "rows_read long, rows_loaded long, neighbourhoods_loaded long, status string")
    r = metrics.rollup(m).first()
    assert (r.status, r.total_read, r.partitions_ok, r.partitions_no_data) == ("success", 5, 1, 1)
    none = metrics.rollup(m.where(F.col("rows_read") == 0)).first()
    assert none.status == "completed_no_data"
    err = metrics.rollup(m.withColumn("status", F.lit("error"))).first()
    assert err.status == "error"
