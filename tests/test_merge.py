"""Keyed merges (O22, O23): the stored/incoming decision table, and the plan of a merge into a stored table."""

from __future__ import annotations

import datetime as dt

from strata import registry as R
from strata.operators import merge

# A small registry with the same roles as the listings table.
REG = (
    R.ColumnSpec("listing_id", R.STRING, False, key=True, merge=R.MERGE_KEY),
    R.ColumnSpec("website", R.STRING, False, key=True, merge=R.MERGE_KEY),
    R.ColumnSpec("title", R.STRING),
    R.ColumnSpec("rent", R.DOUBLE),
    R.ColumnSpec("row_hash", R.STRING, False, merge=R.MERGE_ALWAYS),
    R.ColumnSpec("scraped_at", R.TIMESTAMP, False, merge=R.MERGE_ALWAYS),
)
SCHEMA = R.spark_schema(REG)


def day(n):
    return dt.datetime(2026, 3, n)


STORED = [("1", "w", "old", 100.0, "h1", day(2))]


def merged(spark, incoming):
    s = spark.createDataFrame(STORED, SCHEMA)
    i = spark.createDataFrame(incoming, SCHEMA)
    out = merge.upsert_hash_guarded(s, i, REG)
    return {r.listing_id: r for r in out.collect()}


def test_decision_table(spark):
    # same hash, newer: only always-update columns move
    r = merged(spark, [("1", "w", "new", 100.0, "h1", day(3))])["1"]
    assert (r.title, r.scraped_at) == ("old", day(3))
    # different hash, newer: the incoming row wins
    r = merged(spark, [("1", "w", "new", 200.0, "h2", day(3))])["1"]
    assert (r.title, r.rent, r.row_hash, r.scraped_at) == ("new", 200.0, "h2", day(3))
    # equal time passes the guard
    r = merged(spark, [("1", "w", "new", 200.0, "h2", day(2))])["1"]
    assert r.title == "new"
    # older: untouched
    r = merged(spark, [("1", "w", "new", 200.0, "h2", day(1))])["1"]
    assert (r.title, r.rent, r.row_hash, r.scraped_at) == ("old", 100.0, "h1", day(2))
    # new key: inserted, stored key kept
    rows = merged(spark, [("2", "w", "x", 5.0, "h9", day(1))])
    assert set(rows) == {"1", "2"} and rows["1"].title == "old"


def test_incoming_nulls_overwrite(spark):
    r = merged(spark, [("1", "w", None, None, "h2", day(3))])["1"]
    assert r.title is None and r.rent is None


def test_whole_tables_and_idempotent(spark):
    stored = [(str(i), "w", f"t{i}", float(i), f"h{i % 3}", day(1 + i % 5)) for i in range(50)]
    incoming = [(str(i), "w", f"n{i}", float(i) * 2, f"h{i % 4}", day(1 + i % 7)) for i in range(25, 80)]
    s = spark.createDataFrame(stored, SCHEMA)
    i = spark.createDataFrame(incoming, SCHEMA)
    a = merge.upsert_hash_guarded(s, i, REG)
    want = {r[0]: r for r in stored}
    for r in incoming:
        old = want.get(r[0])
        if old is None or (r[5] >= old[5] and r[4] != old[4]):
            want[r[0]] = r
        elif r[5] >= old[5]:
            want[r[0]] = (*old[:4], r[4], r[5])
    assert sorted(map(tuple, a.collect())) == sorted(want.values())
    changed = {r.listing_id for r in merge.upsert_hash_guarded(s, i, REG, mark=True).where("__changed").collect()}
    assert changed == {k for k, r in want.items() if (k, *r[1:4]) not in {(x[0], *x[1:4]) for x in stored}}
    again = merge.upsert_hash_guarded(a, i, REG)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, a.collect()))


def test_guard_is_monotone(spark):
    # applying an older batch after a newer one changes nothing
    s = spark.createDataFrame(STORED, SCHEMA)
    newer = spark.createDataFrame([("1", "w", "new", 200.0, "h2", day(5))], SCHEMA)
    older = spark.createDataFrame([("1", "w", "mid", 150.0, "h3", day(4))], SCHEMA)
    after_new = merge.upsert_hash_guarded(s, newer, REG)
    both = merge.upsert_hash_guarded(after_new, older, REG)
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, after_new.collect()))


def test_overwrite_upsert(spark):
    ts1, ts2 = dt.datetime(2030, 1, 1), dt.datetime(2030, 2, 1)
    empty = spark.createDataFrame([], R.spark_schema(R.NEIGHBOURHOODS))
    first = spark.createDataFrame([("A", "toronto", 1.0, 2.0, 3.0), ("B", "toronto", 4.0, 5.0, 6.0)],
                                  "neighbourhood string, city string, walk_score double, transit_score double, bike_score double")
    second = spark.createDataFrame([("A", "toronto", None, 9.0, 9.0)], first.schema)
    stored = merge.upsert_overwrite(empty, first, batch_ts=ts1)
    out = {r.neighbourhood: r for r in merge.upsert_overwrite(stored, second, batch_ts=ts2).collect()}
    assert out["A"].walk_score is None and out["A"].transit_score == 9.0 and out["A"].loaded_at == ts2
    assert out["B"].walk_score == 4.0 and out["B"].loaded_at == ts1


def test_stored_side_of_a_bucketed_table_is_not_exchanged(spark, scratch_dir):
    from strata.sources.tables import VersionedTable

    table = VersionedTable(spark, scratch_dir, REG, "t")
    table.replace(spark.createDataFrame([(str(i), "w", "old", 1.0, "h1", day(2)) for i in range(300)], SCHEMA))
    batch = spark.createDataFrame([("7", "w", "new", 2.0, "h2", day(3)), ("x", "w", "new", 2.0, "h2", day(3))], SCHEMA)
    plans = []

    def how(stored, rows):
        out = merge.upsert_hash_guarded(stored, rows, REG, mark=True)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    assert table.merge(batch, how) == 2
    assert "Bucketed: true" in plans[0] and plans[0].count("Exchange") == 1  # the batch only
    assert "PartitionFilters: [__bucket" in plans[0]  # of the touched buckets
    got = {r.listing_id: r.title for r in table.read().collect()}
    assert len(got) == 301 and got["7"] == got["x"] == "new" and got["8"] == "old"
    files_of_a_bucket = {p: len([f for f in __import__("os").listdir(p) if f.startswith("part-")]) for p in table.data_folders().values()}
    assert set(files_of_a_bucket.values()) == {1}
