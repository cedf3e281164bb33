"""SCD2 snapshot (O24) and log form (O25), appended parts included."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from strata.operators import scd2

SRC = "listing_id string, website string, rent double, row_hash string"
T1, T2, T3 = dt.datetime(2026, 1, 15), dt.datetime(2026, 2, 20), dt.datetime(2026, 3, 1)
KEYS = ("listing_id", "website")


def snap(spark, hist, rows, ts):
    return scd2.scd2_snapshot(hist, spark.createDataFrame(rows, SRC), key_cols=KEYS, batch_ts=ts)


def test_readme_example(spark):
    h = snap(spark, None, [("123", "example", 1800.0, "a")], T1)
    h = snap(spark, h, [("123", "example", 2000.0, "b")], T2)
    rows = sorted(h.collect(), key=lambda r: r.valid_from)
    assert [(r.rent, r.valid_from, r.valid_to) for r in rows] == [(1800.0, T1, T2), (2000.0, T2, None)]
    assert rows[0].scd_id != rows[1].scd_id


def test_unchanged_and_absent_keys(spark):
    h = snap(spark, None, [("1", "w", 1.0, "a"), ("2", "w", 2.0, "b")], T1)
    h2 = snap(spark, h, [("1", "w", 9.0, "a")], T2)  # same hash: values not refreshed; key 2 absent
    rows = {r.listing_id: r for r in h2.collect()}
    assert len(rows) == 2
    assert rows["1"].rent == 1.0 and rows["1"].valid_to is None
    assert rows["2"].valid_to is None
    again = snap(spark, h2, [("1", "w", 9.0, "a")], T3)  # rerun with same source adds nothing
    assert again.count() == 2


def test_changes_only_are_what_a_run_closes_and_opens(spark):
    h = snap(spark, None, [(str(i), "w", float(i), f"h{i % 3}") for i in range(30)], T1)
    src = spark.createDataFrame([(str(i), "w", float(i) * 2, f"h{i % 4}") for i in range(20, 45)], SRC)
    whole = scd2.scd2_snapshot(h, src, key_cols=KEYS, batch_ts=T2)
    changes = scd2.scd2_snapshot(h, src, key_cols=KEYS, batch_ts=T2, changes_only=True)
    rows = sorted(map(str, changes.collect()))
    before = set(map(str, h.collect()))
    assert rows == sorted(str(r) for r in whole.collect() if str(r) not in before) and len(rows) > 20
    assert scd2.scd2_snapshot(whole, src, key_cols=KEYS, batch_ts=T3, changes_only=True).count() == 0


def _invariants(rows):
    by_key = {}
    for r in rows:
        by_key.setdefault((r.user_id, r.event_type), []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r.valid_from)
        assert sum(1 for v in versions if v.valid_to is None) == 1
        for a, b in zip(versions, versions[1:]):
            assert a.valid_to == b.valid_from


def test_snapshot_repeated_equals_log(spark):
    rng = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    times = [base + dt.timedelta(hours=7 * k) for k in range(24)]
    seen, events = set(), []
    for i in range(300):
        e = (i, rng.choice(times), rng.randrange(4), rng.choice("ab"), rng.randrange(3))
        if (e[1], e[2], e[3]) not in seen:  # one row per key and time, as a snapshot source has
            seen.add((e[1], e[2], e[3]))
            events.append(e)
    ev = spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string, state int")
    cols = ("user_id", "event_type", "state", "ts")
    log_hist = scd2.scd2_from_log(
        ev, key_cols=("user_id", "event_type"), ts_col="ts", check_cols=["state"], columns=cols, tiebreak=["event_id"]
    )
    hist = None
    for t in sorted({e[1] for e in events}):
        state = ev.where(F.col("ts") == F.lit(t)).select(*cols)
        hist = scd2.scd2_snapshot(hist, state, key_cols=("user_id", "event_type"), check_cols=["state"], batch_ts=t,
                                  columns=cols)
        hist = hist.checkpoint()  # keep the lineage of the repeated runs short
    a = sorted((r.user_id, r.event_type, r.state, r.valid_from, r.valid_to) for r in log_hist.collect())
    b = sorted((r.user_id, r.event_type, r.state, r.valid_from, r.valid_to) for r in hist.collect())
    assert a == b
    _invariants(log_hist.collect())


def test_append_equals_the_whole_log(spark):
    how = {"key_cols": ("user_id", "event_type"), "ts_col": "ts", "check_cols": ["state"], "columns": ("user_id", "event_type", "state", "ts"), "tiebreak": ["event_id"]}
    for seed in (1, 2):
        rng = random.Random(seed)
        base = dt.datetime(2024, 1, 1)
        rows = [(i, base + dt.timedelta(hours=rng.randrange(400)), rng.choice([None, 1, 1, 2, 3]), rng.choice("ab"), rng.randrange(3)) for i in range(400)]
        ev = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, state int").withColumn("late", F.rand(seed) < 0.1).checkpoint()
        log, part = ev.where("not late").drop("late"), ev.where("late").drop("late")
        hist = scd2.scd2_from_log(log, **how).checkpoint()
        got = scd2.scd2_append(hist, log, part, **how)
        want = scd2.scd2_from_log(ev.drop("late"), **how)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
        assert scd2.scd2_append(hist, log, part.limit(0), **how).count() == hist.count()
