"""One key holding a third of all rows: results stay whole and exact, and the plans reduce
the hot key before it is shuffled."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import checks, scd2, silver


def _hot_rows(n=3000, seed=11):
    rng = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rng.randrange(1, 200)  # key 0 holds a third of the rows
        rows.append((i, key, "t", base + dt.timedelta(minutes=rng.randrange(60 * 24 * 30)), rng.randrange(4)))
    return rows


def test_keep_latest_hot_key(spark):
    df = spark.createDataFrame(_hot_rows(), "id long, k long, t string, ts timestamp, v int")
    out = silver.keep_latest(df, ["k", "t"], order_by=["ts"], tiebreak=["id"])
    optimized = out._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in optimized
    w = Window.partitionBy("k", "t").orderBy(F.col("ts").desc(), F.col("id").asc())
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))


def _plain_history(df):
    # one row per (key, time): the last by id, as one snapshot run per time would see
    last = Window.partitionBy("k", "t", "ts").orderBy(F.col("id").desc())
    dedup = df.where("ts is not null").withColumn("r", F.row_number().over(last)).where("r = 1").drop("r")
    w = Window.partitionBy("k", "t").orderBy("ts", "id")
    marked = dedup.withColumn("prev", F.lag("v").over(w)).withColumn("rn", F.row_number().over(w))
    starts = marked.where((F.col("rn") == 1) | ~F.col("v").eqNullSafe(F.col("prev")))
    return starts.select("k", "t", "v", F.col("ts").alias("valid_from"),
                         F.lead("ts").over(Window.partitionBy("k", "t").orderBy("ts", "id")).alias("valid_to"))


def _log(spark, rows):
    return spark.createDataFrame(rows, "id long, k long, t string, ts timestamp, v int")


def _history(df, **more):
    hist = scd2.scd2_from_log(df, key_cols=["k", "t"], ts_col="ts", check_cols=["v"], columns=["k", "t", "v", "ts"], tiebreak=["id"], **more)
    return sorted(map(str, hist.select("k", "t", "v", "valid_from", "valid_to").collect()))


def test_scd2_log_hot_key_matches_plain_window(spark):
    df = _log(spark, _hot_rows())
    assert _history(df) == sorted(map(str, _plain_history(df).collect()))  # nothing dropped or capped


def test_scd2_log_key_hot_inside_one_day(spark):
    rng = random.Random(5)
    base = dt.datetime(2024, 1, 10)
    rows = [(i, 0, "t", base + dt.timedelta(seconds=rng.randrange(80_000)), rng.randrange(2)) for i in range(1200)] + _hot_rows(600)
    df = _log(spark, rows)
    chunks = scd2._chunks(df, ["k", "t"], "ts", 100).where("k = 0").groupBy("_chunk").count()
    assert chunks.agg(F.max("count")).first()[0] < 200  # the busy day is cut into pieces
    assert _history(df, hot_rows=100) == sorted(map(str, _plain_history(df).collect()))


def test_scd2_log_null_keys_and_times(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, None if i % 2 else 1, None if i % 3 else "t", None if i % 11 == 0 else base + dt.timedelta(hours=i * 7), i // 4 % 2) for i in range(80)]
    df = _log(spark, rows)
    assert _history(df) == sorted(map(str, _plain_history(df).collect()))


def test_scd2_log_is_read_and_shuffled_once(spark, tmp_path):
    df = _log(spark, _hot_rows())
    df.write.parquet(str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    plan = scd2.last_per_tie(scd2._chunks(stored, ["k", "t"], "ts", scd2.HOT_ROWS), ["k", "t"], "_chunk", "ts", ["id"])
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert shown.count("FileScan parquet") == 1 and shown.count("Exchange hashpartitioning") == 1
    result = scd2.scd2_from_log(stored, key_cols=["k", "t"], ts_col="ts", check_cols=["v"], columns=["k", "t", "v", "ts"], tiebreak=["id"])
    shown = result._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path) not in shown  # what follows reads the stored versions only


def test_relationships_hot_value(spark):
    child = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"v{i % 7}") for i in range(900)], "id long, fk string")
    parent = spark.createDataFrame([("v1",), ("v2",), ("v3",)], "pk string")
    got = checks.relationships(child, "m", "fk", parent, "pk").first().failures
    want = child.join(parent, child.fk == parent.pk, "left_anti").count()
    assert got == want
