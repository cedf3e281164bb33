"""Scalar cleaning and parsing expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strata.functions import (
    double_text,
    has_offset,
    in_bounds,
    parse_float,
    parse_int,
    parse_iso,
    row_hash,
    strip,
    strip_lower,
    surrogate_key,
    to_boolean,
)
from strata.registry import Bounds


def _col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_to_boolean(spark):
    truthy = ["yEs", "\u2003yes\t", "INCLUDED", " included"]
    falsy = ["nO", "\nno", "nOt InClUdEd", "not included\u00a0"]
    other = ["yes.", "not  included", "included yes", "1", "\t", None]
    for words, want in ((truthy, True), (falsy, False), (other, None)):
        assert _col(spark, words, to_boolean) == [want] * len(words)


def test_ranges(spark):
    cases = [
        ([0.0, 10.0, -0.25, 10.25, None], Bounds(0, 10), [0.0, 10.0, None, None, None]),
        ([0.0, 0.125], Bounds(low=0, exclusive=True), [None, 0.125]),
        ([-7.5, 0.0, 1e9], Bounds(low=0), [None, 0.0, 1e9]),
        ([-1e9, 10.0, 10.5], Bounds(high=10), [-1e9, 10.0, None]),
        ([0.0, 9.75, 10.0], Bounds(0, 10, True), [None, 9.75, None]),  # exclusive applies to both ends
    ]
    for values, bounds, want in cases:
        assert _col(spark, values, lambda c, b=bounds: in_bounds(c, b), "double") == want
    # text is cast leniently
    assert _col(spark, [" 7 ", "seven", "7f"], lambda c: in_bounds(c, Bounds(low=0))) == [7.0, None, None]


def test_strip_unicode_space(spark):
    values = ["\u3000Mill  Lane\u2003", "\r\nfourth floor\t", "\u00a0", "x", None]
    assert _col(spark, values, strip) == ["Mill  Lane", "fourth floor", "", "x", None]
    assert _col(spark, [" \u00c9COLE\u00a0", "MiXeD"], strip_lower) == ["\u00e9cole", "mixed"]


def test_parse_float(spark):
    good = {"875": 875.0, "3,040.25": 3040.25, "$640": 640.0, "\t$9,001.5\u00a0": 9001.5, "-0": 0.0, ".5": 0.5, "7.": 7.0,
            "2e3": 2000.0, "1_000": 1000.0, "+4": 4.0}
    bad = [None, "", "\u00a0", "ask", "5d", "640 m2", "1__0", "0x1f", "4 5"]
    assert _col(spark, list(good), parse_float) == list(good.values())
    assert _col(spark, bad, parse_float) == [None] * len(bad)


def test_parse_int(spark):
    good = {"7": 7, "about 64 rooms": 64, "3,040 m": 3040, "No. 8b": 8, "2.5": 25, "-9": 9, "0012": 12}
    bad = [None, "", "\t", "none at all", "99999999999"]
    assert _col(spark, list(good), parse_int) == list(good.values())
    assert _col(spark, bad, parse_int) == [None] * len(bad)


def test_parse_iso(spark):
    values = ["2027-05-04T06:07:08.250Z", "2027-05-04 06:07+00:00", "2024-02-29", None, "", "\t", "soon", "4.5.2027", "2027-02-30",
              "2027-05-04T06:07:08-03:30", "2027-05-04T06:07:08-0330", "2027-05-04 06+01:00", "2027-05-04T06:07"]
    got = _col(spark, values, parse_iso)
    assert got[:3] == [dt.datetime(2027, 5, 4, 6, 7, 8, 250_000), dt.datetime(2027, 5, 4, 6, 7), dt.datetime(2024, 2, 29)]
    assert got[3:9] == [None] * 6
    assert got[9] == got[10] == dt.datetime(2027, 5, 4, 9, 37, 8)
    assert got[11:] == [dt.datetime(2027, 5, 4, 5, 0), dt.datetime(2027, 5, 4, 6, 7)]
    assert _col(spark, values[:3], has_offset) == [True, True, False]


def test_double_text_matches_plain_decimal(spark):
    values = [1500.0, 12000000.0, 0.0005, 1129.4626, -3.5, 0.0]
    assert _col(spark, values, double_text, "double") == ["1500.0", "12000000.0", "0.0005", "1129.4626", "-3.5", "0.0"]


def test_row_hash_properties(spark):
    df = spark.createDataFrame([("x", "1"), ("y", "1"), (None, "1"), ("", "1"), ("ab", "c"), ("a", "bc")], "a string, b string")
    rows = df.select(row_hash(["a", "b"]).alias("h"), row_hash(["b", "a"]).alias("r")).collect()
    hashes = [r.h for r in rows]
    assert all(len(h) == 32 for h in hashes)
    assert hashes[0] != hashes[1]  # values matter
    assert hashes[2] == hashes[3]  # null hashes as ''
    assert hashes[4] != hashes[5]  # the separator keeps fields apart
    assert rows[0].h != rows[0].r  # column order matters
    again = [r.h for r in df.select(row_hash(["a", "b"]).alias("h")).collect()]
    assert again == hashes  # deterministic


def test_surrogate_key_null_propagates(spark):
    df = spark.createDataFrame([("Mill Quarter", "london"), (None, "london")], "n string, c string")
    got = [r[0] for r in df.select(surrogate_key("n", "c")).collect()]
    assert len(got[0]) == 32 and got[1] is None
