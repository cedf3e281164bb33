"""Whitening against a plain eigendecomposition in numpy."""

from __future__ import annotations

import random

import numpy as np
import pytest

import __spark_entry__ as entry
from strata.llm import whiten
from strata.llm.common import table

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int, block int, n int, part int, x int"


def plain(vectors, components=8):
    x = np.floor(1024 * np.asarray(vectors, dtype=np.float64)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    centred = x - sums / n
    variance, axes = np.linalg.eigh(centred.T @ centred / n)
    variance, axes = variance[::-1], axes[:, ::-1]
    kept = min(components, int((variance > 1e-12 * variance[0]).sum()))
    return deviation, centred @ axes[:, :kept] / np.sqrt(variance[:kept]), variance[:kept] / variance.sum()


def compare(rows, vectors):
    """rows hold vec_id = place in vectors."""
    deviation, whitened, explained = plain(vectors)
    parts = whitened.shape[1]
    assert len(rows) == len(vectors) * parts
    got = np.full(whitened.shape, np.nan)
    for r in rows:
        assert (r["n"], r["deviation"]) == (len(vectors), deviation[r["vec_id"]])
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9 and r["identity_error"] < 1e-9
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
    signs = np.sign((got * whitened).sum(axis=0))
    assert np.abs(got * signs - whitened).max() < 1e-6


def frame(spark, vectors, ids=None):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4, 5) for i, v in zip(ids or range(len(vectors)), vectors, strict=True)], SCHEMA)


def test_given_embeddings(spark):
    rows = table(spark, SF, "embeddings").orderBy("vec_id").collect()
    assert [r["vec_id"] for r in rows] == list(range(len(rows)))
    compare(entry.queries()["op12_whitening"](spark, SF).collect(), [r["embedding"] for r in rows])


@pytest.mark.parametrize("columns", [2, 3, 1024])
def test_many_blocks(spark, monkeypatch, columns):
    monkeypatch.setattr(whiten, "ENTRIES", 50)
    monkeypatch.setattr(whiten, "COLUMNS_A_BLOCK", columns)
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(500, 7)) * [9, 7, 5, 3, 2, 1, 0.5]).tolist()
    compare(whiten.whiten(frame(spark, vectors).repartition(5)).collect(), vectors)


def test_left_out_and_padded(spark):
    rng = random.Random(2)
    vectors = [[rng.gauss(0, s) for s in (5, 3, 1)] for _ in range(50)]
    vectors[7], vectors[8] = vectors[7][:1], []
    out = [None, [1.0, None, 2.0], [float("nan"), 1.0, 1.0], [float("inf"), 1.0, 1.0]]
    whole = frame(spark, vectors + out)
    compare(whiten.whiten(whole).collect(), [(v + [0.0] * 3)[:3] for v in vectors])


def test_repeated_and_missing_ids(spark):
    rng = random.Random(4)
    vectors = [[rng.gauss(0, 4), rng.gauss(0, 2)] for _ in range(30)]
    rows = whiten.whiten(frame(spark, vectors, [None] * 10 + [3] * 10 + list(range(100, 110)))).collect()
    assert len(rows) == 60 and sum(r["vec_id"] is None for r in rows) == 20 and sum(r["vec_id"] == 3 for r in rows) == 20


def test_directions_without_variance(spark):
    flat = [[float(k), 2.0 * k, 1.0] for k in range(20)]  # one direction varies (up to rounding, floor is exact here)
    rows = whiten.whiten(frame(spark, flat)).collect()
    assert {r["component"] for r in rows} == {1} and len(rows) == 20 and abs(rows[0]["explained"] - 1) < 1e-9
    for vectors in ([[1.0, 2.0]], [[1.0, 2.0]] * 5, [[], []], [None]):
        assert whiten.whiten(frame(spark, vectors)).collect() == []
    assert whiten.whiten(frame(spark, flat).limit(0)).collect() == []


def test_huge_entries_stop(spark):
    vectors = [[1e300, float(k % 3)] for k in range(5)] + [[-1e300, 2.0]]
    rows = whiten.whiten(frame(spark, vectors)).collect()
    assert {r["deviation"] for r in rows} == {2**63 - 1} and all(r["identity_error"] < 1e-4 for r in rows)
