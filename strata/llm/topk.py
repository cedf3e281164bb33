"""Exact top-k inner products by pivot-table elimination.

Every vector stores its distances to a fixed number of pivots. For a query q and a vector x
the triangle inequality bounds their distance from below by max over pivots of
|d(q, p) - d(x, p)|, and with it the inner product (|q|^2 + |x|^2 - d^2) / 2 from above.
Vectors are evaluated in the order of that bound until the k-th best score found exceeds
the next bound, so the result is exact whatever the pivots are.

Vectors and queries are packed into blocks of fixed size; every block of vectors meets
every block of the stated query set, each pair of blocks in a task of its own.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored

PIVOTS = 16
#: Vectors that the pivots are picked from (by hashed id); the pivots only decide how much is eliminated.
PIVOT_SAMPLE = 1024
VECTORS_A_BLOCK, QUERIES_A_BLOCK = 4096, 512
#: Vectors of a cell, which are evaluated together.
CELL = 256

#: A vector takes part if it is not null and all its components are finite numbers.
def takes_part(embedding: Column) -> Column:
    return embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _matrix(rows: list[list[float]], width: int | None = None) -> np.ndarray:
    """Rows of floor(64 * x); shorter ones are padded with zeros, which add nothing to a product."""
    width = max([0, *map(len, rows)]) if width is None else width
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : len(r)] = np.floor(64.0 * np.asarray(r, dtype=np.float64))
    return out


def pivots_of(sample: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Far-apart rows: each next pivot is the row farthest from those picked so far."""
    if not len(sample):
        return sample
    picked = [int(np.argmax((sample**2).sum(axis=1)))]
    near = ((sample - sample[picked[0]]) ** 2).sum(axis=1)
    while len(picked) < min(count, len(sample)) and near.max() > 0:
        picked.append(int(np.argmax(near)))
        near = np.minimum(near, ((sample - sample[picked[-1]]) ** 2).sum(axis=1))
    return sample[picked]


def _pad(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] == width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    if not len(pivots):
        return np.zeros((len(vectors), 1))
    width = max(vectors.shape[1], pivots.shape[1])
    vectors, pivots = _pad(vectors, width), _pad(pivots, width)
    return np.sqrt(np.stack([((vectors - p) ** 2).sum(axis=1) for p in pivots], axis=1))


def _exact(scores_of: np.ndarray, query: np.ndarray, safe: bool) -> np.ndarray:
    if safe:
        return scores_of @ query
    whole = [[int(x) for x in r] for r in scores_of]  # beyond what doubles hold exactly
    q = [int(x) for x in query]
    return np.array([sum(a * b for a, b in zip(r, q, strict=True)) for r in whole], dtype=object)


def best(query: np.ndarray, own: np.ndarray, vectors: np.ndarray, ids: np.ndarray, bounds: np.ndarray, k: int, safe: bool) -> tuple[np.ndarray, np.ndarray]:
    """ids and scores of the k best vectors (ties to the smaller id) but the query's ``own`` row, evaluated in the order of the bounds."""
    order = np.argsort(-bounds, kind="stable")
    order = order[~own[order]]
    found, got, at, step = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=float if safe else object), 0, 4 * k
    while at < len(order):
        if len(got) >= k and bounds[order[at]] < got[k - 1]:
            break
        take = order[at : at + step]
        at, step = at + len(take), step * 2
        found, got = np.r_[found, ids[take]], np.r_[got, _exact(vectors[take], query, safe)]
        keep = np.lexsort((found, -got))[:k] if safe else np.array(sorted(range(len(got)), key=lambda i: (-got[i], found[i]))[:k])
        found, got = found[keep], got[keep]
    return found, got


def block_best(
    queries: np.ndarray, query_rows: np.ndarray, vectors: np.ndarray, ids: np.ndarray, rows_of: np.ndarray, near: np.ndarray, q_near: np.ndarray, k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """The k best (ids, scores) of each query among the vectors; products must be exact in the arrays' type.

    Vectors lie in cells by their nearest pivot; a cell's bound for a query is the best
    bound of its vectors. Each query evaluates its best cell first; the other cells follow
    by their bounds, each for the queries whose k-th score does not exceed it.
    """
    order = np.argsort(near.argmin(axis=1), kind="stable")
    vectors, ids, rows_of, near = vectors[order], ids[order], rows_of[order], near[order]
    norms, q_norms = [(x.astype(np.float64) ** 2).sum(axis=1).astype(np.float32) for x in (vectors, queries)]
    near, q_near = near.astype(np.float32), q_near.astype(np.float32)
    edges = np.arange(0, len(vectors), CELL)
    best_of = np.empty((len(queries), len(edges)), dtype=np.float32)
    for c, at in enumerate(edges):
        part = slice(at, at + CELL)
        least, gap = np.zeros((len(queries), len(ids[part])), dtype=np.float32), None
        for p in range(near.shape[1]):
            gap = np.subtract(q_near[:, p : p + 1], near[None, part, p], out=gap)
            np.maximum(least, np.abs(gap, out=gap), out=least)
        # distances above d are above d less their rounding; so are the squares
        room = 1e-5 * (norms[part].max() + q_norms.max())
        best_of[:, c] = ((norms[None, part] + q_norms[:, None] - least**2).max(axis=1)) / 2 + 1 + room
    top = np.full((len(queries), k), -np.inf, dtype=scores_type(queries))
    hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def evaluate(cell: int, rows: np.ndarray) -> None:
        part = slice(edges[cell], edges[cell] + CELL)
        scores = queries[rows] @ vectors[part].T
        scores[query_rows[rows, None] == rows_of[None, part]] = -np.inf
        i, j = np.nonzero((scores >= top[rows, :1]) & (scores > -np.inf))  # the first of the top scores is the k-th best
        if len(i):
            hits.append((rows[i], ids[part][j], scores[i, j]))
            changed = np.unique(i)
            both = np.concatenate([top[rows[changed]], scores[changed]], axis=1)
            top[rows[changed]] = np.sort(np.partition(both, both.shape[1] - k, axis=1)[:, -k:], axis=1)

    first = best_of.argmax(axis=1)
    for cell in np.unique(first):
        evaluate(int(cell), np.flatnonzero(first == cell))
    for cell in np.argsort(-best_of.max(axis=0), kind="stable"):
        rows = np.flatnonzero((best_of[:, cell] >= top[:, 0]) & (first != cell))
        if len(rows):
            evaluate(int(cell), rows)
    if not hits:
        return [(np.zeros(0, dtype=np.int64), np.zeros(0))] * len(queries)
    q, found, got = (np.concatenate(x) for x in zip(*hits, strict=True))
    still = got >= top[q, 0]
    q, found, got = q[still], found[still], got[still]
    order = np.lexsort((found, -got, q))
    q, found, got = q[order], found[order], got[order]
    begin = np.searchsorted(q, np.arange(len(queries) + 1))
    return [(found[a : min(b, a + k)], got[a : min(b, a + k)]) for a, b in zip(begin[:-1], begin[1:], strict=True)]


def scores_type(queries: np.ndarray) -> np.dtype:
    return np.result_type(queries, np.float32)


#: The narrowest type that holds a block's entries exactly is the one that is shuffled.
TYPES = (np.int8, np.int16, np.int32, np.float64)


def _pack(key, table: pa.Table, pivots: np.ndarray) -> pa.Table:
    """One row a block: rows, ids, vectors and their pivot distances as arrays of bytes."""
    vectors = _matrix(table.column("embedding").to_pylist())
    kind = next(t for t in TYPES if t is np.float64 or np.abs(vectors).max(initial=0) <= np.iinfo(t).max)
    return pa.table({
        "block": pa.array([key[0].as_py()], pa.int32()), "width": pa.array([vectors.shape[1]], pa.int32()), "kind": pa.array([np.dtype(kind).str]),
        "rows": pa.array([table.column("row").to_numpy().astype(np.int64).tobytes()], pa.binary()),
        "ids": pa.array([table.column("vec_id").to_numpy().astype(np.int64).tobytes()], pa.binary()),
        "vectors": pa.array([vectors.astype(kind).tobytes()], pa.binary()),
        "distances": pa.array([_distances(vectors, pivots).astype(np.float64 if kind is np.float64 else np.float32).tobytes()], pa.binary()),
    })


BLOCK = "block int, width int, kind string, rows binary, ids binary, vectors binary, distances binary"


def _meet(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    longs = lambda b: np.frombuffer(b, dtype=np.int64)
    floats = lambda b, kind: np.frombuffer(b, dtype=np.float64 if np.dtype(kind) == np.float64 else np.float32)
    for batch in batches:
        for r in batch.to_pylist():
            ids, rows, query_ids, query_rows = (longs(r[c]) for c in ("ids", "rows", "q_ids", "q_rows"))
            vectors = np.frombuffer(r["vectors"], dtype=r["kind"]).reshape(len(ids), r["width"]).astype(np.float64)
            queries = np.frombuffer(r["q_vectors"], dtype=r["q_kind"]).reshape(len(query_ids), r["q_width"]).astype(np.float64)
            width = max(r["width"], r["q_width"])
            vectors, queries = _pad(vectors, width), _pad(queries, width)
            top = max(np.abs(vectors).max(initial=0), np.abs(queries).max(initial=0))
            safe = width * top * top < 2.0**53
            if safe and width * top * top < 2.0**24:
                vectors, queries = vectors.astype(np.float32), queries.astype(np.float32)
            near = floats(r["distances"], r["kind"]).reshape(len(ids), -1)
            q_near = floats(r["q_distances"], r["q_kind"]).reshape(len(query_ids), -1)
            if safe:
                best_found = block_best(queries, query_rows, vectors, ids, rows, near, q_near, k)
            else:  # one by one in whole numbers
                norms, q_norms = (vectors**2).sum(axis=1), (queries**2).sum(axis=1)
                slack = 1e-9 if near.dtype == q_near.dtype == np.float64 else 1e-5
                room = 1 + slack * norms
                bounds = [(norms + q_norms[i] - np.abs(near - q_near[i]).max(axis=1) ** 2) / 2 + room + slack * q_norms[i] for i in range(len(queries))]
                best_found = [best(q, rows == query_rows[i], vectors, ids, bounds[i], k, False) for i, q in enumerate(queries)]
            out = []
            for i, (found, scores) in enumerate(best_found):
                out.append((np.full(len(found), query_rows[i]), np.full(len(found), query_ids[i]), found, [min(max(int(s), -(2**63)), 2**63 - 1) for s in scores]))
            if out:
                yield pa.RecordBatch.from_arrays([
                    *[pa.array(np.concatenate([x[c] for x in out]), pa.int64()) for c in range(3)], pa.array([s for x in out for s in x[3]], pa.int64()),
                ], names=["query", "query_id", "vec_id", "score"])


def top_k(embeddings: DataFrame, queries: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of floor(64 x) of each query row.

    ``queries`` is a condition on vec_id; candidates are all rows but the query's own. Null
    vectors and vectors with null or non-finite components take no part, nor do rows without
    vec_id. Rows that repeat an id are rows of their own: as candidates each counts, and
    as queries each gets its ranks. Ties go to the smaller vec_id; fewer candidates than k
    are all returned. Shorter vectors count as padded with zeros. Scores beyond 64 bits stop
    at the ends of the range.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & takes_part(F.col("embedding"))).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "topk-vectors")
    count, asked = rows.agg(F.count(F.lit(1)), F.count(F.when(queries, 1))).first()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).select("embedding").collect()  # bounded
    pivots = pivots_of(_matrix([r["embedding"] for r in sample]))
    pack = functools.partial(_pack, pivots=pivots)
    blocks, q_blocks = max(1, -(-count // VECTORS_A_BLOCK)), max(1, -(-asked // QUERIES_A_BLOCK))
    deal = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    vectors = rows.groupBy(deal(blocks).alias("block")).applyInArrow(lambda key, t: pack(key, t), BLOCK)
    asked_for = rows.where(queries).groupBy(deal(q_blocks).alias("block")).applyInArrow(lambda key, t: pack(key, t), BLOCK)
    asked_for = asked_for.select("block", *[F.col(c).alias(f"q_{c}") for c in ("width", "kind", "rows", "ids", "vectors", "distances")])
    each = vectors.withColumn("at", F.col("block")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    pairs = each.join(asked_for, "block").drop("at", "block")
    pairs = pairs.repartition(blocks * q_blocks, F.xxhash64("rows", "q_rows"))
    met = pairs.mapInArrow(functools.partial(_meet, k=k), "query long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


OP7_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_sum([q.e[i] * c.e[i] FOR i IN generate_series(1, len(q.e))]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.r <> c.r)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""
