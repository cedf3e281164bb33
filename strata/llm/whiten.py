"""Embedding whitening with MLlib block matrices.

Vectors are packed where they are read, without a shuffle, into numbered blocks of rows.
Centred rows become the blocks of a ``BlockMatrix`` M; M' M, with the row dimension split
over the tasks, is the scatter matrix. Its eigenvectors are found locally (dimensions
squared numbers, whatever the number of rows), and M times the whitening matrix projects
the rows. What the driver holds: the scatter matrix, and inside ``multiply`` the
coordinates of the blocks (two numbers for each ``ENTRIES`` entries).
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import stored

#: Entries of a block of rows, about; columns of a block at most.
ENTRIES, COLUMNS_A_BLOCK = 1 << 16, 1024
#: Row blocks of one product task.
BLOCKS_A_TASK = 8
#: Scaled entries beyond this stop at it, so that sums over a block stay exact in 64 bits.
LARGEST = float(1 << 40)
#: Directions with less than this share of the largest variance have none but for rounding.
NO_VARIANCE = 1e-12

PACKED = "part int, at int, n int, width int, ids array<long>, x array<long>, sums array<long>"
MATRIX = T.StructType([
    T.StructField("blockIndex", T.StructType([T.StructField("_1", T.LongType(), False), T.StructField("_2", T.LongType(), False)]), False),
    T.StructField("subMatrix", MatrixUDT(), False),
])


def takes_part(embedding: Column) -> Column:
    """Not null, and every entry a finite number."""
    return embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _list(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, values.size], pa.int32()), pa.array(np.ascontiguousarray(values).ravel(), kind))


def _pack(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """Blocks of floor(scale * c), one row each, numbered within the task; shorter vectors count as padded with zeros."""
    part, at, held, ids, entries = TaskContext.get().partitionId(), 0, [], [], 0

    def block() -> pa.RecordBatch:
        width = max(map(len, held))
        x = np.zeros((len(held), width), dtype=np.int64)
        for i, r in enumerate(held):
            x[i, : len(r)] = r
        return pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([at], pa.int32()), pa.array([len(held)], pa.int32()), pa.array([width], pa.int32()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids, pa.int64())),
            _list(x, pa.int64()), _list(x.sum(axis=0), pa.int64()),
        ], names=[f.split()[0] for f in PACKED.split(", ")])

    for batch in batches:
        vectors = batch.column("embedding")
        edges, values = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
        scaled = np.clip(np.floor(scale * values), -LARGEST, LARGEST).astype(np.int64)
        for i, vec_id in enumerate(batch.column("vec_id").to_pylist()):
            held.append(scaled[edges[i] : edges[i + 1]])
            ids.append(vec_id)
            entries += max(1, len(held[-1]))
            if entries >= ENTRIES:
                yield block()
                at, held, ids, entries = at + 1, [], [], 0
    if held:
        yield block()


def packed(rows: DataFrame, scale: float) -> DataFrame:
    """Stored blocks (block: its number in the table, n, width, ids, x, sums) of rows (vec_id, embedding)."""
    blocks = stored(rows.mapInArrow(functools.partial(_pack, scale=scale), PACKED), "whiten-rows")
    before = F.sum("blocks").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = blocks.groupBy("part").agg(F.count(F.lit(1)).alias("blocks"))  # a row a task
    return blocks.join(parts.select("part", F.coalesce(before, F.lit(0)).alias("before")), "part").withColumn("block", F.col("before") + F.col("at"))


def _sub_matrix(m: np.ndarray) -> pa.Array:
    none = pa.nulls(1, pa.list_(pa.int32()))
    return pa.StructArray.from_arrays(
        [pa.array([1], pa.int8()), pa.array([m.shape[0]], pa.int32()), pa.array([m.shape[1]], pa.int32()), none, none, _list(m.ravel(order="F"), pa.float64()), pa.array([False])],
        names=["type", "numRows", "numCols", "colPtrs", "rowIndices", "values", "isTransposed"],
    )


def _matrix(r: dict, width: int) -> np.ndarray:
    x = np.asarray(r["x"]).reshape(r["n"], r["width"])
    return x if r["width"] == width else np.pad(x, ((0, 0), (0, width - r["width"])))


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of batches one by one, lists as arrays: a block is large, a list of Python numbers many times larger."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {}
            for name, column in zip(batch.schema.names, batch.columns, strict=True):
                value = column[i]
                row[name] = value.values.to_numpy(zero_copy_only=False) if isinstance(value, pa.ListScalar) and name in ("x", "projected") else value.as_py()
            yield row


def _centred(batches: Iterator[pa.RecordBatch], mean: np.ndarray) -> Iterator[pa.RecordBatch]:
    for r in _rows_of(batches):
        m = _matrix(r, len(mean)) - mean
        for j in range(0, len(mean), COLUMNS_A_BLOCK):
            at = pa.StructArray.from_arrays([pa.array([r["block"]], pa.int64()), pa.array([j // COLUMNS_A_BLOCK], pa.int64())], names=["_1", "_2"])
            yield pa.RecordBatch.from_arrays([at, _sub_matrix(m[:, j : j + COLUMNS_A_BLOCK])], names=["blockIndex", "subMatrix"])


def centred_matrix(blocks: DataFrame, count: int, rows_a_block: int, mean: np.ndarray) -> BlockMatrix:
    """The rows less ``mean`` as a block matrix; a block of rows may hold fewer than ``rows_a_block``."""
    frame = blocks.select("block", "n", "width", "x").mapInArrow(functools.partial(_centred, mean=mean), MATRIX)
    wide = min(COLUMNS_A_BLOCK, len(mean))
    return BlockMatrix(callMLlibFunc("createBlockMatrix", frame, rows_a_block, wide, rows_a_block * count, len(mean)), rows_a_block, wide)


def scatter(matrix: BlockMatrix, count: int) -> np.ndarray:
    """M' M. Without a split of the row dimension one task would read every row for a block of the result."""
    splits = max(1, -(-count // BLOCKS_A_TASK))
    turned = matrix.transpose()
    made = turned._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    whole = BlockMatrix(made, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()
    return (whole + whole.T) / 2


def _projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a product as rows (block, n, width, x by row, sums)."""
    for batch in batches:
        index, sub = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            n, width = sub.field("numRows")[i].as_py(), sub.field("numCols")[i].as_py()
            values = sub.field("values")[i].values.to_numpy()
            m = values.reshape(n, width) if sub.field("isTransposed")[i].as_py() else values.reshape(width, n).T
            yield pa.RecordBatch.from_arrays([
                pa.array([index.field(0)[i].as_py()], pa.int64()), pa.array([n], pa.int32()), pa.array([width], pa.int32()), _list(m, pa.float64()), _list(m.sum(axis=0), pa.float64()),
            ], names=["block", "n", "width", "x", "sums"])


def product(spark: SparkSession, matrix: BlockMatrix, by: np.ndarray, name: str) -> DataFrame:
    """Stored blocks (block, n, width, x, sums) of M times a local matrix."""
    high = matrix.colsPerBlock
    parts = [by[j : j + high] for j in range(0, len(by), high)]
    plain = T.StructType([MATRIX["blockIndex"], T.StructField("subMatrix", MatrixUDT.sqlType(), False)])
    data = [((j, 0), (1, *m.shape, None, None, m.ravel(order="F").tolist(), False)) for j, m in enumerate(parts)]
    local = spark.createDataFrame(data, plain).mapInArrow(lambda batches: batches, MATRIX)  # the same, as matrices
    other = callMLlibFunc("createBlockMatrix", local, high, by.shape[1], len(by), by.shape[1])
    made = matrix._java_matrix_wrapper.call("multiply", other)
    return stored(callMLlibFunc("getMatrixBlocks", made).mapInArrow(_projected, "block long, n int, width int, x array<double>, sums array<double>"), name)


def _sums(blocks: DataFrame, kind: str) -> list:
    """Sums by dimension over all blocks: a number a dimension reaches the driver."""
    each = blocks.select(F.posexplode("sums").alias("at", "value")).groupBy("at").agg(F.sum(F.col("value").cast(kind)).alias("value"))
    return [r["value"] for r in each.orderBy("at").collect()]


def _report(batches: Iterator[pa.RecordBatch], count: int, sums: list[int], explained: np.ndarray, error: float) -> Iterator[pa.RecordBatch]:
    parts, most = len(explained), 2**63 - 1
    for r in _rows_of(batches):
        x = _matrix(r, len(sums))
        reach = max(int(np.abs(x).max(initial=0)) * count, max(map(abs, sums), default=0))
        if 4 * reach * reach * max(1, len(sums)) < most:
            far = ((count * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1)
        else:  # beyond 64 bits in between
            far = np.array([min(sum((count * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)), most) for row in x], dtype=np.int64)
        yield pa.RecordBatch.from_arrays([
            pa.array([i for i in r["ids"] for _ in range(parts)], pa.int64()), pa.array(np.tile(np.arange(1, parts + 1, dtype=np.int32), r["n"])),
            pa.array(np.full(r["n"] * parts, count, dtype=np.int64)), pa.array(np.repeat(far, parts)), pa.array(r["projected"], pa.float64()),
            pa.array(np.tile(explained, r["n"])), pa.array(np.full(r["n"] * parts, error)),
        ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


REPORT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, components: int = 8, scale: float = 1024.0) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: rows on the leading principal axes, scaled to variance one.

    Every entry c counts as floor(scale * c), as a whole number (a constant added to all of them,
    as in x = floor(1024 c) + 100000, changes no result). Rows whose vector is null or holds
    null or non-finite entries are left out; rows that repeat an id, or have none, are rows
    of their own. Shorter vectors count as padded with zeros. Scaled entries stop at 2^40,
    and ``deviation`` (the sum over dimensions of (n x - S)^2) at the largest long. Axes
    without variance cannot be scaled to one and give no rows: one vector, or equal vectors
    only, give an empty result, as does an empty table. Reads vec_id and embedding; the
    order of rows does not matter, rounding aside. ``identity_error`` is the largest
    distance of an entry of the whitened rows' covariance from the identity.
    """
    spark = embeddings.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    blocks = packed(rows.where(takes_part(F.col("embedding"))), scale)
    count, n, width, high = blocks.agg(F.count(F.lit(1)), F.sum("n"), F.max("width"), F.max("n")).first()
    nothing = spark.createDataFrame([], REPORT)
    if not n or not width:
        return nothing
    sums = [int(s) for s in _sums(blocks, "decimal(38,0)")]
    matrix = centred_matrix(blocks, count, high, np.array([s / n for s in sums]))
    variance, axes = np.linalg.eigh(scatter(matrix, count) / n)
    variance, axes = variance[::-1], axes[:, ::-1]
    kept = min(components, int((variance > NO_VARIANCE * max(variance[0], 0)).sum()))
    if not kept:
        return nothing
    projected = product(spark, matrix, axes[:, :kept] / np.sqrt(variance[:kept]), "whitened")
    means = np.array(_sums(projected, "double")) / n
    identity = scatter(centred_matrix(projected, count, high, means), count) / n
    error = float(np.abs(identity - np.eye(kept)).max())
    both = blocks.join(projected.select("block", F.col("x").alias("projected")), "block").select("n", "width", "ids", "x", "projected")
    return both.mapInArrow(functools.partial(_report, count=n, sums=sums, explained=variance[:kept] / variance.sum(), error=error), REPORT)
