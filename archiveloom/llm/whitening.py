"""Embedding whitening (13) with distributed block matrices of Spark's MLlib.

Vectors become whole numbers ``x = floor(scale * c) + shift``, and whole blocks of rows in the
tasks that read them; blocks get dense numbers, rows their place in a block. Centred rows
``x - S / n`` are blocks of a ``BlockMatrix``; transpose-multiply gives their scatter, a local
``eigh`` its eigenvectors, and multiplying the centred rows by the whitening matrix (eigenvectors
over the roots of their eigenvalues) projects all rows.

MLlib multiplies all blocks that meet in one block of the result in one task, and the scatter of
the plain matrix is one such block. So the left and the right factor have their row blocks set off
into ``q`` groups of columns each, by different digits of the block number: the product then
has ``q * q`` blocks, each the scatter of its own part of the rows, computed in tasks of their own
and summed as a tree.

On the driver: the sums, the scatter and its eigenvectors, that is the square of the number of
dimensions, and MLlib's list of block numbers, two numbers per ``BLOCK_BYTES`` of rows.

Defined results: rows whose vector is NULL or holds a NULL, a NaN, an infinity or an entry that
fits no 64-bit number are left out; the dimension is the commonest length of the vectors that
remain (of several, the largest; never 0), other lengths are left out; repeated rows and ids, NULL
ids too, are rows like any other; tied eigenvalues have any basis of their space, the same for all rows;
directions without variance (an eigenvalue below ``FLAT`` of the largest) cannot be
whitened and give no component; without rows or variance the result is empty; ``deviation`` is
NULL where it fits no 64-bit number; other columns of the input, whatever their names, are never
looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from archiveloom.llm import packing as pk
from archiveloom.staging import StagingArea

SCALE, SHIFT = 1024.0, 100_000
BLOCK_BYTES = 1 << 20  # of a block of centred rows
PART_BLOCKS, MOST_GROUPS = 8, 64  # row blocks in a part of the scatter, at least; column groups, at most
FLAT = 1e-12
LARGEST = 2.0**62  # of a scaled entry

_BLOCK = T.StructType([
    T.StructField("_1", T.StructType([T.StructField("_1", T.LongType()), T.StructField("_2", T.LongType())])),
    T.StructField("_2", MatrixUDT()),
])


def _scaled(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are usable, and those as rows of whole numbers."""
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    usable = np.flatnonzero(sizes == dim)
    flat = pc.list_flatten(column.take(pa.array(usable))).cast(pa.float64())
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(SCALE * flat.fill_null(np.nan).to_numpy(zero_copy_only=False)).reshape(-1, dim)
        fine = (np.abs(x) < LARGEST).all(axis=1)  # false for NaN too
    return usable[fine], x[fine].astype(np.int64) + SHIFT


def _lengths(vector: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(vector)
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes[sizes > 0]).tolist():
                usable, _ = _scaled(column, dim)
                yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int64()), pa.array([len(usable)], pa.int64())], ["dim", "n"])

    return count


def dimension(vectors: DataFrame, vector: str = "embedding") -> int:
    """The commonest length of the usable vectors, 0 if there are none."""
    found = vectors.select(vector).mapInArrow(_lengths(vector), "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n"))
    top = found.where("n > 0").orderBy(F.desc("n"), F.desc("dim")).first()
    return top["dim"] if top else 0


def _indexer(id: str, vector: str, dim: int, rows: int, schema: pa.Schema):
    """Blocks of ``rows`` usable vectors of a task, numbered by partition and turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, turn = TaskContext.get().partitionId(), 0
        held: list[tuple[pa.Array, np.ndarray]] = []

        def block(ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
            own = [[part], [turn], [len(x)], [ids.to_pylist()], [x.tobytes()], [x.sum(axis=0).tolist()]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(own, schema)], schema=schema)

        def joined() -> tuple[pa.Array, np.ndarray]:
            return pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held])

        for batch in batches:
            usable, x = _scaled(batch.column(vector), dim)
            held.append((batch.column(id).take(pa.array(usable)), x))
            if sum(len(h[1]) for h in held) < rows:
                continue
            ids, x = joined()
            full = len(x) - len(x) % rows
            for at in range(0, full, rows):
                yield block(ids[at : at + rows], x[at : at + rows])
                turn += 1
            held = [(ids[full:], x[full:])]
        if held and sum(len(h[1]) for h in held):
            yield block(*joined())

    return run


def _rows_of(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
    """(block number, whole-number rows, ids) of every block."""
    for i, k in enumerate(batch.column("k").to_pylist()):
        yield k, np.frombuffer(batch.column("x")[i].as_buffer(), np.int64).reshape(-1, dim), batch.column("ids")[i].values


def _centred(dim: int, rows: int, mean: np.ndarray, group, schema: pa.Schema):
    """Matrix blocks of centred rows, filled up with rows of zeros; ``group`` gives the column block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, x, _ in _rows_of(batch, dim):
                y = np.zeros((rows, dim))
                y[: len(x)] = x - mean
                place = {"_1": k, "_2": group(k)}
                values = pa.ListArray.from_arrays(pa.array([0, y.size], pa.int32()), pa.array(y.reshape(-1)))
                of = schema.field("_2").type
                parts = {
                    "type": [1], "numRows": [rows], "numCols": [dim], "colPtrs": [None], "rowIndices": [None], "values": values,
                    "isTransposed": [True],  # rows one after another
                }
                columns = [parts[f.name] if f.name == "values" else pa.array(parts[f.name], f.type) for f in of]
                matrix = pa.StructArray.from_arrays(columns, fields=[pa.field(f.name, c.type) for f, c in zip(of, columns)])
                yield pa.RecordBatch.from_arrays([pa.array([place], schema.field("_1").type), matrix], ["_1", "_2"])

    return run


def _deviations(dim: int, n: int, sums: list[int], schema: pa.Schema):
    """Per block the ids and each row's squared distance from the mean, times n squared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, x, ids in _rows_of(batch, dim):
                near = np.square(n * x.astype(float) - np.array(sums, float)).sum(axis=1)
                fits = near < 9.2e18  # the sum below is exact then; 9.22e18 is the largest number
                with np.errstate(over="ignore"):
                    exact = np.square(np.int64(n) * x - np.array(sums, np.int64)).sum(axis=1)
                found = [[k], [ids.to_pylist()], [[int(v) if f else None for v, f in zip(exact, fits)]]]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(found, schema)], schema=schema)

    return run


def _summed(dim: int):
    """One row per entry of the sum of a task's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim * dim)
        for batch in batches:
            total += pc.list_flatten(batch.column(1).field("values")).to_numpy().reshape(-1, dim * dim).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "v"])

    return run


def _unpacked(rows: int, schema: pa.Schema):
    """(id, deviation, projections) of every row, from ids, deviations and projected blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("ids")[i].values
                w = batch.column("w")[i].values.to_numpy().reshape(-1, rows)[:, : len(ids)].T
                at = pa.array(np.arange(len(ids) + 1) * w.shape[1], pa.int32())
                columns = [ids, batch.column("deviations")[i].values, pa.ListArray.from_arrays(at, pa.array(np.ascontiguousarray(w).reshape(-1)))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _matrix(blocks: DataFrame, rows: int, cols: int, n_rows: int, n_cols: int) -> BlockMatrix:
    """A block matrix of a DataFrame of blocks, which never become Python rows."""
    return BlockMatrix(callMLlibFunc("createBlockMatrix", blocks, rows, cols, n_rows, n_cols), rows, cols)


def _blocks(matrix: BlockMatrix) -> DataFrame:
    return callMLlibFunc("getMatrixBlocks", matrix._java_matrix_wrapper._java_model)


def whitened(
    vectors: DataFrame, components: int = 8, id: str = "vec_id", vector: str = "embedding", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row per vector and component.

    ``deviation`` is the sum over dimensions of ``(n * x - S) ** 2``, ``explained`` the component's
    share of the variance, ``identity_error`` the largest absolute entry of the covariance of
    all ``whitened`` minus the identity.
    """
    spark = vectors.sparkSession
    pk.small_batches(spark)
    staging = StagingArea(spark, "whitening")
    rows = vectors.select(F.col(id).alias("id"), F.col(vector).alias("vector"))
    id_type = rows.schema["id"].dataType
    out = T.StructType([
        T.StructField(id, id_type), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
    ])
    dim = dimension(rows, "vector")
    if not dim:
        return spark.createDataFrame([], out)

    size = max(1, block_bytes // (8 * dim))  # rows of a block
    schema = T.StructType([
        T.StructField("part", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("rows", T.LongType()),
        T.StructField("ids", T.ArrayType(id_type)), T.StructField("x", T.BinaryType()), T.StructField("sums", T.ArrayType(T.LongType())),
    ])
    blocks, seen = staging.write(
        rows.mapInArrow(_indexer("id", "vector", dim, size, to_arrow_schema(schema)), schema), "blocks",
        n=F.sum("rows"), blocks=F.count(F.lit(1)),
    )
    n, n_blocks = seen["n"], seen["blocks"]
    by_place = blocks.select(F.posexplode("sums").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
    sums = [r["v"] for r in sorted(by_place, key=lambda r: r["at"])]
    mean = np.array(sums) / n
    offsets, total = [], 0  # one row per partition
    for row in sorted(blocks.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["part"]):
        offsets.append((row["part"], total))
        total += row["n"]
    numbers = F.broadcast(spark.createDataFrame(offsets, "part long, first long"))
    numbered = blocks.join(numbers, "part").select((F.col("first") + F.col("turn")).alias("k"), "ids", "x")
    arrow = to_arrow_schema(_BLOCK)

    def factor(group, groups: int) -> BlockMatrix:
        centred = numbered.mapInArrow(_centred(dim, size, mean, group, arrow), _BLOCK)
        return _matrix(centred, size, dim, n_blocks * size, groups * dim)

    q = min(max(1, math.isqrt(n_blocks // PART_BLOCKS)), MOST_GROUPS)
    parts = factor(lambda k: k // q % q, q).transpose().multiply(factor(lambda k: k % q, q))
    entries = _blocks(parts).mapInArrow(_summed(dim), "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    scatter = np.zeros(dim * dim)
    for row in entries:
        scatter[row["at"]] = row["v"]
    covariance = scatter.reshape(dim, dim) / n
    values, directions = np.linalg.eigh((covariance + covariance.T) / 2)
    values, directions = values[::-1], directions[:, ::-1]
    m = min(components, int((values > FLAT * values[0]).sum())) if values[0] > 0 else 0
    if not m:
        return spark.createDataFrame([], out)

    whitening = directions[:, :m] / np.sqrt(values[:m])
    only = spark.sparkContext.parallelize([((0, 0), Matrices.dense(dim, m, whitening.reshape(-1, order="F")))], 1)
    projected = _blocks(factor(lambda k: 0, 1).multiply(BlockMatrix(only, dim, m)))
    w = projected.select(F.col("_1._1").cast("long").alias("k"), F.col("_2").alias("matrix")).mapInArrow(_values, "k long, w array<double>")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("ids", T.ArrayType(id_type)), T.StructField("deviations", T.ArrayType(T.LongType()))])
    named = numbered.mapInArrow(_deviations(dim, n, sums, to_arrow_schema(schema)), schema)
    schema = T.StructType([T.StructField("id", id_type), T.StructField("deviation", T.LongType()), T.StructField("w", T.ArrayType(T.DoubleType()))])
    found = named.join(w, "k").mapInArrow(_unpacked(size, to_arrow_schema(schema)), schema)
    entry = lambda i: F.col("w")[i]
    pairs = [(i, j) for i in range(m) for j in range(i, m)]
    found, spread = staging.write(found, "projected", **{f"c{i}_{j}": F.covar_pop(entry(i), entry(j)) for i, j in pairs})
    error = max(abs(spread[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    share = F.array(*[F.lit(float(v)) for v in values[:m] / np.trace(covariance)])
    return found.select("id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        F.col("id").alias(id), (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", share[F.col("at")].alias("explained"), F.lit(float(error)).alias("identity_error"),
    )


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block numbers and the numbers of the blocks."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("matrix").field("values")], ["k", "w"])
