"""Whitening of embeddings with MLlib's BlockMatrix.

Rows are gathered in row blocks where they are read, so indexing them moves
nothing.  Centred blocks form a BlockMatrix C; C' C is the scatter.  Its
eigenvectors are taken on the driver (dimension by dimension numbers only), and
C times the whitening matrix projects all rows.

The driver holds two numbers for each block, as BlockMatrix products need, and
matrices of the dimension; never rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.llm.common import staged

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
BLOCK_VALUES = 1 << 18  # numbers in a block
MOST_COLUMNS = 1024  # columns of a block
BLOCKS_IN_TASK = 16
LARGEST = float(1 << 40)  # entries beyond have no exact place on the grid of longs
LEAST_SHARE = 1e-11  # of the largest variance; below, rounding alone breaks the identity

BLOCKS = "part long, number long, ids array<long>, x array<long>, sums array<long>"
GRID = T.StructType([
    T.StructField("_1", T.StructType([T.StructField(n, T.LongType(), False) for n in ("_1", "_2")]), False),
    T.StructField("_2", MatrixUDT(), False)])


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the rows whose vector is there, without null or non-finite entries, of the usual length.

    The usual length is the most frequent one, of equally frequent ones the
    longest; vectors of other lengths, and those with entries beyond 2 to the
    40, are left out.
    """
    entry = F.col("embedding").cast("array<double>")
    sound = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < LARGEST))
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), entry.alias("v"))
            .where(F.col("v").isNotNull()).where(sound))
    usual = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return rows.where(F.size("v") == F.lit(usual["width"] if usual else 0))


def _blocks(rows: DataFrame, width: int, height: int) -> DataFrame:
    """Blocks of at most ``height`` rows as whole numbers: place, ids, numbers row by row, sums of columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, ids, held = TaskContext.get().partitionId(), 0, [], []

        def made(ids: list, x: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "part": [part], "number": [number], "ids": [ids],
                "x": pa.array([x.ravel()], pa.list_(pa.int64())), "sums": [x.sum(axis=0)]})

        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            held.append(np.floor(values * SCALE).astype(np.int64) + SHIFT)
            ids += batch.column(0).to_pylist()
            while len(ids) >= height:
                x = np.concatenate(held)
                yield made(ids[:height], x[:height])
                number, ids, held = number + 1, ids[height:], [x[height:]]
        if ids:
            yield made(ids, np.concatenate(held))

    return rows.mapInArrow(run, BLOCKS)


def _grid_batch(row: int, columns: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    """Blocks (row, column) as MLlib stores dense matrices."""
    n = len(columns)
    place = pa.StructArray.from_arrays(
        [pa.array([row] * n, pa.int64()), pa.array([c for c, _ in columns], pa.int64())],
        fields=[pa.field("_1", pa.int64(), False), pa.field("_2", pa.int64(), False)])
    none = pa.nulls(n, pa.list_(pa.int32()))
    matrix = pa.StructArray.from_arrays(
        [pa.array([1] * n, pa.int8()), pa.array([m.shape[0] for _, m in columns], pa.int32()),
         pa.array([m.shape[1] for _, m in columns], pa.int32()), none, none,
         pa.array([m.ravel() for _, m in columns], pa.list_(pa.float64())), pa.array([True] * n)],
        names=["type", "numRows", "numCols", "colPtrs", "rowIndices", "values", "isTransposed"])
    return pa.RecordBatch.from_arrays([place, matrix], ["_1", "_2"])


def _values(matrices: pa.StructArray, i: int) -> np.ndarray:
    one = matrices[i].as_py()
    values = np.array(one["values"], np.float64)
    shape = (one["numRows"], one["numCols"])
    return values.reshape(shape) if one["isTransposed"] else values.reshape(shape[::-1]).T


def _centred(blocks: DataFrame, parts: int, mean: np.ndarray, height: int, wide: int) -> DataFrame:
    """The centred rows as (row, column) blocks; rows that a block lacks are zero and change no product."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, number = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                x = batch.column(2)[i].values.to_numpy().reshape(-1, len(mean))
                c = np.zeros((height, len(mean)))
                c[:len(x)] = x - mean
                yield _grid_batch(number * parts + part, [(k, np.ascontiguousarray(c[:, j:j + wide]))
                                                          for k, j in enumerate(range(0, len(mean), wide))])

    return blocks.select("part", "number", "x").mapInArrow(run, GRID)


def _product(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """a times b; ``splits`` deals the middle dimension out, which the Python method has no argument for."""
    model = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(model, a.rowsPerBlock, b.colsPerBlock)


def whitening_matrix(scatter: np.ndarray, n: int, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(matrix, share of the variance): eigenvectors over the root of their variance, by falling variance.

    The largest entry of each is positive.  Directions without variance, up to
    rounding, have no whitened form and are left out.
    """
    v = (scatter + scatter.T) / (2 * n)
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > max(LEAST_SHARE * values[-1], 0.0)] if len(values) else order
    values, vectors = values[order], vectors[:, order]
    top = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[top, np.arange(len(top))] < 0, -1.0, 1.0)
    return vectors / np.sqrt(values), values / np.trace(v)


PROJECTED = "ids array<long>, deviations array<long>, y array<double>"


def _with_ids(projected: BlockMatrix, blocks: DataFrame, parts: int, n: int, sums: list[int]) -> DataFrame:
    """Projected blocks beside the ids of their rows and the exact deviations."""
    width, total = len(sums), np.array(sums, np.int64)

    def deviate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x = batch.column(3)[i].values.to_numpy().reshape(-1, width)
                near = ((x - total / n) * float(n)) ** 2
                fits = near.sum(axis=1) < 9e18
                apart = n * x[fits] - total
                exact = np.zeros(len(x), np.int64)
                exact[fits] = (apart * apart).sum(axis=1)
                yield pa.RecordBatch.from_pydict({
                    "row": [batch.column(1)[i].as_py() * parts + batch.column(0)[i].as_py()],
                    "ids": [batch.column(2)[i].as_py()],
                    "deviations": pa.array([pa.array(exact, mask=~fits).to_pylist()], pa.list_(pa.int64()))})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column(0)[i].as_py()
                y = np.ascontiguousarray(_values(batch.column(2), i)[:len(ids)])
                yield pa.RecordBatch.from_pydict({
                    "ids": [ids], "deviations": batch.column(1).slice(i, 1),
                    "y": pa.array([y.ravel()], pa.list_(pa.float64()))})

    known = blocks.select("part", "number", "ids", "x").mapInArrow(
        deviate, "row long, ids array<long>, deviations array<long>")
    grid = callMLlibFunc("getMatrixBlocks", projected._java_matrix_wrapper._java_model)
    grid = grid.toDF("place", "matrix").select(F.col("place._1").cast("long").alias("row"), "matrix")
    return known.join(grid, "row").select("ids", "deviations", "matrix").mapInArrow(cut, PROJECTED)


def identity_error(projected: DataFrame, n: int, k: int) -> float:
    """The largest entry of the covariance of the whitened rows minus the identity."""

    def added(values_of) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for batch in batches:
                for i in range(batch.num_rows):
                    total = total + values_of(batch.column(0)[i].values.to_numpy().reshape(-1, k))
            if not np.isscalar(total):
                yield pa.RecordBatch.from_pydict({"total": [total.ravel()]})

        parts = projected.select("y").mapInArrow(run, "total array<double>")
        rows = (parts.select(F.posexplode("total").alias("at", "value")).groupBy("at")
                .agg(F.sum("value").alias("value")).collect())
        return np.array([r["value"] for r in sorted(rows, key=lambda r: r["at"])])

    mean = added(lambda y: y.sum(axis=0)) / n
    covariance = added(lambda y: (y - mean).T @ (y - mean)).reshape(k, k) / n
    return float(np.abs(covariance - np.eye(k)).max())


OUTPUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each usable row of ``vectors`` (vec_id, embedding) and component.

    Numbers are floor(64 * entry) + 1,000,000; every covariance is over all
    usable rows, centred first, divided by their number.  Repeated rows and
    rows without vec_id count and are returned like any other.  ``deviation``
    is exact, null where it exceeds a long.  Components without variance are
    left out, so equal rows or a single row give an empty result, as does an
    empty table.
    """
    spark = vectors.sparkSession
    nothing = spark.createDataFrame([], OUTPUT)
    rows = usable(vectors)
    first = rows.first()
    if first is None or not first["v"]:
        return nothing
    width = len(first["v"])
    height, wide = max(1, BLOCK_VALUES // width), min(width, MOST_COLUMNS)
    blocks = staged(_blocks(rows, width, height), "vectors")
    n, parts, last = blocks.agg(F.sum(F.size("ids")), F.max("part") + 1, F.max("number")).first()
    sums = [r["s"] for r in blocks.select(F.posexplode("sums").alias("at", "s")).groupBy("at")
            .agg(F.sum("s").alias("s")).orderBy("at").collect()]
    count = (last + 1) * parts

    def as_matrix(grid: DataFrame, rows_in: int, columns_in: int, columns: int) -> BlockMatrix:
        model = callMLlibFunc("createBlockMatrix", grid, rows_in, columns_in, count * height, columns)
        return BlockMatrix(model, rows_in, columns_in)

    centred = as_matrix(_centred(blocks, parts, np.array([s / n for s in sums]), height, wide), height, wide, width)
    scatter = _product(centred.transpose(), centred, -(-count // BLOCKS_IN_TASK)).toLocalMatrix().toArray()
    matrix, explained = whitening_matrix(scatter, n, components)
    k = len(explained)
    if not k:
        return nothing
    pieces = [((j, 0), DenseMatrix(len(m), k, m.ravel().tolist(), True))
              for j, m in enumerate(matrix[i:i + wide] for i in range(0, width, wide))]
    weights = BlockMatrix(spark.sparkContext.parallelize(pieces, 1), wide, k, width, k)
    projected = staged(_with_ids(centred.multiply(weights), blocks, parts, n, sums), "whitened")
    error = identity_error(projected, n, k)
    shares = pa.array(explained)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, deviations = batch.column(0)[i].values, batch.column(1)[i].values
                size = len(ids)
                own = np.repeat(np.arange(size), k)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(own), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                     pa.array(np.full(size * k, n)), deviations.take(own), batch.column(2)[i].values,
                     shares.take(np.tile(np.arange(k), size)), pa.array(np.full(size * k, error))],
                    [f.split()[0] for f in OUTPUT.split(", ")])

    return projected.mapInArrow(rows_of, OUTPUT)
