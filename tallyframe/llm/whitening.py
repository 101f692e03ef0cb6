"""Whitening of embeddings with distributed block matrices.

Entries become whole numbers, so that sums and deviations are exact. Every different vector is
once in the fit list. Its rows, centred, are numbered without gaps and put into an MLlib
BlockMatrix; the block matrix multiplied by its transpose gives the scatter matrix, whose
eigenvectors are found on the driver (a table of dimension by dimension). All rows, centred and
numbered the same way, are then projected by one more BlockMatrix multiplication.

Products sum over the rows of the table, so their blocks are dealt to many tasks (the
``numMidDimSplits`` of MLlib's multiply) and only sums of one block each meet. The driver gets
sums per dimension, row counts of partitions, ids of blocks (two integers for each
``BLOCK_BYTES``) and matrices of dimension by dimension.
"""

from __future__ import annotations

import numpy as np
from pyspark import SparkContext, StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import stage

STEPS_PER_UNIT = 64
OFFSET = 1_000_000
COMPONENTS = 16
BLOCK_BYTES = 2_000_000
BLOCKS_A_TASK = 4
#: Eigenvalues below this share of the largest one are rounding errors of a zero.
LEAST_SHARE = 1e-11
#: Whole numbers beyond this aren't exact as double.
EXACT = 2**53

RESULT_DDL = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def usable_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, x): entries c as the long floor(64 c) + 1000000.

    Vectors that are null or empty or hold null, NaN or infinite entries are left out. An entry
    whose x has more than 53 bits fails the query.
    """
    scaled = F.transform(
        F.col(vector_col), lambda c: F.floor(c.cast("double") * STEPS_PER_UNIT) + OFFSET
    )
    finite = F.forall(
        F.col(vector_col),
        lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")),
    )
    small = F.forall(
        F.col(vector_col), lambda c: F.abs(c.cast("double")) < float((EXACT - OFFSET) // STEPS_PER_UNIT)
    )
    kept = vectors.where((F.size(vector_col) > 0) & finite)
    return kept.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.when(small, scaled).otherwise(F.raise_error(F.lit("an entry is too large to whiten")))
        .cast("array<bigint>").alias("x"),
    )


def _numbered(rows: DataFrame, label: str) -> tuple[DataFrame, int]:
    """The rows, staged, with ``index`` from 0 without gaps, and their number.

    A row keeps its place in the staged file, so the numbers survive a lost executor.
    """
    staged = stage(rows.withColumns({
        "part": F.spark_partition_id(),
        "place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
    }), label)
    sizes = sorted((row["part"], row["count"]) for row in staged.groupBy("part").count().collect())
    starts, total = [], 0
    for part, size in sizes:
        starts.append((part, total))
        total += size
    offsets = F.broadcast(staged.sparkSession.createDataFrame(starts, "part int, start long"))
    return staged.join(offsets, "part").withColumn("index", F.col("start") + F.col("place")), total


def _centred(n: int, sums: list[int]) -> Column:
    """(n x - S) / n for each entry; the numerator is exact."""
    deviations = F.zip_with(F.col("x"), F.lit(sums).cast("array<bigint>"), lambda x, s: x * n - s)
    return F.transform(deviations, lambda d: d.cast("double") / float(n))


def _deviation(n: int, sums: list[int]) -> Column:
    """Exact sum of (n x - S)^2; fails rather than leave 64 bits."""
    def square(x, s):
        return (x * n - s) * (x * n - s)

    about = F.aggregate(_centred(n, sums), F.lit(0.0), lambda a, c: a + c * c) * float(n) * float(n)
    exact = F.aggregate(
        F.zip_with(F.col("x"), F.lit(sums).cast("array<bigint>"), square),
        F.lit(0).cast("bigint"), lambda a, v: a + v,
    )
    return F.when(about < 9.2e18, exact).otherwise(
        F.raise_error(F.lit("a deviation leaves 64 bits")).cast("bigint")
    )


def _row_matrix(rows: DataFrame, n: int, sums: list[int], rows_per_block: int) -> BlockMatrix:
    """Centred rows as a block matrix."""
    vectors = MLUtils.convertVectorColumnsFromML(
        rows.select("index", array_to_vector(_centred(n, sums)).alias("vector")), "vector"
    )
    return IndexedRowMatrix(vectors).toBlockMatrix(rows_per_block, len(sums))


def _dropped(matrix: BlockMatrix) -> None:
    """Give back the memory of a persisted matrix."""
    matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)


def _multiplied(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """Product whose sum over ``splits`` parts of the inner dimension runs in as many tasks."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def _scatter(rows: BlockMatrix) -> np.ndarray:
    """Transpose times rows, a small matrix."""
    splits = max(1, -(-rows.numRowBlocks // BLOCKS_A_TASK))
    scatter = _multiplied(rows.transpose(), rows, splits).toLocalMatrix().toArray()
    return (scatter + scatter.T) / 2


def _projected(rows: BlockMatrix, matrix: np.ndarray, context: SparkContext) -> BlockMatrix:
    body = DenseMatrix(*matrix.shape, matrix.ravel(order="F"))
    one = BlockMatrix(context.parallelize([((0, 0), body)], 1), *matrix.shape)
    return _multiplied(rows, one, 1)


def _as_rows(matrix: BlockMatrix) -> DataFrame:
    """(index, entries) of a block matrix, without a detour through Python."""
    model = matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model
    rows = MLUtils.convertVectorColumnsToML(callMLlibFunc("getIndexedRows", model), "vector")
    return rows.select("index", vector_to_array("vector").alias("entries"))


def whitened_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened,
    explained, identity_error.

    The fit list holds each different x once: n vectors with sums S. Components are the unit
    eigenvectors of its covariance (divisor n), numbered from 1 by falling eigenvalue e;
    ``whitened`` is x - S/n projected on one, over sqrt(e), ``explained`` is e over the trace, and
    ``identity_error`` is measured on the whitened fit list.

    Repeated vectors and ids get rows of their own, a null id stays null. Components without
    variance are left out: fewer than ``components`` where the fit list has fewer directions, and
    no rows at all for an empty table or a single vector. Vectors of several dimensions are an
    error. Further columns of the table are not looked at.
    """
    spark = vectors.sparkSession
    usable = usable_vectors(vectors, id_col, vector_col)
    rows, count = _numbered(usable, "usable-vectors")
    fit, n = _numbered(rows.select("x").distinct(), "fit-vectors")
    sums_of = fit.select(F.posexplode("x").alias("at", "value")).groupBy("at").agg(
        F.sum("value").alias("total"), F.count(F.lit(1)).alias("n")
    ).orderBy("at").collect()
    if any(row["n"] != n for row in sums_of):
        raise ValueError("vectors of several dimensions can't be whitened together")
    sums = [row["total"] for row in sums_of]
    nothing = spark.createDataFrame([], RESULT_DDL)
    if n < 2:
        return nothing
    rows_per_block = max(1, BLOCK_BYTES // (8 * len(sums)))
    fitted = _row_matrix(fit, n, sums, rows_per_block).persist(StorageLevel.MEMORY_AND_DISK)
    covariance = _scatter(fitted) / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    kept = min(components, int((values > values[0] * LEAST_SHARE).sum()))
    if not kept:
        _dropped(fitted)
        return nothing
    axes = axes[:, :kept]
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(kept)])
    whitening = axes * signs / np.sqrt(values[:kept])
    context = spark.sparkContext
    white = _projected(fitted, whitening, context).persist(StorageLevel.MEMORY_AND_DISK)
    error = float(np.abs(_scatter(white) / n - np.eye(kept)).max())
    _dropped(white)
    _dropped(fitted)
    shares = values[:kept] / np.trace(covariance)
    every = _row_matrix(rows, n, sums, rows_per_block)
    projected = _as_rows(_projected(every, whitening, context))
    result = rows.select("index", "vec_id", _deviation(n, sums).alias("deviation")).join(
        projected, "index"
    )
    shares = F.lit([float(share) for share in shares])
    return result.select(
        "vec_id", "deviation", F.posexplode("entries").alias("at", "whitened")
    ).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"),
        "deviation", "whitened", shares[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
