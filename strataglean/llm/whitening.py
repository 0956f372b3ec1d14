"""Embedding whitening with Spark MLlib's BlockMatrix.

Rows whose vector is null, or holds null or non-finite entries, are dropped. An entry c
becomes the integer x = floor(64 c) + 1,000,000. The fit list has each distinct x
vector once: n vectors with sums S. Rows are centred as (n x - S) / n, whose dividend is exact, and
get consecutive indices; a BlockMatrix holds them in blocks of rows that
all executors share. Its transpose times itself is the scatter matrix, whose size depends on
the dimension alone: the driver finds its eigenvectors. The centred rows of all vectors times the
whitening matrix, block by block, are the whitened rows. The covariance of the whitened
fit list is multiplied out once more, as a check on the result.

The transposed product is summed in partial sums of SPLIT row blocks, so that no task
multiplies them all.

Repeated rows and null ids are kept: one row each in the result. Equal vectors get equal results.
Components without variance (a single vector, dependent dimensions) can't be
whitened and are left out. An empty table, or one without a valid vector, gives an empty
result; empty vectors have no components. Valid vectors of different lengths have no
covariance and raise ValueError. A ``deviation`` beyond 64 bits is null. Extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strataglean.llm import common
from strataglean.session import cut_lineage, scratch_path

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
# Rows and columns of a block, row blocks that one task multiplies.
ROWS, COLUMNS, SPLIT = 1024, 1024, 32
# Part of the largest eigenvalue below which one is rounding.
ROUNDING = 1e-12

RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def integer_vectors(vectors: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``vec_id, x`` of the rows with a valid vector ``embedding``."""
    entries = F.col("embedding").cast("array<double>")
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.filter(entries.isNotNull()).filter(~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(entries, lambda c: F.floor(c * scale) + F.lit(offset).cast("long")).alias("x"))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with consecutive numbers ``at``, written once.

    Rows are numbered within their partition; the partitions' counts, one row each, give the offsets.
    """
    own = cut_lineage(rows.withColumn("own", F.monotonically_increasing_id()))
    part = F.shiftright("own", 33)
    counts = own.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n_rows")).collect()
    before, offsets = 0, []
    for number, n_rows in sorted(counts):
        offsets.append((number, before))
        before += n_rows
    table = rows.sparkSession.createDataFrame(offsets, "part int, before long")
    return own.join(F.broadcast(table), part == F.col("part")).withColumn(
        "at", F.col("own") - F.shiftleft(part.cast("long"), 33) + F.col("before")).drop("own", "part", "before")


def _matrix(rows: DataFrame, number: str, column: str, n_rows: int, width: int) -> BlockMatrix:
    """Blocks of the arrays in ``column``, at the row indices ``number``.

    A block is gathered as one row of a table in the shared folder, in the form in which Spark stores
    matrices, and read from there as a matrix: :meth:`IndexedRowMatrix.toBlockMatrix` would
    send an object for every single entry.
    """
    spark, parts = rows.sparkSession, [(j, at) for j, at in enumerate(range(0, width, COLUMNS))]
    pieces = rows.select(F.col(number).alias("at"), F.posexplode(F.array(*[
        F.slice(column, at + 1, COLUMNS) for _, at in parts])).alias("j", "v"))
    gathered = pieces.groupBy(F.floor(F.col("at") / ROWS).alias("i"), F.col("j").cast("long").alias("j")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda r: r["v"]).alias("v"))
    no_index = F.lit(None).cast("array<int>")
    path = scratch_path(spark, "matrix")
    gathered.select(
        F.struct(F.col("i").alias("_1"), F.col("j").alias("_2")).alias("_1"),
        F.struct(F.lit(1).cast("byte").alias("type"), F.size("v").alias("numRows"), F.size(F.get("v", F.lit(0))).alias("numCols"),
                 no_index.alias("colPtrs"), no_index.alias("rowIndices"), F.flatten("v").alias("values"),
                 F.lit(True).alias("isTransposed")).alias("_2")).write.parquet(path)
    place = StructType([StructField("_1", LongType()), StructField("_2", LongType())])
    blocks = spark.read.schema(StructType([StructField("_1", place), StructField("_2", MatrixUDT())])).parquet(path)
    return BlockMatrix(callMLlibFunc("createBlockMatrix", blocks, ROWS, COLUMNS, n_rows, width), ROWS, COLUMNS)


def _scatter(matrix: BlockMatrix) -> np.ndarray:
    """Transposed matrix times matrix, summed in parts; its size is the square of the width."""
    splits = -(-matrix.numRowBlocks // SPLIT)
    product = matrix.transpose()._java_matrix_wrapper.call(
        "multiply", matrix._java_matrix_wrapper._java_model, splits)
    whole = BlockMatrix(product, COLUMNS, COLUMNS).toLocalMatrix().toArray()
    return (whole + whole.T) / 2


def _projected(matrix: BlockMatrix, onto: np.ndarray) -> DataFrame:
    """``at, w``: the rows of ``matrix`` times ``onto``."""
    spark = SparkSession.active()
    width, height = onto.shape[1], onto.shape[0]
    blocks = [((i, j), Matrices.dense(len(part), part.shape[1], part.ravel("F").tolist()))
              for i, rows in enumerate(np.split(onto, range(COLUMNS, height, COLUMNS)))
              for j, part in enumerate(np.split(rows, range(COLUMNS, width, COLUMNS), axis=1))]
    right = BlockMatrix(spark.sparkContext.parallelize(blocks), COLUMNS, COLUMNS, height, width)
    product = matrix.multiply(right).toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    plain = MLUtils.convertVectorColumnsToML(rows, "vector")
    return plain.select(F.col("index").alias("at"), vector_to_array("vector").alias("w"))


def whitening_matrix(covariance: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvectors over the roots of their eigenvalues, one column each, and the eigenvalues.

    They come by falling eigenvalue; a vector's largest entry is positive. Eigenvalues that are
    rounding are left out.
    """
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    some = int((values > ROUNDING * max(values.max(initial=0.0), 1e-300)).sum())
    some = min(some, components)
    values, vectors = values[:some], vectors[:, :some]
    largest = np.abs(vectors).argmax(0) if some else np.zeros(0, int)
    vectors = vectors * np.sign(vectors[largest, np.arange(some)])
    return vectors / np.sqrt(values), values


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """One row per valid row of ``vectors`` (vec_id, embedding) and component, see RESULT."""
    spark = vectors.sparkSession
    rows = cut_lineage(numbered(integer_vectors(vectors, scale, offset)))
    # Equal vectors meet after one of them per task is left; the first row stands for them.
    fit = cut_lineage(numbered(rows.groupBy("x").agg(F.min("at").alias("first"))))
    shape = fit.agg(F.count(F.lit(1)), F.min(F.size("x")), F.max(F.size("x"))).first()
    n, shortest, width = shape
    if not n or not width:
        return spark.createDataFrame([], RESULT)
    if shortest != width:
        raise ValueError(f"vectors of {shortest} and of {width} entries have no common covariance")
    sums = dict(fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum("v")).collect())
    total = F.array(*[F.lit(sums[i]).cast("long") for i in range(width)])  # as many as dimensions

    def deviations(x: str) -> Column:
        return F.zip_with(F.col(x), total, lambda v, s: v * n - s)

    def centred(table: DataFrame) -> DataFrame:
        return table.select("at", F.transform(deviations("x"), lambda d: d / F.lit(float(n))).alias("c"))

    covariance = _scatter(_matrix(centred(fit), "at", "c", n, width)) / n
    matrix, values = whitening_matrix(covariance, components)
    if not len(values):
        return spark.createDataFrame([], RESULT)
    n_rows = rows.agg(F.max("at")).first()[0] + 1
    whitened = cut_lineage(_projected(_matrix(centred(rows), "at", "c", n_rows, width), matrix))
    fitted = fit.select("first", "at").join(whitened.withColumnRenamed("at", "first"), "first")
    checked = _scatter(_matrix(fitted, "at", "w", n, len(values))) / n
    error = float(np.abs(checked - np.eye(len(values))).max())
    explained = F.array(*[F.lit(float(v)) for v in values / np.trace(covariance)])

    def try_square_sum(d: Column) -> Column:
        return F.aggregate(d, F.lit(0).cast("long"), lambda a, v: F.try_add(a, F.try_multiply(v, v)))

    own = rows.select("at", "vec_id", try_square_sum(deviations("x")).alias("deviation"))
    return own.join(whitened, "at").select(
        "vec_id", "deviation", F.posexplode("w").alias("c", "whitened")).select(
        "vec_id", (F.col("c") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", F.get(explained, F.col("c")).alias("explained"), F.lit(error).alias("identity_error"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding projected on the first 16 whitened components."""
    return whiten(common.table(spark, sf_dir, "embeddings"))
