"""Whitening of embeddings by distributed block matrices.

Entries become exact integers, floor(scale * c) + shift, so that count and sums
of the table are exact too. The centred rows are indexed and cut into the blocks
of a BlockMatrix A. A transposed times A is the scatter matrix; its rows' index
range is split, so that no task gets the whole table: the parts are added up by
Spark. The scatter, of a vector's width, is solved on the driver, and A times the
whitening matrix, again a product of block matrices, projects every row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, functions as F

from corpusforge.llm.common import require, written

#: Rows and columns of a block.
ROWS, COLUMNS = 1024, 256
#: Blocks of rows that one task multiplies into a part of the scatter.
BLOCKS_A_PART = 64
#: Bits below the partition's number in monotonically_increasing_id.
IN_PARTITION = 33
EXACT = "decimal(38,0)"


@dataclass(frozen=True)
class Fit:
    """What was fitted: rows, sums of each dimension, eigenvalues (falling), unit
    eigenvectors (columns), trace, and the whitened rows' largest distance from
    the identity."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def integers(vector: Column, scale: int, shift: int) -> Column:
    """floor(scale * c) + shift of each entry; NULL for a vector that is NULL or
    has an entry that is NULL or not finite."""
    doubles = F.transform(vector, lambda c: c.cast("double"))
    sound = F.forall(doubles, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    return F.when(sound, F.transform(doubles, lambda c: F.floor(c * scale) + shift))


def indexed(rows: DataFrame) -> DataFrame:
    """The rows, written, with `index` from 0 without gaps."""
    rows = written(rows.withColumn("_at", F.monotonically_increasing_id()), "rows")
    part, place = F.shiftright("_at", IN_PARTITION), F.col("_at").bitwiseAND((1 << IN_PARTITION) - 1)
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()  # a number a partition
    starts, upto = {}, 0
    for r in sizes:
        starts[r["part"]] = upto
        upto += r["n"]
    first = F.lit(0).cast("long")
    if starts:
        first = F.element_at(F.create_map(*[F.lit(x) for p, s in starts.items() for x in (p, s)]), part)
    return rows.withColumn("index", first + place).drop("_at")


def block_matrix(rows: DataFrame, n: int, width: int) -> BlockMatrix:
    """The block matrix of `index` and `values` (array<double>)."""
    ml = rows.select("index", array_to_vector("values").alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(ml, "vector"), n, width)
    return matrix.toBlockMatrix(ROWS, min(COLUMNS, width))


def rows_of(matrix: BlockMatrix) -> DataFrame:
    """`index` and `values` of a block matrix's rows."""
    rows = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return MLUtils.convertVectorColumnsToML(rows, "vector").select("index", vector_to_array("vector").alias("values"))


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """Matrix transposed times matrix, in parts over its rows that Spark adds up."""
    width = matrix.numCols()
    splits = max(1, -(-matrix.numRows() // (ROWS * BLOCKS_A_PART)))
    turned = matrix.transpose()
    # The wrapper has no parameter for the number of parts, the class has.
    product = turned._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    local = BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()  # width * width numbers
    return np.asarray(local).reshape(width, width)


def projected(matrix: BlockMatrix, by: np.ndarray) -> BlockMatrix:
    """The matrix times a local one, itself cut into blocks."""
    step, session = matrix.colsPerBlock, matrix.blocks.context
    cut = [((i // step, 0), Matrices.dense(len(part), by.shape[1], part.ravel(order="F")))
           for i in range(0, len(by), step) for part in [by[i:i + step]]]
    right = BlockMatrix(session.parallelize(cut, len(cut)), step, by.shape[1], by.shape[0], by.shape[1])
    product = matrix._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model)
    return BlockMatrix(product, ROWS, by.shape[1])


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = 8,
           scale: int = 1024, shift: int = 100_000) -> tuple[DataFrame, Fit | None]:
    """Whitened rows of a table of vectors, and the fit.

    The rows have the id (with its name and type), deviation (decimal: the sum
    over dimensions of (n * x - sum)^2, exact) and whitened: at most `components`
    doubles, the row's centred integers on the unit eigenvectors of the
    covariance (divisor n), each over the root of its eigenvalue.

    Vectors that are NULL or hold a NULL or a non-finite entry are left out; a
    shorter vector counts as filled up with zeros. A NULL id stays NULL, repeated
    rows are rows of their own, other columns are ignored. Components whose
    eigenvalue is zero within rounding have no whitened form and are left out, so
    equal vectors, or a single one, give an empty array; equal eigenvalues come
    in the solver's order. Without a vector there are no rows and no fit.
    """
    require(vectors, [id_column, vector])
    kept = vectors.select(F.col(id_column).alias("id"), integers(F.col(vector), scale, shift).alias("x")).filter("x IS NOT NULL")
    rows = indexed(kept)
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width")).first()
    n, width = facts["n"], facts["width"] or 0
    if not n or not width:
        return rows.select(F.col("id").alias(id_column), F.lit(0).cast(EXACT).alias("deviation"),
                           F.array().cast("array<double>").alias("whitened")), None
    full = F.concat("x", F.array_repeat(F.lit(shift).cast("long"), F.lit(width) - F.size("x")))
    rows = rows.withColumn("x", full)
    # Sums of each dimension: `width` numbers.
    each = rows.select(F.posexplode("x").alias("d", "v")).groupBy("d").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("s"))
    sums = [int(r["s"]) for r in each.orderBy("d").collect()]

    # x - sum / n, of whole and broken part, so that nothing is rounded but the last bit.
    whole, broken = F.lit([s // n for s in sums]), [s % n / n for s in sums]
    values = F.zip_with(F.zip_with("x", whole, lambda v, m: (v - m).cast("double")), F.lit(broken), lambda v, m: v - m)
    centred = block_matrix(rows.select("index", values.alias("values")), n, width)
    centred.persist(StorageLevel.MEMORY_AND_DISK)  # three products use it
    values, basis = np.linalg.eigh(scatter(centred) / n)
    values, basis = values[::-1], basis[:, ::-1]
    trace = float(values.sum())
    real = int((values > max(trace, 0.0) * width * np.finfo(float).eps).sum())
    count = min(components, real)
    off = F.zip_with("x", F.lit(sums).cast("array<decimal(25,0)>"), lambda v, s: (v.cast("decimal(20,0)") * n - s).cast("decimal(19,0)"))
    square = F.aggregate(off, F.lit(0).cast(EXACT), lambda a, v: (a + (v * v).cast(EXACT)).cast(EXACT))
    base = rows.select("index", F.col("id").alias(id_column), square.alias("deviation"))
    if not count:
        return (base.drop("index").withColumn("whitened", F.array().cast("array<double>")),
                Fit(n, sums, values[:0], basis[:, :0], trace, 0.0))
    done = projected(centred, basis[:, :count] / np.sqrt(values[:count]))
    whitened = written(rows_of(done), "whitened")
    centred._java_matrix_wrapper._java_model.blocks().unpersist(False)
    error = float(np.abs(scatter(block_matrix(whitened, n, count)) / n - np.eye(count)).max())
    return (base.join(whitened.withColumnRenamed("values", "whitened"), "index").drop("index"),
            Fit(n, sums, values[:count], basis[:, :count], trace, error))
