"""Whitening of embeddings with MLlib's distributed block matrices.

Rows are centred, numbered and put together in blocks of a `BlockMatrix`. The scatter matrix is the
transposed matrix times itself, its eigenvectors are found locally, and the blocks times the
whitening matrix are the projected rows. Vectors become whole numbers first, so counts, sums and
deviations are exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortforge.llm.shared import staged

STEPS = 256  # whole numbers for a unit of an entry
COMPONENTS = 4
LEAST_ROWS, MOST_ROWS = 1024, 65_536  # rows of a block
WISHED_BLOCKS = 4096
MOST_COLUMNS = 1024  # columns of a block
TASK_BLOCKS = 4  # row blocks that a task multiplies and adds up
FLAT = 1e-12  # a component with less of the whole variance has none
RESULT = "vec_id long, component int, n long, deviation {wide}, whitened double, explained double, identity_error double"


@dataclass
class Fit:
    """What the distinct vectors give: their number and sums, and the components."""

    n: int
    sums: list[int]
    vectors: np.ndarray  # a column for each component
    values: np.ndarray  # their variances, falling
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def whitening(self) -> np.ndarray:
        """The components over the roots of their variances; zeros where there is none."""
        roots = np.sqrt(np.where(self.real, self.values, 1.0))
        return np.where(self.real, self.vectors / roots, 0.0)

    @property
    def real(self) -> np.ndarray:
        """Whether a component has any variance."""
        return self.values > FLAT * self.trace


def whole_vectors(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, x): rows whose vector is whole and finite, as whole numbers."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = rows.select(F.col(vec_id).alias("vec_id"), values.alias("v")).where(F.col("v").isNotNull() & finite)
    return kept.select("vec_id", F.transform("v", lambda c: F.floor(c * STEPS)).alias("x"))


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """`rows` staged with a column `row`: 0, 1, 2 and so on, without a sort.

    A task numbers its rows as it writes them; what goes before it is the sum of the counts of the
    tasks before, a row each.
    """
    place = F.monotonically_increasing_id()
    written = staged(rows.withColumns({"_part": F.shiftright(place, 33), "_place": place.bitwiseAND((1 << 33) - 1)}), name)
    counts = sorted(tuple(r) for r in written.groupBy("_part").count().collect())  # a row for each task
    before = np.concatenate([[0], np.cumsum([c for _, c in counts])]).tolist()
    starts = written.sparkSession.createDataFrame(
        [(part, start) for (part, _), start in zip(counts, before)], "_part long, _start long"
    )
    return written.join(F.broadcast(starts), "_part").withColumn("row", F.col("_start") + F.col("_place")).drop(
        "_part", "_place", "_start"
    )


def rows_per_block(n: int) -> int:
    """Blocks grow with the matrix, up to a size that a task holds: the driver keeps a key for each."""
    return max(LEAST_ROWS, min(MOST_ROWS, -(-n // WISHED_BLOCKS)))


def block_matrix(rows: DataFrame, n: int, size: int) -> BlockMatrix:
    """(row, v array<double>) as a matrix of `n` rows and `size` columns in blocks."""
    vectors = rows.select(F.col("row").alias("index"), array_to_vector("v").alias("vector"))
    indexed = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, size)
    return indexed.toBlockMatrix(rows_per_block(n), min(size, MOST_COLUMNS))


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The transposed matrix times itself.

    The row blocks are split among tasks that each add up what they multiply; one task would get
    all of them otherwise. Python's `multiply` lacks that argument of the library's.
    """
    parts = max(1, -(-matrix.numRowBlocks // TASK_BLOCKS))
    left, right = matrix.transpose()._java_matrix_wrapper, matrix._java_matrix_wrapper
    product = left.call("multiply", right._java_model, parts)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def small_matrix(spark: SparkSession, values: np.ndarray, rows_in_block: int) -> BlockMatrix:
    """A local matrix of few columns as a block matrix."""
    rows = [(k, row) for k, row in enumerate(values.tolist())]
    vectors = spark.createDataFrame(rows, "row long, v array<double>").select(
        F.col("row").alias("index"), array_to_vector("v").alias("vector")
    )
    indexed = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), *values.shape)
    return indexed.toBlockMatrix(rows_in_block, values.shape[1])


def centred(x: Column, mean: np.ndarray) -> Column:
    means = F.array(*(F.lit(float(m)) for m in mean))
    return F.zip_with(x, means, lambda c, m: c - m)


def deviation(x: Column, fit: Fit, most: int) -> Column:
    """The sum over dimensions of (n * x - sum) ** 2, exact.

    As a long where `most`, which no entry is beyond, shows that it fits; else as a decimal of 38
    digits, null beyond.
    """
    bound = max([fit.n * most + abs(s) for s in fit.sums], default=0) ** 2 * len(fit.sums)
    if bound < 1 << 63:
        kind, times, plus = "long", lambda a, b: a * b, lambda a, b: a + b
    else:
        kind, times, plus = "decimal(38,0)", F.try_multiply, F.try_add
    sums = F.array(*(F.lit(str(-s)).cast(kind) for s in fit.sums))
    off = F.zip_with(x, sums, lambda c, s: plus(times(c.cast(kind), F.lit(fit.n).cast(kind)), s))
    squares = F.transform(off, lambda t: times(t, t).cast(kind))
    return F.aggregate(squares, F.lit(0).cast(kind), lambda total, t: plus(total, t).cast(kind))


def fit_components(rows: DataFrame, sizes: list[int], components: int) -> tuple[Fit, BlockMatrix]:
    """The components of the rows (row, x), and the centred rows as a matrix."""
    n, size, *sums = sizes
    mean = np.array([s / n for s in sums])
    matrix = block_matrix(rows.select("row", centred(F.col("x"), mean).alias("v")), n, size)
    values, vectors = np.linalg.eigh(scatter(matrix) / n)
    order = np.argsort(-values, kind="stable")[:components]
    return Fit(n, sums, vectors[:, order], values[order], float(values.sum())), matrix


def error_of(projected: BlockMatrix, fit: Fit) -> float | None:
    """The largest entry, without sign, of the projected rows' covariance minus the identity."""
    if not fit.real.any():
        return None
    blocks = projected.toIndexedRowMatrix().rows
    # the rows' mean is subtracted before they are multiplied, small as it is
    totals = blocks.map(lambda r: r.vector.toArray()).treeReduce(lambda a, b: a + b)
    spark = SparkSession.active()
    flat = spark.createDataFrame(blocks.map(lambda r: (r.index, r.vector.toArray().tolist())), "row long, v array<double>")
    less = flat.select("row", centred(F.col("v"), totals / fit.n).alias("v"))
    covariance = scatter(block_matrix(less, fit.n, len(totals))) / fit.n
    return float(np.abs((covariance - np.eye(len(totals)))[np.ix_(fit.real, fit.real)]).max())


def whiten(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """Each vector's whitened components: a row for each vector and component.

    Columns: vec_id, component (from 1, by falling variance), n, deviation, whitened, explained and
    identity_error. Rows whose vector is null, or has null or non-finite entries, are left out. Rows
    that repeat are projected each and fitted once. Where lengths differ, a shorter vector has zeros
    at the end. Entries past a long's range are taken for its ends. A component without variance has a null `whitened`; without any variance, as with a
    single vector, `explained` and `identity_error` are null. An empty table, or one of empty
    vectors, gives an empty result. `deviation` is a long, or a decimal where it would not fit.
    """
    spark = rows.sparkSession
    every = numbered(whole_vectors(rows, vec_id, vector), "vectors")
    # -1 - c for a negative entry, as the least long has no opposite
    largest = F.aggregate("x", F.lit(0).cast("long"), lambda m, c: F.greatest(m, c, F.bitwise_not(c)))
    size, most, total = every.agg(F.max(F.size("x")), F.max(largest), F.count("*")).first()
    if not size:
        return spark.createDataFrame([], RESULT.format(wide="long"))
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size("x")))
    every = every.withColumn("x", padded)
    distinct = numbered(every.select("x").distinct(), "distinct")
    sums = [F.sum(F.col("x")[k].cast("decimal(38,0)")) for k in range(size)]
    n, *sums = map(int, distinct.agg(F.count("*"), *sums).first())
    fit, matrix = fit_components(distinct, [n, size, *sums], components)
    narrow = min(size, MOST_COLUMNS)
    whitening = small_matrix(spark, fit.whitening, narrow)
    error = error_of(matrix.multiply(whitening), fit)

    off = every.select("row", centred(F.col("x"), fit.mean).alias("v"))
    projected = block_matrix(off, total, size).multiply(whitening).toIndexedRowMatrix().rows
    flat = spark.createDataFrame(
        projected.map(lambda r: (r.index, r.vector.toArray().tolist())), "row long, white array<double>"
    )
    exact = every.select("row", "vec_id", deviation(F.col("x"), fit, most + 1).alias("deviation"))
    shares = [float(v / fit.trace) if fit.trace > 0 else None for v in fit.values]
    stated = F.array(
        *(
            F.struct(
                F.lit(k + 1).alias("component"),
                (F.col("white")[k] if real else F.lit(None).cast("double")).alias("whitened"),
                F.lit(share).cast("double").alias("explained"),
            )
            for k, (share, real) in enumerate(zip(shares, fit.real.tolist()))
        )
    )
    return exact.join(flat, "row").select("vec_id", "deviation", F.inline(stated)).select(
        "vec_id",
        "component",
        F.lit(fit.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        "explained",
        F.lit(error).cast("double").alias("identity_error"),
    )
