"""Whitening of embeddings with MLlib's block matrices.

Entries become whole numbers, so the sums over all vectors are exact and each centred row is
rounded once. The centred rows are indexed into a distributed block matrix whose transpose
times itself is the scatter matrix; only that, columns by columns, comes to the driver for its
eigenvectors. A second block product projects all rows. No row passes through Python.
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
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termlode.llm.common import stored

COMPONENTS = 8
SCALE = 1024
OFFSET = 100_000

# Entries beyond this are no embedding's; their whole numbers would leave the exact range.
LARGEST = float(1 << 40)

# Rows and columns of a block, and the row blocks that one task multiplies.
BLOCK_ROWS = 1024
BLOCK_COLUMNS = 256
GROUP_BLOCKS = 16

# Eigenvalues below this share of the largest are rounding errors of zero.
NO_VARIANCE = 1e-12


@dataclass(frozen=True)
class Whitening:
    """Centre and components of all vectors; as large as a square of the dimension at most."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray  # a column each
    trace: float

    def scaled(self) -> np.ndarray:
        """Columns that take centred rows to unit variance; zeros where there is none."""
        some = self.has_variance()
        return self.components / np.sqrt(np.where(some, self.eigenvalues, 1.0)) * some

    def has_variance(self) -> np.ndarray:
        return self.eigenvalues > NO_VARIANCE * max(self.eigenvalues, default=0.0)


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, x)``: vectors without holes, entries as whole numbers.

    A vector that is null, empty, or has a null, infinite, NaN or huge (2^40) entry is no
    vector. Vectors of another length than most have cannot be compared and go as well; of
    two lengths that are equally common the larger counts.
    """
    entries = embeddings.select(
        "vec_id", embeddings["embedding"].cast("array<double>").alias("entries")
    )
    hole = F.exists(
        "entries", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= F.lit(LARGEST))
    )
    whole = entries.where(F.col("entries").isNotNull() & (F.size("entries") > 0) & ~hole)
    most = (
        whole.groupBy(F.size("entries").alias("length"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(F.max(F.struct("rows", "length")).alias("most"))
        .first()["most"]
    )
    length = most["length"] if most else 0
    return whole.where(F.size("entries") == length).select(
        "vec_id",
        F.transform("entries", lambda c: F.floor(c * SCALE).cast("long") + OFFSET).alias("x"),
    )


def indexed(vectors: DataFrame) -> DataFrame:
    """Rows under consecutive numbers from 0, stored so that every later read sees the same.

    The number of a row is its place in the task that wrote it behind the rows of all tasks
    before, so nothing is sorted; one number per task is broadcast.
    """
    place = F.monotonically_increasing_id()
    rows = stored(
        vectors.withColumn("part", F.shiftright(place, 33)).withColumn(
            "place", place.bitwiseAND((1 << 33) - 1)
        ),
        "vectors",
    )
    ends = rows.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = ends.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    return rows.join(F.broadcast(first), "part").select(
        (F.col("first") + F.col("place")).alias("index"), *vectors.columns
    )


def deviations(sums: list[int], n: int):
    """``n * x - sums`` of each entry, exact."""
    return F.zip_with("x", F.array(*map(F.lit, sums)), lambda x, s: x * F.lit(n) - s)


def centred_blocks(rows: DataFrame, sums: list[int], n: int) -> BlockMatrix:
    centred = F.transform(deviations(sums, n), lambda y: y.cast("double") / F.lit(n))
    frame = rows.select("index", array_to_vector(centred).alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(frame, "vector"), n, len(sums))
    blocks = matrix.toBlockMatrix(BLOCK_ROWS, min(BLOCK_COLUMNS, len(sums)))
    # Both products read them, the first on both sides; lost ones are put together again.
    return blocks.persist(StorageLevel.MEMORY_AND_DISK)


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix.

    The rows are the inner dimension, and the product would be formed in a task for each of
    its blocks. MLlib's product takes a number of splits of that dimension, though its Python
    form does not pass it on; each split adds up its row blocks before anything is gathered.
    """
    splits = max(1, -(-blocks.numRowBlocks // GROUP_BLOCKS))
    turned = blocks.transpose()
    product = turned._java_matrix_wrapper.call(
        "multiply", blocks._java_matrix_wrapper._java_model, splits
    )
    side = blocks.colsPerBlock
    return BlockMatrix(product, side, side).toLocalMatrix().toArray()


def centre(rows: DataFrame) -> tuple[int, list[int]]:
    """How many rows there are, and their sum in each dimension."""
    length = rows.agg(F.max(F.size("x"))).first()[0] or 0
    n, *sums = rows.agg(
        F.count(F.lit(1)), *(F.sum(F.col("x")[i]) for i in range(length))
    ).first()
    return n, sums


def fit(blocks: BlockMatrix, n: int, sums: list[int], components: int = COMPONENTS) -> Whitening:
    """The first components of centred rows in blocks."""
    covariance = scatter(blocks) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(values)[::-1][:components]
    vectors = vectors[:, order]
    heaviest = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))]
    return Whitening(
        n, sums, np.maximum(values[order], 0), vectors * np.sign(heaviest), float(np.trace(covariance))
    )


def project(spark: SparkSession, blocks: BlockMatrix, model: Whitening) -> DataFrame:
    """``(index, projected)``, the centred rows times the whitening matrix."""
    matrix, side, width = model.scaled(), blocks.colsPerBlock, len(model.eigenvalues)
    parts = [
        ((i, 0), Matrices.dense(len(part), width, part.ravel(order="F")))
        for i, part in enumerate(matrix[low : low + side] for low in range(0, len(matrix), side))
    ]
    whitening = BlockMatrix(spark.sparkContext.parallelize(parts, 1), side, width)
    product = blocks.multiply(whitening).toIndexedRowMatrix()
    found = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    vectors = MLUtils.convertVectorColumnsToML(found, "vector")
    return vectors.select("index", vector_to_array("vector").alias("projected"))


def identity_error(projected: DataFrame, some: np.ndarray) -> float | None:
    """Largest entry of the covariance of the projected rows less the identity.

    Components without variance are left out; None if there is no other.
    """
    pairs = [(i, j) for i in np.flatnonzero(some).tolist() for j in np.flatnonzero(some).tolist() if i <= j]
    if not pairs:
        return None
    entry = F.col("projected")
    found = projected.agg(*(F.covar_pop(entry[i], entry[j]) for i, j in pairs)).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(found, pairs, strict=True))


WHITENED = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each vector without holes and each of the first components.

    ``(vec_id, component, n, deviation, whitened, explained, identity_error)``; components
    count from 1, there are no more than dimensions. ``deviation`` is NULL where it is no
    64-bit number. A component along which the vectors do not differ has ``whitened`` NULL and
    no part in ``identity_error``, which is NULL if there is no other component; ``explained``
    is NULL if the vectors do not differ at all. Null ids stay, repeated rows are rows of
    their own, other columns are ignored, a table without vectors gives an empty result.
    Which vectors count is told in :func:`whole_vectors`.
    """
    spark = embeddings.sparkSession
    rows = indexed(whole_vectors(embeddings))
    n, sums = centre(rows)
    if not n:
        return spark.createDataFrame([], WHITENED)
    blocks = centred_blocks(rows, sums, n)
    model = fit(blocks, n, sums, components)
    some = model.has_variance()
    projected = stored(project(spark, blocks, model), "projected")
    error = identity_error(projected, some)
    total = F.aggregate(
        deviations(model.sums, model.n),
        F.lit(0).cast("decimal(38,0)"),
        lambda so_far, y: (
            so_far + (y.cast("decimal(19,0)") * y.cast("decimal(19,0)"))
        ).cast("decimal(38,0)"),
    )
    exact = rows.select("index", "vec_id", total.try_cast("long").alias("deviation"))
    kinds = F.array(
        *(
            F.struct(
                F.lit(k + 1).alias("component"),
                (F.col("projected")[k] if some[k] else F.lit(None).cast("double")).alias("whitened"),
                F.lit(value / model.trace if model.trace > 0 else None).cast("double").alias("explained"),
            )
            for k, value in enumerate(model.eigenvalues.tolist())
        )
    )
    return (
        exact.join(projected, "index")
        .select("vec_id", "deviation", F.inline(kinds))
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            "component",
            F.lit(model.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            "explained",
            F.lit(error).cast("double").alias("identity_error"),
        )
    )
