"""Whitening of embeddings with distributed block matrices.

Vectors become integer rows, ``floor(scale * c) + shift``, so that sums and
deviations are exact. The centred rows are numbered, cut into blocks of a
``BlockMatrix`` and multiplied with their transpose, which gives the scatter
matrix; its eigenvectors come from a local ``eigh`` (the matrix has the square
of the dimension entries, whatever the number of rows). A second block product,
with the whitening matrix, projects the rows.

Scale: the scatter product is split along the rows (``numMidDimSplits``), so
its blocks meet in many tasks and only products of the size of the result are
summed. Only block numbers (one pair per ``BLOCK_ROWS`` rows), the sums per
dimension and the scatter matrix reach the driver. Vectors stay in the JVM; the
numbered rows are a table in the shared folder, so lost executors cost a
recomputation of blocks, never another numbering. The blocks are kept on the
executors' disks between the products and released at the end.

Defined cases: rows whose vector is null, empty or holds null or non-finite
entries are dropped, as are vectors of another length than most (of equally
frequent lengths the larger stays) and those with entries beyond 2**52 in size,
which have no long; repeated rows count as often as they occur, ids may be
null; an empty table gives no rows. A component without variance (an
eigenvalue under 1e-12 of the trace) has whitened 0. A deviation of more than
38 digits is null. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.shared import quoted, stage, stage_counted

SCALE, SHIFT = 1024, 100_000
BLOCK_ROWS = 4096  # rows of a block: 2 MB at 64 dimensions
LARGEST = float(1 << 52)
NO_VARIANCE = 1e-12  # of the trace


@dataclass
class Whitening:
    """What a fit yields: rows, sums per dimension, eigenvalues (falling), unit
    eigenvectors (columns) and the trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def rank(self) -> np.ndarray:
        return self.values > NO_VARIANCE * self.trace

    def matrix(self) -> np.ndarray:
        """dimension x components: projects a centred row to unit variance (0 where there is none)."""
        scale = np.zeros(len(self.values))
        scale[self.rank] = 1 / np.sqrt(self.values[self.rank])
        return self.vectors * scale


def integer_rows(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> tuple[DataFrame, int, int]:
    """(vec_id, index, x) of the valid rows, the index from 0 without gaps; the
    number of rows and their dimension."""
    v = F.transform(quoted(vector), lambda c: c.cast("double"))
    # NaN is the largest double, so one bound on the size covers it and the infinities
    sound = F.size("v").__gt__(0) & F.forall("v", lambda c: c.isNotNull() & (F.abs(c) <= LARGEST))
    rows = vectors.select(quoted(vec_id).alias("vec_id"), v.alias("v")).where(F.coalesce(sound, F.lit(False)))
    x = F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    rows = stage(rows.select("vec_id", x.alias("x"), F.monotonically_increasing_id().alias("place")), "whiten_rows")
    d = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).limit(1).collect()
    if not d:
        return rows.select("vec_id", F.col("place").alias("index"), "x"), 0, 0
    rows = rows.where(F.size("x") == d[0]["d"])
    # the place is (task, row of the task): rows are numbered task by task
    task = F.shiftright("place", 33)
    counts = stage(rows.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("least")),
                   "whiten_counts")  # one row per task
    before = F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("task", F.coalesce(before, F.lit(0)).alias("start"))
    turn = F.row_number().over(Window.partitionBy("task").orderBy("place")) - 1
    numbered = rows.withColumn("task", task).withColumn("turn", turn)
    index = (F.col("start") + F.col("turn")).alias("index")
    out, seen = stage_counted(numbered.join(F.broadcast(starts), "task").select("vec_id", index, "x"), "whiten_index")
    return out, int(seen["rows"]), int(d[0]["d"])


def _block_matrix(rows: DataFrame, means: list[float], n: int) -> BlockMatrix:
    """The centred rows as blocks of ``BLOCK_ROWS`` x all dimensions."""
    d = len(means)
    mean = F.array(*[F.lit(float(m)) for m in means])
    centred = F.zip_with(F.col("x"), mean, lambda a, b: a.cast("double") - b)
    frame = rows.select("index", array_to_vector(centred).alias("vector"))
    frame = MLUtils.convertVectorColumnsFromML(frame, "vector")
    made = callMLlibFunc("createIndexedRowMatrix", frame, n, d)  # from a DataFrame: no row passes through Python
    return IndexedRowMatrix(made, n, d).toBlockMatrix(BLOCK_ROWS, d)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """transpose x matrix, the rows split over as many tasks as there are partitions."""
    d = matrix.numCols()
    left = matrix.transpose()
    blocks = -(-matrix.numRows() // BLOCK_ROWS)
    java = left._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, max(blocks // 4, 1))
    return BlockMatrix(java, d, d).toLocalMatrix().toArray()


def fit(rows: DataFrame, n: int, d: int, components: int | None = None) -> tuple[Whitening, BlockMatrix | None]:
    """The whitening of integer rows, and their centred block matrix."""
    if not n:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0), None
    entry = rows.select(F.posexplode("x").alias("i", "x")).groupBy("i")
    total = [0] * d
    for r in entry.agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s")).collect():  # one sum per dimension
        total[r.i] = int(r.s)
    matrix = _block_matrix(rows, [s / n for s in total], n).persist(StorageLevel.DISK_ONLY)
    v = scatter(matrix) / n
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    k = min(components or d, d)
    values, vectors = np.maximum(values[::-1][:k], 0.0), vectors[:, ::-1][:, :k]
    sign = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(k)])
    return Whitening(n, total, values, vectors * sign, float(np.trace(v))), matrix


def project(matrix: BlockMatrix, model: Whitening) -> DataFrame:
    """(index, w): the whitened components of every row."""
    d, k = model.vectors.shape
    spark = matrix.blocks.ctx
    local = DenseMatrix(d, k, model.matrix().ravel(order="F").tolist())
    right = BlockMatrix(spark.parallelize([((0, 0), local)], 1), d, k, d, k)
    out = matrix.multiply(right).toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", out._java_matrix_wrapper._java_model)
    rows = MLUtils.convertVectorColumnsToML(rows, "vector")
    return rows.select("index", vector_to_array("vector").alias("w"))


def deviation(x: Column, model: Whitening, largest: int) -> Column:
    """Sum over the dimensions of (n*x - S)^2, exact: in longs where ``largest``,
    a bound of all |n*x - S|, proves that they fit, else in decimals."""
    if len(model.sums) * largest ** 2 < 1 << 63:
        off = F.zip_with(x, F.array(*[F.lit(v) for v in model.sums]), lambda a, b: a * F.lit(model.n) - b)
        return F.aggregate(off, F.lit(0).cast("bigint"), lambda t, v: t + v * v)
    wide = "decimal(38,0)"
    s = F.array(*[F.lit(str(v)).cast(wide) for v in model.sums])
    n = F.lit(model.n).cast("decimal(19,0)")
    off = F.zip_with(x, s, lambda a, b: (a.cast("decimal(19,0)") * n - b).cast(wide))
    return F.aggregate(off, F.lit(0).cast(wide),
                       lambda t, v: F.try_add(t, F.try_multiply(v, v).try_cast(wide)).try_cast(wide))


def whiten(vectors: DataFrame, components: int = 8, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """One row per vector: vec_id, n, deviation (decimal or long), whitened
    (array<double>, by falling eigenvalue), explained (array<double>) and
    identity_error, the largest entry of |covariance of whitened - identity|."""
    rows, n, d = integer_rows(vectors, vector, vec_id)
    id_type = rows.schema["vec_id"].dataType.simpleString()
    if not n:
        return vectors.sparkSession.createDataFrame([], (
            f"vec_id {id_type}, n bigint, deviation bigint, whitened array<double>, explained array<double>, "
            "identity_error double"))
    model, matrix = fit(rows, n, d, components)
    ends = rows.agg(F.min(F.array_min("x")).alias("a"), F.max(F.array_max("x")).alias("b")).collect()[0]
    largest = max(abs(n * x - s) for x in (ends.a, ends.b) for s in model.sums)
    out = rows.join(project(matrix, model), "index")
    out = stage(out.select("vec_id", "w", deviation(F.col("x"), model, largest).alias("deviation")), "whiten_out")
    matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)
    error = identity_error(out.select("w"), model)
    total = model.trace or 1.0
    return out.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", F.col("w").alias("whitened"),
                      F.array(*[F.lit(float(v / total)) for v in model.values]).alias("explained"),
                      F.lit(error).alias("identity_error"))


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """Largest |covariance - identity| of the components that have a variance."""
    some = [i for i in range(len(model.values)) if model.rank[i]]
    if not some:
        return 0.0
    means = whitened.agg(*[F.avg(F.col("w")[i]).alias(f"m{i}") for i in some]).collect()[0]
    off = {i: F.col("w")[i] - F.lit(means[f"m{i}"]) for i in some}
    pairs = [(i, j) for i in some for j in some if i <= j]
    got = whitened.agg(*[F.avg(off[i] * off[j]).alias(f"c{i}_{j}") for i, j in pairs]).collect()[0]
    return max(abs(got[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
