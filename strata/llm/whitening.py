"""Whitening of embeddings with Spark MLlib's BlockMatrix.

Components become integers.  The fit list is each distinct vector once; its rows are numbered,
centred (in whole numbers, n * x - S, then divided by n) and laid out as blocks of an MLlib
``BlockMatrix``.  The scatter matrix is the transpose times the matrix; its eigenvectors come
from ``numpy.linalg.eigh`` on the driver, where the matrix has only the vectors' dimension.
A second multiplication, by the eigenvectors over the roots of their eigenvalues, projects
the rows, and every row of the table takes the result of its fit row.

Blocks hold 1,024 rows, more where there would be over 65,536 blocks, since MLlib
plans a product by the list of blocks.  The inner dimension of a scatter product is split over
``splits`` partitions, whose partial sums of a dimension-sized square are then added up.

Defined results: rows with a null vector or a null or non-finite component are dropped, and so
are those whose length is not the most frequent (the longer of two as frequent); a scaled component beyond
2^31 in size counts as 2^31; repeated rows and equal vectors get equal results; components
without variance (an eigenvalue within rounding of zero, as in lists of fewer vectors than
dimensions) are left out, so a list of one vector gives no row; a deviation beyond a long is null;
an empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from .common import freeze, join_spread
from .vector_codes import finite, matrix, usual_length, whole_numbers

X, DIGEST, INDEX = "__wh_x", "__wh_digest", "__wh_index"
LIMIT = 1 << 31
ROWS_PER_BLOCK, MOST_BLOCKS, COLUMNS_PER_BLOCK = 1024, 1 << 16, 1024


def fit_list(kept: DataFrame) -> tuple[DataFrame, int]:
    """Distinct vectors with the number of rows that share them (``n``), numbered from 0."""
    distinct = kept.groupBy(DIGEST).agg(F.any_value(X).alias(X), F.count(F.lit(1)).alias("n"))
    place = F.monotonically_increasing_id()
    made = freeze(distinct.withColumns({"__wh_part": F.shiftright(place, 33), "__wh_place": place}), "whitening-fit")
    counts = sorted((r["__wh_part"], r["count"]) for r in made.groupBy("__wh_part").count().collect())  # one row a partition
    before = np.concatenate(([0], np.cumsum([n for _, n in counts]))).astype(np.int64).tolist()
    base = made.sparkSession.createDataFrame(
        [(p, b - (p << 33)) for (p, _), b in zip(counts, before)], "__wh_part bigint, __wh_base bigint"
    )
    numbered = made.join(F.broadcast(base), "__wh_part").withColumn(INDEX, F.col("__wh_place") + F.col("__wh_base"))
    return numbered.select(INDEX, DIGEST, X, "n"), before[-1]


def dimension_sums(fit: DataFrame, width: int) -> list[int]:
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            total += matrix(batch.column(X), width).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], ["dim", "total"])

    parts = fit.select(X).mapInArrow(add_up, "dim long, total long").groupBy("dim").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    return [int(t) for _, t in sorted(parts.collect())]


def centred(fit: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """``INDEX``, ``row`` (x - S/n as doubles) and ``deviation`` (the exact sum of (n*x - S)^2)."""
    width = len(sums)
    near = n < 1 << 30 and max(map(abs, sums)) < 1 << 62  # n * x - S fits 64 bits

    def centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(X), width)
            d = x * n - np.array(sums, np.int64) if near else x.astype(object) * n - np.array(sums, object)
            wide = not near or float(np.abs(d).max(initial=0)) ** 2 * width >= 2.0**62
            squares = ((d.astype(object) if wide else d) ** 2).sum(1).tolist()
            rows = (d / n).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(INDEX),
                    pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * width, pa.array(rows.ravel())),
                    pa.array([s if s < 1 << 63 else None for s in squares], pa.int64()),
                ],
                [INDEX, "row", "deviation"],
            )

    return freeze(fit.select(INDEX, X).mapInArrow(centre, f"{INDEX} long, row array<double>, deviation long"), "whitening-centred")


def block_matrix(rows: DataFrame, n: int, width: int) -> BlockMatrix:
    """Rows numbered by ``INDEX`` as dense blocks."""
    vectors = rows.select(F.col(INDEX).alias("index"), array_to_vector("row").alias("vector"))
    indexed = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, width)
    return indexed.toBlockMatrix(max(ROWS_PER_BLOCK, -(-n // MOST_BLOCKS)), COLUMNS_PER_BLOCK)


def product(a: BlockMatrix, b: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """``a`` times ``b``, the inner dimension dealt over ``splits`` partitions."""
    made = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(made, a.rowsPerBlock, b.colsPerBlock)


def covariance(m: BlockMatrix, n: int, splits: int) -> np.ndarray:
    """Of a matrix of centred rows, divisor ``n``."""
    return product(m.transpose(), m, splits).toLocalMatrix().toArray() / n


def local_blocks(spark, values: np.ndarray) -> BlockMatrix:
    """A small matrix as blocks that fit the columns of ``block_matrix``."""
    size = COLUMNS_PER_BLOCK
    cuts = [(i, j) for i in range(-(-len(values) // size)) for j in range(-(-values.shape[1] // size))]
    parts = [((i, j), values[i * size : i * size + size, j * size : j * size + size]) for i, j in cuts]
    blocks = [(at, Matrices.dense(*p.shape, p.ravel(order="F").tolist())) for at, p in parts]
    return BlockMatrix(spark.sparkContext.parallelize(blocks, 1), COLUMNS_PER_BLOCK, COLUMNS_PER_BLOCK, *values.shape)


def rows_of(m: BlockMatrix) -> DataFrame:
    """``INDEX`` and ``row`` of each row, without leaving the JVM."""
    indexed = m.toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", indexed._java_matrix_wrapper._java_model)
    ml = MLUtils.convertVectorColumnsToML(rows, "vector")
    return ml.select(F.col("index").alias(INDEX), vector_to_array("vector").alias("row"))


def principal(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues and unit eigenvectors (columns) by falling eigenvalue, at most ``most`` and none
    within rounding of zero; and the trace."""
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    real = values > max(values[0], 0.0) * len(v) * 1e-14
    return values[real], vectors[:, real], float(np.trace(v))


EMPTY = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, vector: str = "embedding", components: int = 16, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every row
    whose vector is whole and every component."""
    spark = rows.sparkSession
    kept = rows.filter(finite(F.col(vector))).select("vec_id", whole_numbers(F.col(vector), scale, LIMIT).alias(X))
    width = usual_length(kept, X)
    usual = kept.filter(F.size(X) == width).select("vec_id", F.transform(X, lambda c: c + shift).alias(X))
    usual = freeze(usual.withColumn(DIGEST, F.sha2(F.array_join(X, ",").cast("binary"), 256)), "whitening-rows")
    fit, n = fit_list(usual)
    if not n or not width:
        return spark.createDataFrame([], EMPTY.format(rows.schema["vec_id"].dataType.simpleString()))
    lined = centred(fit, n, dimension_sums(fit, width))
    splits = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = block_matrix(lined, n, width).persist(StorageLevel.MEMORY_AND_DISK)
    values, vectors, trace = principal(covariance(blocks, n, splits), components)
    if not len(values):
        return spark.createDataFrame([], EMPTY.format(rows.schema["vec_id"].dataType.simpleString()))
    k = len(values)
    projected = freeze(rows_of(product(blocks, local_blocks(spark, vectors / np.sqrt(values)))), "whitening-projected")
    blocks._java_matrix_wrapper._java_model.blocks().unpersist(False)

    means = projected.agg(*[F.avg(F.col("row")[i]).alias(str(i)) for i in range(k)]).first()
    about = projected.select(INDEX, F.zip_with("row", F.array(*[F.lit(float(m)) for m in means]), lambda a, m: a - m).alias("row"))
    error = float(np.abs(covariance(block_matrix(about, n, k), n, splits) - np.eye(k)).max())

    fitted = fit.select(INDEX, DIGEST, "n").join(lined.select(INDEX, "deviation"), INDEX).join(projected, INDEX)
    spread = usual.select("vec_id", DIGEST, F.monotonically_increasing_id().alias("__wh_spread"))
    whole = join_spread(spread, freeze(fitted.drop(INDEX), "whitening-fitted"), DIGEST, ["__wh_spread"])
    explained = F.array(*[F.lit(float(e / trace)) for e in values])
    return whole.select("vec_id", "deviation", F.posexplode("row").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
