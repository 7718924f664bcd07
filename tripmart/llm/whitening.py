"""Whitening of embeddings with distributed block matrices.

Entries become integers (``floor(256 c)``).  The distinct vectors, numbered from zero, are
centred on their exact means and dealt as indexed rows to the blocks of an MLlib
BlockMatrix; its transpose times itself is the scatter, whose eigenvectors the driver finds
(a square of the dimension, whatever the rows).  A second block product with the whitening
matrix projects every row.  The product of the transpose is cut along the rows, so that a
task multiplies a bounded number of blocks and only squares of the dimension meet.

Rows find their distinct vector's values by digest.  Vectors with more than
``1 / HEAVY_SHARE`` of the rows (fewer than ``HEAVY_SHARE`` of them) are broadcast and
joined where their rows lie; the others are shuffled.

Defined cases: rows are dropped whose vector is null or holds a null, a NaN or an infinity;
shorter vectors count as continued by zeros; entries beyond a long saturate; of a component
without variance (fewer distinct vectors than components, say) ``whitened`` and ``explained``
are zero, and ``identity_error`` leaves it out; a deviation beyond a long is null; repeated
rows each have their rows of the result; a null vec_id stays; an empty table, or one without
entries, gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import stored

SCALE = 256
COMPONENTS = 4
HEAVY_SHARE = 1000
#: Bytes of a block, columns of a block, and bytes of blocks that one task multiplies.
BLOCK_BYTES, BLOCK_COLUMNS, TASK_BYTES = 16 << 20, 1024, 128 << 20
RESULT = (
    "vec_id {}, component int, n long, deviation long, whitened double, explained double,"
    " identity_error double"
)


def integer_vectors(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, x and the digest of x for every row whose vector is complete and finite."""
    entries = F.col(vector).cast("array<double>")

    def unusable(entry: Column) -> Column:
        return entry.isNull() | F.isnan(entry) | (F.abs(entry) == float("inf"))

    usable = embeddings.filter(F.col(vector).isNotNull() & ~F.exists(entries, unusable))
    x = F.transform(entries, lambda entry: F.floor(entry * SCALE))
    # Trailing zeros say nothing: vectors are as long as the longest.
    rows = usable.select("vec_id", x.alias("x"))
    longest = rows.agg(F.max(F.size("x")))
    return _digested(rows, (longest.first()[0] or 0))


def _digested(rows: DataFrame, dimension: int) -> DataFrame:
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("long"), dimension - F.size("x")))
    rows = rows.withColumn("x", padded)
    text = F.concat_ws(",", F.col("x").cast("array<string>"))
    return rows.withColumn("digest", F.unhex(F.sha2(text, 256)))


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """The stored fit list: digest, x, copies and a dense ``index``."""
    within = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    fit = stored(
        vectors.groupBy("digest", "x")
        .agg(F.count("*").alias("copies"))
        .select("*", F.spark_partition_id().alias("part"), within.alias("place")),
        "distinct-vectors",
    )
    # One row for each shuffle partition.
    sizes = sorted(fit.groupBy("part").count().collect())
    starts, total = [], 0
    for part, rows in sizes:
        starts.append((part, total))
        total += rows
    parts = vectors.sparkSession.createDataFrame(starts, "part int, start long")
    joined = fit.join(F.broadcast(parts), "part")
    return joined.select("digest", "x", "copies", (F.col("start") + F.col("place")).alias("index"))


def _sums(fit: DataFrame, dimension: int) -> tuple[int, list[int], int]:
    """n, the exact sums, and a bound of every deviation."""
    entries = fit.select(F.posexplode("x").alias("place", "entry"))
    found = {
        row.place: row
        for row in entries.groupBy("place")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col("entry").cast("decimal(38,0)")).alias("total"),
            F.min("entry").alias("least"),
            F.max("entry").alias("most"),
        )
        .collect()
    }
    n = found[0].n
    sums = [int(found[k].total) for k in range(dimension)]
    bound = sum(
        max(abs(n * found[k].least - sums[k]), abs(n * found[k].most - sums[k])) ** 2
        for k in range(dimension)
    )
    return n, sums, bound


def _numbers(values, kind: str) -> Column:
    return F.array(*[F.lit(str(value)).cast(kind) for value in values])


def _deviation(n: int, sums: list[int], bound: int) -> Column:
    kind = "long" if bound < 2**62 else "decimal(38,0)"
    difference = F.zip_with(
        "x", _numbers(sums, kind), lambda entry, total: (entry * F.lit(n).cast(kind)) - total
    )
    total = F.aggregate(
        difference, F.lit(0).cast(kind), lambda held, one: (held + one * one).cast(kind)
    )
    return total.try_cast("long")


def _blocks(fit: DataFrame, n: int, sums: list[int]) -> BlockMatrix:
    """The centred rows, dealt to blocks by their index."""
    dimension = len(sums)
    means = F.array(*[F.lit(total / n) for total in sums])
    centred = F.zip_with("x", means, lambda entry, mean: entry.cast("double") - mean)
    rows = fit.select("index", array_to_vector(centred).alias("vector"))
    indexed = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(rows, "vector"), n, dimension)
    columns = min(dimension, BLOCK_COLUMNS)
    even = -(-n // (4 * fit.sparkSession.sparkContext.defaultParallelism))
    return indexed.toBlockMatrix(min(max(even, 256), BLOCK_BYTES // (8 * columns)), columns)


def _scatter(blocks: BlockMatrix) -> np.ndarray:
    """Transpose times matrix, cut along the rows (``multiply`` alone uses one task for each block of the result)."""
    bytes_ = blocks.rowsPerBlock * blocks.colsPerBlock * 8 * 2
    cuts = -(-blocks.numRowBlocks // max(TASK_BYTES // bytes_, 1))
    spark_cuts = min(blocks.numRowBlocks, max(cuts, blocks.blocks.getNumPartitions()))
    left, right = blocks.transpose()._java_matrix_wrapper, blocks._java_matrix_wrapper
    product = left._java_model.multiply(right._java_model, spark_cuts)
    return BlockMatrix(product, blocks.colsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def _components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whitening matrix, explained shares, and which components have variance."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    trace = float(np.trace(covariance))
    real = values > trace * len(covariance) * np.finfo(float).eps * 8
    scale = np.where(real, 1 / np.sqrt(np.where(real, values, 1.0)), 0.0)
    shares = np.where(real, values, 0.0) / (trace or 1.0)
    return vectors * scale, shares, real


def _projected(blocks: BlockMatrix, matrix: np.ndarray) -> DataFrame:
    """index and z of every row: the block product with the whitening matrix."""
    size, width = blocks.colsPerBlock, matrix.shape[1]
    spark = blocks.blocks.ctx
    pieces = [
        ((k // size, 0), DenseMatrix(len(part), width, part.ravel(order="F").tolist()))
        for k in range(0, len(matrix), size)
        for part in [matrix[k : k + size]]
    ]
    right = BlockMatrix(spark.parallelize(pieces, len(pieces)), size, width, *matrix.shape)
    rows = blocks.multiply(right).toIndexedRowMatrix()
    table = callMLlibFunc("getIndexedRows", rows._java_matrix_wrapper._java_model)
    return table.select("index", vector_to_array("vector").alias("z"))


def _identity_error(projected: DataFrame, real: np.ndarray) -> float:
    """Largest distance of the projected rows' covariance from the identity."""
    pairs = [(i, j) for i in range(len(real)) for j in range(i, len(real)) if real[i] and real[j]]
    if not pairs:
        return 0.0
    found = projected.agg(
        *[F.covar_pop(F.col("z")[i], F.col("z")[j]).alias(f"c{i}_{j}") for i, j in pairs]
    ).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened(
    embeddings: DataFrame, components: int = COMPONENTS, vector: str = "embedding"
) -> DataFrame:
    """Per row and component: n, deviation, whitened, explained, identity_error."""
    spark = embeddings.sparkSession
    id_type = embeddings.schema["vec_id"].dataType.simpleString()
    vectors = stored(integer_vectors(embeddings, vector), "vectors")
    first = vectors.select(F.size("x")).first()
    if first is None or first[0] == 0:
        return spark.createDataFrame([], RESULT.format(id_type))
    fit = distinct_vectors(vectors)
    n, sums, bound = _sums(fit, first[0])
    # Grouping rows to blocks is dear, and three products read the blocks.
    blocks = _blocks(fit, n, sums).persist(StorageLevel.MEMORY_AND_DISK)
    matrix, shares, real = _components(_scatter(blocks) / n, components)
    projected = stored(_projected(blocks, matrix), "projected")
    blocks._java_matrix_wrapper._java_model.blocks().unpersist(False)
    error = _identity_error(projected, real)

    known = fit.select("index", "digest", "copies", _deviation(n, sums, bound).alias("deviation"))
    values = stored(known.join(projected, "index").drop("index"), "whitened-vectors")
    heavy_bar = vectors.count() / HEAVY_SHARE
    heavy = values.filter(F.col("copies") > heavy_bar)
    rows = vectors.select("vec_id", "digest")
    split = rows.join(F.broadcast(heavy), "digest", "left")
    rare = split.filter(F.col("copies").isNull()).select("vec_id", "digest")
    joined = split.filter(F.col("copies").isNotNull()).unionByName(
        rare.join(values.filter(F.col("copies") <= heavy_bar), "digest")
    )
    each = joined.select("vec_id", "deviation", F.posexplode("z").alias("place", "whitened"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(float(share)) for share in shares])[F.col("place")].alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    ).to(T.StructType.fromDDL(RESULT.format(id_type)))
