"""Approximate nearest neighbours as two Spark jobs: IVF cells and LSH buckets.

Both put documents and queries into cells and hand them to the exact cell join,
so every candidate is scored exactly and only the choice of candidates is
approximate.  Cells of any size are split there; nothing is capped.

Zero vectors have no direction: IVF keeps them in a cell of their own that every
query probes.  Vectors that are NULL or hold a NULL take no part, as in the
exact join.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.functions import kernels
from vecloom.operators.knn import DEFAULT_LIMITS, KnnLimits, cell_topk
from vecloom.operators.search import guarded_vector, query_model

ZERO_CELL = -1
# Buckets of LSH: hash tables, and projections whose signs make up one bucket key.
TABLES, PROJECTIONS = 12, 6


def _whole(vec_col: str) -> Column:
    """Present and without NULL elements."""
    return F.coalesce(F.col(vec_col).isNotNull() & ~F.exists(vec_col, lambda x: x.isNull()), F.lit(False))


def fit_centroids(docs: DataFrame, cells: int, *, vec_col: str = "embedding", sample_rows: int | None = None,
                  seed: int = 42, max_iter: int = 10) -> np.ndarray:
    """K-means centroids of all rows that have a direction.

    ``sample_rows`` fits on about that many of them instead; either way every
    document is assigned later.
    """
    vectors = docs.select(vec_col).filter(_whole(vec_col) & F.exists(vec_col, lambda x: x != 0))
    if sample_rows is not None:
        vectors = vectors.sample(fraction=min(1.0, sample_rows / max(1, vectors.count())), seed=seed)
    points = vectors.select(array_to_vector(F.col(vec_col).cast("array<double>")).alias("features"))
    model = KMeans(k=cells, seed=seed, maxIter=max_iter, distanceMeasure="cosine").fit(points)
    return np.array(model.clusterCenters())


def nearest_cells(vec, centroids: np.ndarray, probes: int = 1) -> Column:
    """The ``probes`` nearest cells of a vector, nearest first (array of int); ``ZERO_CELL`` alone for a zero vector.

    The centroids reach the tasks once each, as a broadcast.
    """
    unit = kernels.unit_rows(np.asarray(centroids, dtype=np.float64))
    probes = min(probes, len(unit))
    shared = SparkSession.active().sparkContext.broadcast(unit)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def nearest(batch: pa.Array) -> pa.Array:
        unit = shared.value
        matrix, present, _ = kernels.pack(batch, unit.shape[1])
        order = kernels.nearest(kernels.unit_rows(matrix), unit, probes).astype(np.int32)
        zero = ~matrix.any(axis=1)
        order[zero] = ZERO_CELL
        sizes = np.where(zero, 1, probes)
        kept = order.ravel()[(np.arange(probes)[None, :] < sizes[:, None]).ravel()]
        rows = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(kept))
        return pc.if_else(pa.array(present), rows, pa.scalar(None, rows.type))

    return nearest(vec if isinstance(vec, Column) else F.col(vec))


def build_ivf(docs: DataFrame, path: str, cells: int | None = None, *, centroids: np.ndarray | None = None,
              vec_col: str = "embedding", **fit) -> np.ndarray:
    """Write documents partitioned by cell under ``path`` and return centroids, fitted unless given.

    The rebalance hint lets AQE split the rows of a cell that holds much of the
    table over many tasks and files.
    """
    if centroids is None:
        centroids = fit_centroids(docs, cells, vec_col=vec_col, **fit)
    spark = docs.sparkSession
    assigned = docs.filter(_whole(vec_col)).withColumn("cell", F.get(nearest_cells(vec_col, centroids), F.lit(0)))
    assigned.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/docs")
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centroids)]
    spark.createDataFrame(rows, "cell int, centroid array<double>").write.mode("overwrite").parquet(f"{path}/centroids")
    return centroids


def load_ivf(spark: SparkSession, path: str) -> tuple[DataFrame, np.ndarray]:
    """Documents and centroids written by :func:`build_ivf`."""
    rows = spark.read.parquet(f"{path}/centroids").orderBy("cell").collect()
    return spark.read.parquet(f"{path}/docs"), np.array([r["centroid"] for r in rows])


def ivf_search(queries: DataFrame, index: DataFrame, centroids: np.ndarray, k: int, probes: int, *, query_id: str = "q",
               doc_id: str = "id", vec_col: str = "embedding", limits: KnnLimits = DEFAULT_LIMITS) -> DataFrame:
    """Top ``k`` among the ``probes`` nearest cells; exact if all are probed.

    A zero query has no nearest cells and so probes them all.
    """
    cells = nearest_cells(vec_col, centroids, probes)
    everywhere = F.sequence(F.lit(0), F.lit(len(centroids) - 1))
    named = F.when(F.array_contains("_cells", ZERO_CELL), everywhere).otherwise(F.col("_cells"))
    q = queries.filter(_whole(vec_col)).select(F.col(query_id).alias("q"), F.col(vec_col).alias("vec"), cells.alias("_cells"))
    q = q.select("q", F.explode(F.concat(named, F.array(F.lit(ZERO_CELL)))).alias("cell"), "vec")
    vec = guarded_vector(index, vec_col, query_model(queries, index))
    d = index.select("cell", F.col(doc_id).alias("id"), vec.alias("vec"))
    return cell_topk(q, d, k, limits)


@lru_cache
def projections(dim: int, tables: int, per_table: int) -> np.ndarray:
    """Signs of all projections, ``dim`` x (``tables`` x ``per_table``).

    Each sign comes from the first hexadecimal digit of md5("table:projection:dimension"), so that any engine can
    repeat them.
    """
    names = (f"{t}:{p}:{d}" for d in range(dim) for t in range(tables) for p in range(per_table))
    low = [hashlib.md5(n.encode(), usedforsecurity=False).hexdigest()[0] < "8" for n in names]
    return np.where(np.array(low), 1.0, -1.0).reshape(dim, tables * per_table)


def lsh_buckets(vec, tables: int = TABLES, per_table: int = PROJECTIONS) -> Column:
    """One bucket per table: the table's number and the signs of its projections, as one int."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def bucketed(batch: pa.Array) -> pa.Array:
        lengths = pc.max(pc.list_value_length(batch)).as_py() or 1
        matrix, present, _ = kernels.pack(batch, lengths)
        signs = (matrix @ projections(lengths, tables, per_table) > 0).reshape(len(matrix), tables, per_table)
        keys = signs @ (1 << np.arange(per_table)) + (np.arange(tables) << per_table)
        ends = pa.array((np.arange(len(keys) + 1) * tables).astype(np.int32))
        rows = pa.ListArray.from_arrays(ends, pa.array(keys.ravel().astype(np.int32)))
        return pc.if_else(pa.array(present), rows, pa.scalar(None, rows.type))

    return bucketed(vec if isinstance(vec, Column) else F.col(vec))


def lsh_search(queries: DataFrame, docs: DataFrame, k: int, *, tables: int = TABLES, per_table: int = PROJECTIONS,
               query_id: str = "q", doc_id: str = "id", vec_col: str = "embedding",
               limits: KnnLimits = KnnLimits(broadcast_bytes=64 << 20)) -> DataFrame:
    """Top ``k`` among documents that share a bucket with the query in some table.

    A vector at angle ``a`` shares one table's bucket with probability
    ``(1 - a / pi) ** per_table``: more projections make smaller buckets, more
    tables find more of the neighbours.
    """

    def prepared(df: DataFrame, id_col: str, name: str, vec: Column) -> DataFrame:
        rows = df.filter(_whole(vec_col)).select(F.col(id_col).alias(name), vec.alias("vec"))
        return rows.select(name, F.explode(lsh_buckets("vec", tables, per_table)).alias("cell"), "vec")

    own = guarded_vector(docs, vec_col, query_model(queries, docs))
    q, d = prepared(queries, query_id, "q", F.col(vec_col)), prepared(docs, doc_id, "id", own)
    return cell_topk(q, d, k, limits, copies=tables)
