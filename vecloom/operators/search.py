"""Top-k, threshold, filtered and distance-ordered search for one query.

The query is a single vector fixed before the plan is built, so nothing is
joined: each task scores its rows with one matrix-vector product per Arrow batch
and keeps its own best ``k``, and only those meet on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.functions import kernels
from vecloom.functions.encoders import HASHING, EncoderSpec, embed_query


def query_vector(spark: SparkSession, query, spec: EncoderSpec = HASHING, vec_col: str = "embedding") -> np.ndarray:
    """Turn a text, a sequence of numbers or a one-row DataFrame into a vector."""
    if isinstance(query, str):
        query = spark.range(1).select(embed_query(F.lit(query), spec).alias(vec_col))
    if isinstance(query, DataFrame):
        rows = query.select(vec_col).limit(2).collect()
        if len(rows) != 1:
            raise ValueError("the query DataFrame must have exactly one row")
        query = rows[0][0]
    if query is None or any(x is None for x in query):
        raise ValueError("the query vector is NULL or holds a NULL")
    return np.asarray(query, dtype=np.float64)


def guarded_vector(docs: DataFrame, vec_col: str, model: str | None) -> Column:
    """The vector column, refusing rows that another encoder than ``model`` wrote."""
    vec = F.col(vec_col)
    if model is None or "model" not in docs.columns:
        return vec
    message = F.concat(F.lit(f"vector of model {model} compared with one of "), F.coalesce(F.col("model"), F.lit("NULL")))
    refused = F.raise_error(message).cast("array<float>")
    return F.when(vec.isNull() | F.col("model").eqNullSafe(F.lit(model)), vec).otherwise(refused)


def query_model(queries: DataFrame, docs: DataFrame) -> str | None:
    """The one model of a query table, where both sides name theirs."""
    if "model" not in queries.columns or "model" not in docs.columns:
        return None
    models = [r[0] for r in queries.select("model").distinct().limit(2).collect()]
    if len(models) > 1:
        raise ValueError("the queries were encoded with several models")
    return models[0] if models else None


def with_score(docs: DataFrame, query, vec_col: str = "embedding", score_col: str = "score",
               spec: EncoderSpec | None = None, pinned: bool = False) -> DataFrame:
    """Add the cosine similarity of every row with the query (double).

    A later filter on the score would be pushed below the projection and so
    score the rows twice; ``pinned`` keeps it above.
    """
    q = query_vector(docs.sparkSession, query, spec or HASHING, vec_col)

    @F.arrow_udf(T.DoubleType())
    def cosine(batch: pa.Array) -> pa.Array:
        return kernels.cosine_scores(batch, q)

    if pinned:
        cosine = cosine.asNondeterministic()
    return docs.withColumn(score_col, cosine(guarded_vector(docs, vec_col, spec and spec.name)))


def with_distance(docs: DataFrame, query, vec_col: str = "embedding", distance_col: str = "distance",
                  spec: EncoderSpec | None = None) -> DataFrame:
    """Add the cosine distance of every row: NaN for zero vectors."""
    q = query_vector(docs.sparkSession, query, spec or HASHING, vec_col)

    @F.arrow_udf(T.DoubleType())
    def distance(batch: pa.Array) -> pa.Array:
        return kernels.cosine_distances(batch, q)

    return docs.withColumn(distance_col, distance(guarded_vector(docs, vec_col, spec and spec.name)))


def _columns(docs: DataFrame, columns: Sequence[str] | None, vec_col: str) -> list[str]:
    return list(columns) if columns is not None else [c for c in docs.columns if c != vec_col]


def _check_limit(k: int) -> int:
    if k < 0:
        raise ValueError("k must not be negative")
    return k


def search_topk(docs: DataFrame, query, k: int = 5, *, id_col: str = "id", vec_col: str = "embedding",
                columns: Sequence[str] | None = None, where: Column | str | None = None,
                spec: EncoderSpec | None = None, score_col: str = "score", nulls: str = "last") -> DataFrame:
    """The ``k`` rows most similar to the query, best first.

    ``where`` filters before scoring and reaches the scan.  Rows without a
    vector come last; ``nulls="reference"`` puts them first, as a descending
    sort does in databases that treat NULL as the largest value.
    """
    if nulls not in ("last", "reference"):
        raise ValueError("nulls must be 'last' or 'reference'")
    kept = _columns(docs, columns, vec_col)
    rows = docs if where is None else docs.filter(where)
    scored = with_score(rows, query, vec_col, score_col, spec).select(*kept, score_col)
    best = F.desc_nulls_last(score_col) if nulls == "last" else F.desc_nulls_first(score_col)
    return scored.orderBy(best, F.asc(id_col)).limit(_check_limit(k))


def search_threshold(docs: DataFrame, query, threshold: float = 0.7, *, id_col: str = "id", vec_col: str = "embedding",
                     columns: Sequence[str] | None = None, where: Column | str | None = None,
                     spec: EncoderSpec | None = None, score_col: str = "score") -> DataFrame:
    """Every row scoring above ``threshold``, best first, without a limit."""
    kept = _columns(docs, columns, vec_col)
    rows = docs if where is None else docs.filter(where)
    scored = with_score(rows, query, vec_col, score_col, spec, pinned=True).select(*kept, score_col)
    return scored.filter(F.col(score_col) > threshold).orderBy(F.desc(score_col), F.asc(id_col))


def search_distance(docs: DataFrame, query, k: int = 5, *, id_col: str = "id", vec_col: str = "embedding",
                    columns: Sequence[str] | None = None, where: Column | str | None = None,
                    spec: EncoderSpec | None = None, score_col: str = "similarity") -> DataFrame:
    """The ``k`` nearest rows by cosine distance, reported as ``1 - distance``."""
    kept = _columns(docs, columns, vec_col)
    rows = docs if where is None else docs.filter(where)
    near = (
        with_distance(rows, query, vec_col, "_distance", spec)
        .select(*kept, "_distance")
        .orderBy(F.asc_nulls_last("_distance"), F.asc(id_col))
        .limit(_check_limit(k))
    )
    similarity = F.round(F.lit(1.0) - F.col("_distance"), kernels.SCORE_DIGITS)
    return near.select(*kept, similarity.alias(score_col))


def search_products(products: DataFrame, query: str, limit_count: int = 5, spec: EncoderSpec = HASHING) -> DataFrame:
    """Products most similar to a text: id, name, description, price, similarity."""
    return search_topk(products, query, limit_count, spec=spec, score_col="similarity",
                       columns=["id", "name", "description", "price"])


def search_products_by_category(products: DataFrame, query: str, category: str, limit_count: int = 5,
                                spec: EncoderSpec = HASHING) -> DataFrame:
    """The same within one category: id, name, price, similarity."""
    return search_topk(products, query, limit_count, spec=spec, score_col="similarity",
                       columns=["id", "name", "price"], where=F.col("category") == category)
