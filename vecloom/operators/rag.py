"""Passage retrieval over chunks, with or without their neighbours.

Chunks that are asked more than once are stored by :func:`store_chunks`: encoded once,
bucketed by parent and sorted by position, so that joining hits to their neighbours moves
the hits and never the chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.functions.encoders import HASHING, EncoderSpec, compose_text, embed_encode
from vecloom.operators.knn import DEFAULT_LIMITS, KnnLimits, knn_join
from vecloom.operators.search import search_distance

# Hits carry ids, a title and a score: a few MB at this many.
_BROADCAST_HITS = 10_000


def embed_chunks(chunks: DataFrame, spec: EncoderSpec = HASHING) -> DataFrame:
    """Add the vector of title and content, with the encoder that made it."""
    text = compose_text("title", "content", required=(1,))
    return chunks.withColumn("embedding", embed_encode(text, spec)).withColumn("model", F.lit(spec.name))


def store_chunks(embedded: DataFrame, table: str, path: str, *, buckets: int = 64) -> DataFrame:
    """Write embedded chunks as a table of the session's catalog, with its files under ``path``, and return it.

    ``buckets`` is fixed for the table's life.  Where the input has many partitions or the session shuffles to more, a
    bucket is several files, each sorted by a task of its own, so that a task's share does not grow with the table.
    """
    wanted = max(int(embedded.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * embedded.rdd.getNumPartitions())
    # A multiple of the buckets: rows of one partition lie in one bucket.
    dealt = embedded.repartition(buckets * max(1, -(-wanted // buckets)), "parent_id")
    writer = dealt.write.mode("overwrite").bucketBy(buckets, "parent_id").sortBy("parent_id", "chunk_index")
    writer.option("path", path).saveAsTable(table)
    return embedded.sparkSession.table(table)


def drop_chunks(spark: SparkSession, table: str) -> None:
    """Forget a stored table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def rag_batch_with_context(chunks: DataFrame, queries: DataFrame, context_window: int = 1, limit_count: int = 3, *,
                           query_id: str = "q", vec_col: str = "embedding", limits: KnnLimits = DEFAULT_LIMITS) -> DataFrame:
    """The nearest chunks of every encoded query, each with its neighbours joined in order.

    The hits, ``limit_count`` a query, are joined to the chunks by parent: a stored table stays where it is.  A hit
    without a position has no neighbours and keeps NULL content, as in :func:`rag_search_with_context`.
    """
    if context_window < 0:
        raise ValueError("context_window must not be negative")
    own = chunks.filter(F.col("parent_id").isNotNull())
    hits = knn_join(queries, own, limit_count, query_id=query_id, doc_id="id", vec_col=vec_col, limits=limits)
    # Where the hits lie: an id names one chunk, so this join is by narrow rows.
    placed = hits.join(own.select("id", "title", "source", "parent_id", "chunk_index"), "id")
    placed = placed.select("q", F.col("id").alias("chunk_id"), "title", "source", F.col("parent_id").alias("hit_parent"),
                           F.col("chunk_index").alias("hit_index"), F.col("score").alias("similarity"), "rank")
    near = F.col("chunk_index").between(F.col("hit_index") - context_window, F.col("hit_index") + context_window)
    itself = F.col("id") == F.col("chunk_id")
    context = own.select("id", "parent_id", "chunk_index", "content")
    joined = context.join(placed, (F.col("parent_id") == F.col("hit_parent")) & (near | itself))
    pieces = joined.withColumn("piece", F.when(near, F.col("content")))
    return pieces.groupBy("q", "rank", "chunk_id", "title", "source", "similarity").agg(
        F.expr("listagg(piece, ' ') WITHIN GROUP (ORDER BY chunk_index)").alias("combined_content")
    )


def rag_search(chunks: DataFrame, query, limit_count: int = 5, *, spec: EncoderSpec = HASHING,
               columns: Sequence[str] = ("id", "title", "content", "source")) -> DataFrame:
    """The chunks nearest to the query.  Rows without a parent are not chunks."""
    return search_distance(chunks, query, limit_count, spec=spec, columns=columns,
                           where=F.col("parent_id").isNotNull())


def rag_search_with_context(chunks: DataFrame, query, context_window: int = 1, limit_count: int = 3, *,
                            spec: EncoderSpec = HASHING) -> DataFrame:
    """The nearest chunks, each with its neighbours joined in order.

    The hits are at most ``limit_count`` rows, so up to a bounded number they go
    to the chunks and not the other way: one broadcast, no shuffle of the chunk
    table; beyond it Spark joins on the parent as it sees fit.  A hit always
    meets itself, which keeps hits whose ``chunk_index`` is NULL.
    """
    if context_window < 0:
        raise ValueError("context_window must not be negative")
    hits = search_distance(chunks, query, limit_count, spec=spec, where=F.col("parent_id").isNotNull(),
                           columns=["id", "title", "source", "parent_id", "chunk_index"])
    hits = hits.select(F.col("id").alias("chunk_id"), "title", "source", F.col("parent_id").alias("hit_parent"),
                       F.col("chunk_index").alias("hit_index"), "similarity")
    if limit_count <= _BROADCAST_HITS:
        hits = F.broadcast(hits)
    context = chunks.select("id", "parent_id", "chunk_index", "content")
    near = F.col("chunk_index").between(F.col("hit_index") - context_window, F.col("hit_index") + context_window)
    own = F.col("id") == F.col("chunk_id")
    joined = context.join(hits, (F.col("parent_id") == F.col("hit_parent")) & (near | own))
    pieces = joined.withColumn("piece", F.when(near, F.col("content")))
    return (
        pieces.groupBy("chunk_id", "title", "source", "similarity")
        .agg(F.expr("listagg(piece, ' ') WITHIN GROUP (ORDER BY chunk_index)").alias("combined_content"))
        .select("chunk_id", "title", "combined_content", "source", "similarity")
        .orderBy(F.desc_nulls_last(F.nanvl("similarity", F.lit(None).cast("double"))), F.asc("chunk_id"))
    )
