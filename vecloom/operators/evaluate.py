"""Retrieval quality: where does the expected document land for each query?"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.functions import kernels
from vecloom.functions.vectors import cosine_similarity
from vecloom.operators.knn import DEFAULT_LIMITS, KnnLimits, _column, _query_matrix, passes, row_ids, small_side
from vecloom.operators.search import guarded_vector, query_model
from vecloom.sources.scratch import materialize


def _expected_scores(queries: DataFrame, docs: DataFrame) -> DataFrame:
    """Keep queries whose expected document exists, with its score."""
    target = docs.select(F.col("id").alias("expect"), F.col("vec").alias("target"))
    score = F.round(cosine_similarity("vec", "target", out="double"), kernels.SCORE_DIGITS)
    return target.join(queries, "expect").select("q", "expect", "vec", score.alias("expect_score"))


def _count_block(table: pa.Table, batches):
    """Per-query counters of a query block over a stream of document batches."""
    matrix, q_known = _query_matrix(table, "vec")
    expect = row_ids(_column(table, "expect"))
    score = _column(table, "expect_score").to_numpy(zero_copy_only=False).astype(np.float64)
    ahead, wrong = np.zeros(len(matrix), dtype=np.int64), np.full(len(matrix), -np.inf)
    for batch in (piece for batch in batches for piece in kernels.pieces(batch, "vec")):
        vectors = batch.column("vec")
        docs, known, _ = kernels.pack(vectors, matrix.shape[1])
        column = batch.column("id")
        ids = row_ids(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)
        kernels.count_ahead(matrix, expect, score, kernels.unit_rows(docs), ids, known, ahead, wrong)
    # A query without a vector scores NULL everywhere: ids alone order it.
    hidden = np.isneginf(wrong) | ~q_known
    return pa.table({
        "q": _column(table, "q"),
        "ahead": pa.array(ahead),
        "wrong": pa.array(wrong, mask=hidden),
    })


def evaluate(queries: DataFrame, docs: DataFrame, *, query_id: str = "q", expect_col: str = "expect",
             doc_id: str = "id", vec_col: str = "embedding", limits: KnnLimits = DEFAULT_LIMITS) -> DataFrame:
    """Rank, score and margin of the expected document of every query.

    Columns: query, expected_doc, rank_of_expected, score, margin_over_best_wrong
    (score minus the best score of any other document).  A rank only needs the
    number of documents ahead, so a task reduces its documents to two numbers
    per query; the pairs are never listed.  Queries whose expected document is
    absent drop out.
    """
    q = queries.select(F.col(query_id).alias("q"), F.col(expect_col).alias("expect"), F.col(vec_col).alias("vec"))
    q = q.filter(F.col("vec").isNotNull())
    d = docs.select(F.col(doc_id).alias("id"), guarded_vector(docs, vec_col, query_model(queries, docs)).alias("vec"))
    schema = f"q {q.schema['q'].dataType.simpleString()}, ahead long, wrong double"
    table = small_side(q, "q", "vec", limits)
    slices = None if table is not None else passes(q, "q", "vec", limits)
    if table is not None or slices is not None:
        # Measured slices of the queries go to the documents, which stay where they are.
        tables = [table] if table is not None else [s.toArrow().combine_chunks() for s in slices]
        counted = [_count_pass(t, q.schema, d, schema) for t in tables]
        partials = reduce(DataFrame.unionByName, (c[0] for c in counted))
        named = reduce(DataFrame.unionByName, (c[1] for c in counted))
    else:
        # Counted, sent to the blocks and joined with the totals: written once.
        asked = materialize(_expected_scores(q, d), "expected_scores")
        partials = _grid_counts(asked, d, schema, limits)
        named = asked.select("q", "expect", "expect_score")
    totals = partials.groupBy("q").agg(F.sum("ahead").alias("ahead"), F.max("wrong").alias("wrong"))
    return named.join(totals, "q").select(
        F.col("q").alias("query"),
        F.col("expect").alias("expected_doc"),
        (F.col("ahead") + 1).alias("rank_of_expected"),
        F.col("expect_score").alias("score"),
        (F.col("expect_score") - F.col("wrong")).alias("margin_over_best_wrong"),
    )


def _count_pass(table: pa.Table, q_schema, docs: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """Counters of one slice of queries, and its rows with their expected scores."""
    spark = docs.sparkSession
    asked = _expected_scores(F.broadcast(spark.createDataFrame(table, q_schema)), docs).toArrow().combine_chunks()
    shared = spark.sparkContext.broadcast(asked)

    def count(batches):
        if shared.value.num_rows:
            yield from _count_block(shared.value, batches).to_batches()

    return docs.mapInArrow(count, schema), spark.createDataFrame(asked.select(["q", "expect", "expect_score"]))


def rank_of(queries: DataFrame, judged: DataFrame, docs: DataFrame, *, query_id: str = "q", doc_id: str = "id",
            vec_col: str = "embedding", limits: KnnLimits = DEFAULT_LIMITS) -> DataFrame:
    """Rank, score and margin of given (query, document) pairs: q, id, rank, score, margin.

    ``judged`` has the id columns of both sides and may name several documents per
    query.  The pairs are counted, not listed: nothing else of the ranking is made.
    """
    asked = judged.select(query_id, F.col(doc_id).alias("expect")).join(queries, query_id)
    pairs = asked.withColumn("pair", F.struct(F.col(query_id).alias("q"), F.col("expect").alias("id")))
    found = evaluate(pairs, docs, query_id="pair", doc_id=doc_id, vec_col=vec_col, limits=limits)
    return found.select(
        "query.q", "query.id", F.col("rank_of_expected").alias("rank"), "score", F.col("margin_over_best_wrong").alias("margin")
    )


def _grid_counts(asked: DataFrame, docs: DataFrame, schema: str, limits: KnnLimits) -> DataFrame:
    """Both sides large: bounded hash blocks meet in a grid, once each."""
    q_blocks = max(1, -(-asked.count() // limits.query_block))
    d_blocks = max(1, -(-docs.count() // limits.doc_block))

    def blocks(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = asked.withColumn("qb", F.pmod(F.xxhash64("q"), F.lit(q_blocks)).cast("int")).withColumn("db", blocks(d_blocks))
    right = docs.withColumn("db", F.pmod(F.xxhash64("id"), F.lit(d_blocks)).cast("int")).withColumn("qb", blocks(q_blocks))

    def meet(block: pa.Table, against: pa.Table) -> pa.Table:
        if block.num_rows == 0:
            none = pa.array([], pa.null())
            return pa.table({"q": none.cast(block.schema.field("q").type), "ahead": none.cast(pa.int64()),
                             "wrong": none.cast(pa.float64())})
        return _count_block(block.combine_chunks(), [against])

    return left.groupBy("qb", "db").cogroup(right.groupBy("qb", "db")).applyInArrow(meet, schema)


def report(evaluated: DataFrame) -> DataFrame:
    """Per-query report: four decimals, best ranks first."""
    return evaluated.select(
        "query",
        "expected_doc",
        "rank_of_expected",
        F.round("score", 4).alias("score"),
        F.round("margin_over_best_wrong", 4).alias("margin_over_best_wrong"),
    ).orderBy("rank_of_expected", "query")


def summarize(evaluated: DataFrame, model: str) -> DataFrame:
    """One row: queries, top1_hits, top1_accuracy, mrr, mean_rank."""
    first = (F.col("rank_of_expected") == 1).cast("int")
    return evaluated.agg(
        F.count(F.lit(1)).alias("queries"),
        F.sum(first).alias("top1_hits"),
        F.round(F.avg(first), 4).alias("top1_accuracy"),
        F.round(F.avg(F.lit(1.0).cast("double") / F.col("rank_of_expected")), 4).alias("mrr"),
        F.round(F.avg("rank_of_expected"), 3).alias("mean_rank"),
    ).select(F.lit(model).alias("model"), "*")


def compare_models(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two evaluations side by side, one row per query of either.

    ``rank_delta`` and ``score_delta`` are after minus before, NULL where one
    side lacks the query.
    """
    a = before.select("query", F.col("rank_of_expected").alias("rank_a"), F.col("score").alias("score_a"))
    b = after.select("query", F.col("rank_of_expected").alias("rank_b"), F.col("score").alias("score_b"))
    return a.join(b, "query", "full").select(
        "query",
        "rank_a",
        "rank_b",
        (F.col("rank_b") - F.col("rank_a")).alias("rank_delta"),
        "score_a",
        "score_b",
        (F.col("score_b") - F.col("score_a")).alias("score_delta"),
    )


def compare_summaries(before: DataFrame, after: DataFrame) -> DataFrame:
    """Summary rows of two models, and the change of each measure."""
    measures = ["queries", "top1_hits", "top1_accuracy", "mrr", "mean_rank"]
    rows = before.select(F.lit("a").alias("_side"), "model", *measures).unionByName(
        after.select(F.lit("b").alias("_side"), "model", *measures)
    )

    def side(name: str, column: str):
        return F.max(F.when(F.col("_side") == name, F.col(column)))

    return rows.agg(
        side("a", "model").alias("model_a"),
        side("b", "model").alias("model_b"),
        *[F.round(side("b", m) - side("a", m), 4).alias(f"{m}_delta") for m in measures],
    )
