"""Exact top-k over sparse vectors by impact-ordered postings and upper bounds.

Hashed texts have few numbers that are not zero, and a short query fewer.  A *term* is a
dimension with a sign; a row's *impact* on a term is the size of that number in its unit
vector.  Postings (term, id, impact) are laid out by *tier*, a band of impacts, so a query
reads the strongest rows of its terms and leaves the others where they are.

A number of the query's own sign adds to the score, one of the other sign only takes away,
so the lists of the query's signed terms bound the score from above.  A search has two steps:

1. The strongest cells (term and tier) of every query, about ``first * k`` postings, give
   candidates; their exact scores give each query a k-th score that the answer can not miss.
2. Cells are read in the order of what they can add, up to the point where all that is left
   unread adds up to less than that score.  A row stays a candidate while what was seen of it
   and what may be unread reach the score; the vectors of those rows decide.

Where to stop follows from one row per cell (at most 2 x dimensions x tiers), so both steps
are planned with windows over narrow rows and there is no loop.  A term that a third of all
rows share is cut by tier, its files are cut by id, and in the join its cells are salted.

The result is that of :func:`vecloom.operators.knn.knn_join`.  Queries that fewer than ``k``
rows answer with a score above zero, and those without a direction, are answered by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import vecloom.functions as V
from vecloom.functions import kernels
from vecloom.operators.graph import usable
from vecloom.operators.knn import DEFAULT_LIMITS, KnnLimits, knn_join, merge_best
from vecloom.sources.scratch import materialize, small_copy

TIERS, BANDS_PER_OCTAVE, BUCKETS, FIRST = 24, 4, 64, 4
# Postings of a cell that one task of a shuffled join takes.
_CELL_ROWS = 1_000_000
# Scores are rounded to nine decimals: what is further below than this can not tie.
_SLACK = 2e-9
_NAMED = 1_000


@dataclass(frozen=True)
class PostingIndex:
    """``postings`` by tier and term, ``cells`` with count and largest impact, ``vectors`` by bucket of id."""

    postings: DataFrame
    cells: DataFrame
    vectors: DataFrame
    buckets: int


def signed_terms(rows: DataFrame, vec: str, impact: str, *keep: str) -> DataFrame:
    """One row per number that is not zero: ``term`` (twice the position, plus one if negative) and its share."""
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    # The norm goes before the generator: beside it, it would be computed for every number.
    normed = rows.filter(usable(vec)).withColumn("_norm", norm)
    numbers = normed.select(*keep, "_norm", F.posexplode(vec).alias("_at", "_x")).filter("_x <> 0")
    term = 2 * F.col("_at") + (F.col("_x") < 0).cast("int")
    return numbers.select(*keep, term.alias("term"), (F.abs(F.col("_x").cast("double")) / F.col("_norm")).alias(impact))


def _tier(impact: Column) -> Column:
    return F.least(F.lit(TIERS - 1), F.floor(-F.log2(impact) * BANDS_PER_OCTAVE)).cast("int")


def _bucket(number: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(number), F.lit(buckets)).cast("int")


def build_postings(docs: DataFrame, path: str, *, id_col: str = "id", vec_col: str = "embedding", buckets: int = BUCKETS) -> None:
    """Write the vectors, their postings and one row per cell.  ``id_col`` names one row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).withColumn("bucket", _bucket(F.col("id"), buckets))
    # Ranges over (bucket, id) and (tier, term, id) cut a large bucket or list into several files.
    dealt = rows.repartitionByRange("bucket", "id").sortWithinPartitions("bucket", "id")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/vectors")
    stored = _read(spark, f"{path}/vectors", f"id {rows.schema['id'].dataType.simpleString()}, "
                   f"vec {rows.schema['vec'].dataType.simpleString()}, bucket int")
    postings = signed_terms(stored, "vec", "impact", "id").withColumn("tier", _tier(F.col("impact")))
    postings = postings.repartitionByRange("tier", "term", "id").sortWithinPartitions("tier", "term", "id")
    postings.write.mode("overwrite").partitionBy("tier").parquet(f"{path}/postings")
    written = _read(spark, f"{path}/postings", postings.select("id", "term", "impact", "tier").schema)
    cells = written.groupBy("term", "tier").agg(F.count(F.lit(1)).alias("n"), F.max("impact").alias("top"))
    cells.coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
    spark.createDataFrame([(buckets, stored.schema["id"].dataType.simpleString(), stored.schema["vec"].dataType.simpleString())],
                          "buckets int, id string, vec string").coalesce(1).write.mode("overwrite").json(f"{path}/index")


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    """A table with a given schema, as one without rows has no files to take it from."""
    return spark.read.schema(schema).parquet(path)


def load_postings(spark: SparkSession, path: str) -> PostingIndex:
    index = spark.read.schema("buckets int, id string, vec string").json(f"{path}/index").first()
    postings = _read(spark, f"{path}/postings", f"id {index['id']}, term int, impact double, tier int")
    cells = _read(spark, f"{path}/cells", "term int, tier int, n long, top double")
    return PostingIndex(postings, cells, _read(spark, f"{path}/vectors", f"id {index['id']}, vec {index['vec']}, bucket int"), index["buckets"])


def reading_order(asked: DataFrame, cells: DataFrame) -> DataFrame:
    """Every cell of each query's terms, with what it can add and what is left after it.

    Columns: q, term, tier, weight, n; ``next``, the most that the term's next tier adds; ``drop``, by how much reading the
    cell lowers the bound; ``before``, postings of earlier cells; ``left``, the most that a row can have unread afterwards.
    """
    levels = signed_terms(asked, "vec", "weight", "q").join(F.broadcast(cells), "term")
    levels = levels.withColumn("bound", F.col("weight") * F.col("top"))
    down = Window.partitionBy("q", "term").orderBy("tier")
    levels = levels.withColumn("next", F.lead("bound", 1, 0.0).over(down)).withColumn("drop", F.col("bound") - F.col("next"))
    whole = Window.partitionBy("q")
    order = whole.orderBy(F.desc("bound"), "term", "tier").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = levels.withColumn("before", F.sum("n").over(order) - F.col("n"))
    levels = levels.withColumn("left", F.sum("drop").over(whole) - F.sum("drop").over(order))
    return levels.select("q", "term", "tier", "weight", "n", "next", "drop", "before", "left")


def _postings_of(index: PostingIndex, wanted: DataFrame) -> DataFrame:
    """Postings of the wanted cells, a row per query that wants them; other tiers are not read."""
    needed = wanted.select("term", "tier").distinct().collect()  # bounded: 2 x dimensions x tiers
    tiers, terms = sorted({r["tier"] for r in needed}), sorted({r["term"] for r in needed})
    postings = index.postings.filter(F.col("tier").isin(tiers))
    if len(terms) <= _NAMED:
        postings = postings.filter(F.col("term").isin(terms))
    few = small_copy(wanted)
    if few is not None:
        return postings.join(few, ["term", "tier"])
    salts = F.ceil(F.col("n") / _CELL_ROWS).cast("int")
    salted = postings.join(F.broadcast(index.cells.select("term", "tier", salts.alias("_salts"))), ["term", "tier"])
    salted = salted.withColumn("_salt", F.pmod(F.xxhash64("id"), F.col("_salts")).cast("int")).drop("_salts")
    copies = wanted.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted.join(copies, ["term", "tier", "_salt"]).drop("_salt")


def _exact(found: DataFrame, asked: DataFrame, index: PostingIndex) -> DataFrame:
    """The rounded cosine of (q, id) rows; few of them name the buckets to read."""
    found = found.withColumn("bucket", _bucket(F.col("id"), index.buckets))
    vectors, few = index.vectors, small_copy(found)
    if few is not None:
        vectors = vectors.filter(F.col("bucket").isin(sorted(r[0] for r in few.select("bucket").distinct().collect())))
        found = few
    both = found.join(vectors.select("bucket", "id", F.col("vec").alias("doc_vec")), ["bucket", "id"]).join(asked, "q")
    score = F.round(V.cosine_similarity("vec", "doc_vec", out="double"), kernels.SCORE_DIGITS)
    return both.select("q", "id", score.alias("score"))


def plan_reads(asked: DataFrame, index: PostingIndex, k: int, first: int = FIRST) -> DataFrame:
    """The cells that each (q, vec) has to read, with its k-th score found so far (``least``).

    Adds ``rest``, the most that a row may have in the unread tiers of the term, and ``unread``, the same over all terms.
    A query without ``k`` rows above zero among its first candidates reads all its cells, with ``least`` zero.
    """
    levels = materialize(reading_order(asked, index.cells), "posting-levels")
    early = materialize(levels.filter(F.col("before") < first * k).select("q", "term", "tier", "weight", "n"), "posting-first")
    seen = _postings_of(index, early).groupBy("q", "id").agg(F.sum(F.col("weight") * F.col("impact")).alias("score"))
    sample = materialize(merge_best(seen, 2 * k).select("q", "id"), "posting-sample")
    reached = merge_best(_exact(sample, asked, index), k).filter(F.col("rank") == k).select("q", F.col("score").alias("least"))
    known = levels.join(reached, "q", "left").withColumn("least", F.greatest(F.coalesce("least", F.lit(0.0)), F.lit(0.0)))
    kept = known.filter(F.col("left") + F.col("drop") >= F.col("least") - _SLACK)
    rest, unread = F.min("next").over(Window.partitionBy("q", "term")), F.min("left").over(Window.partitionBy("q"))
    kept = kept.withColumn("rest", rest).withColumn("unread", unread)
    return materialize(kept.select("q", "term", "tier", "weight", "n", "rest", "unread", "least"), "posting-plan")


def share_read(plan: DataFrame, asked: DataFrame, index: PostingIndex) -> DataFrame:
    """Per query: postings read, postings in the lists of its terms, postings in the index (one row each)."""
    lists = index.cells.groupBy("term").agg(F.sum("n").alias("n"))
    listed = signed_terms(asked, "vec", "weight", "q").join(F.broadcast(lists), "term").groupBy("q").agg(F.sum("n").alias("listed"))
    total = index.cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("indexed"))  # one row
    return plan.groupBy("q").agg(F.sum("n").alias("read")).join(listed, "q").join(F.broadcast(total))


def candidates(plan: DataFrame, index: PostingIndex) -> DataFrame:
    """Rows (q, id) that what was read does not rule out."""
    over = F.col("weight") * F.col("impact") - F.col("rest")
    limits = F.first("unread").alias("unread"), F.first("least").alias("least")
    summed = _postings_of(index, plan).groupBy("q", "id").agg(F.sum(over).alias("over"), *limits)
    return summed.filter(F.col("over") + F.col("unread") >= F.col("least") - _SLACK).select("q", "id")


def postings_search(queries: DataFrame, index: PostingIndex, k: int, *, query_id: str = "q", vec_col: str = "embedding",
                    first: int = FIRST, limits: KnnLimits = DEFAULT_LIMITS) -> DataFrame:
    """The ``k`` most similar rows of every query: q, id, score, rank.  Ids name one row on either side."""
    if k < 1 or first < 1:
        raise ValueError("k and first must be at least 1")
    asked = materialize(queries.select(F.col(query_id).alias("q"), F.col(vec_col).alias("vec")), "posting-queries")
    plan = plan_reads(asked, index, k, first)
    found = materialize(candidates(plan, index), "posting-candidates")
    best = materialize(merge_best(_exact(found, asked, index).filter("score > 0"), k), "posting-best")
    settled = best.groupBy("q").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == k).select("q")
    best = best.join(settled, "q", "left_semi").select("q", "id", "score", "rank")
    open_queries = materialize(asked.join(settled, "q", "left_anti"), "posting-open")
    if open_queries.isEmpty():
        return best
    docs = index.vectors.select("id", "vec")
    whole = knn_join(open_queries, docs, k, query_id="q", doc_id="id", vec_col="vec", limits=limits)
    return best.unionByName(whole.select("q", "id", "score", "rank"))
