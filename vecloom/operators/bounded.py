"""Exact k-nearest-neighbour join of two large sides that skips blocks by bounds.

Unit vectors lie in a metric space, with distance ``sqrt(2 - 2 cosine)``.  Both sides are
dealt to the cells of pivots fitted on the documents, and cells to blocks of bounded size.  A
document block knows its covering radius, the largest distance of a row from its pivot; a
query block knows how near its rows come to every pivot.  No document of a block can be
nearer to a query than the query's distance to the pivot less the radius, which bounds the
score from above.

Block pairs are joined in passes, best bound first, twice as many each pass.  After a pass
every query knows the score of its k-th answer so far, and a block pair is dropped for good
once its bound is below the lowest of these in the query block.  In a pair that is joined,
queries whose own bound is too low are left out.  Blocks travel in groups, so that a row moves once
for all the pairs of its block with a group on the other side.  Passes end when no pair is left, so the
result is that of :func:`vecloom.operators.knn.knn_join`, ties included.

Rows only move between tasks: neither side, nor its blocks' rows, pass through the driver,
which sees counts and the pivots.  Equal queries are asked once; of equal documents the
``k`` lowest ids take part, as no other can be an answer.  Documents without a direction
(zero, or of another length) score zero and have a block without pivot; a zero query's
answers are the lowest ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecloom.functions import kernels
from vecloom.operators.ann import fit_centroids
from vecloom.operators.knn import emit_rows, merge_best, row_ids, vector_signature
from vecloom.operators.search import guarded_vector, query_model
from vecloom.sources.scratch import materialize

_MAX_PIVOTS = 1024
# Scores are rounded to nine decimals, and bounds go through square roots.
_SLACK = 1e-7
_NO_PIVOT = -1
# Blocks that travel together: numbers of their vectors, and places that fit the bits of a long.
_GROUP_ELEMENTS, _PLACES = 4_000_000, 62


@dataclass(frozen=True)
class BoundSpec:
    """Rows per block on either side, rows to fit pivots on, and block pairs per query block in the first pass."""

    query_block: int = 8_192
    doc_block: int = 8_192
    pivots: int | None = None
    fit_rows: int = 200_000
    first: int = 2


@dataclass(frozen=True)
class BoundReport:
    """Block pairs there were, block pairs joined, and passes."""

    block_pairs: int
    joined: int
    passes: int


def _distances(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (unit @ pivots.T), 0.0))


def _nearest_pivot(pivots: np.ndarray, spark) -> Column:
    """Cell and distance of a vector; no pivot for one without a direction."""
    shared = spark.sparkContext.broadcast(pivots)

    @F.arrow_udf("struct<cell:int,away:double>")
    def nearest(vectors: pa.Array) -> pa.Array:
        pivots = shared.value
        matrix, _, _ = kernels.pack(vectors, pivots.shape[1])
        unit = kernels.unit_rows(matrix)
        cell = kernels.nearest(unit, pivots, 1)[:, 0]
        away = np.sqrt(np.maximum(2.0 - 2.0 * np.einsum("ij,ij->i", unit, pivots[cell]), 0.0))
        cell = np.where(matrix.any(axis=1), cell, _NO_PIVOT).astype(np.int32)
        return pa.StructArray.from_arrays([pa.array(cell), pa.array(away)], names=["cell", "away"])

    return nearest(F.col("vec"))


def _blocked(rows: DataFrame, near: Column, per_block: int, purpose: str) -> DataFrame:
    """Rows with ``cell``, ``away`` and the number of a block of at most about ``per_block`` rows of their cell."""
    rows = rows.withColumn("at", near).select("*", "at.cell", "at.away").drop("at")
    rows = materialize(rows, purpose)
    cells = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / per_block).cast("int").alias("blocks"))  # one row per pivot
    part = F.pmod(F.xxhash64("sig"), F.col("blocks"))
    block = F.shiftleft((F.col("cell") + 1).cast("long"), 32).bitwiseOR(part)
    return rows.join(F.broadcast(cells), "cell").withColumn("block", block).drop("blocks")


def _reach(queries: DataFrame, pivots: np.ndarray) -> DataFrame:
    """How near the rows of every query block come to every pivot: block, cell, least."""
    shared = queries.sparkSession.sparkContext.broadcast(pivots)

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, best = shared.value, {}
        for batch in batches:
            unit = kernels.unit_rows(kernels.pack(batch.column("vec"), pivots.shape[1])[0])
            for block, rows in kernels.cell_runs(batch.column("block").to_numpy(zero_copy_only=False)):
                least = _distances(unit[rows], pivots).min(axis=0)
                best[block] = np.minimum(best[block], least) if block in best else least
            if len(best) > 1_000:  # a bounded state; the sums meet after the shuffle
                yield from rows_of(best)
                best = {}
        if best:
            yield from rows_of(best)

    def rows_of(best: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        cells = np.arange(len(next(iter(best.values()))), dtype=np.int32)
        yield pa.record_batch({
            "block": np.repeat(np.array(list(best)), len(cells)), "cell": np.tile(cells, len(best)),
            "least": np.concatenate(list(best.values())),
        })

    found = queries.select("block", "vec").mapInArrow(reach, "block long, cell int, least double")
    return found.groupBy("block", "cell").agg(F.min("least").alias("least"))


def _ceiling(away: Column, radius: Column) -> Column:
    gap = F.greatest(away - radius, F.lit(0.0))
    return 1.0 - gap * gap / 2 + _SLACK


def _grouped(sizes: DataFrame, rows: int) -> DataFrame:
    """Neighbouring blocks in groups of about ``rows`` rows: block, group and the block's place in it (one row per block)."""
    running = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nth = F.row_number().over(Window.orderBy("block")) - 1
    dealt = sizes.select("block", F.floor((F.sum("n").over(running) - 1) / rows).alias("full"), nth.alias("nth"))
    run = F.floor(F.col("nth") / _PLACES)
    group = F.shiftleft(F.col("full").cast("long"), 32).bitwiseOR(run.cast("long"))
    return dealt.select("block", group.alias("group"), (F.col("nth") % _PLACES).cast("int").alias("place"))


def _group_rows(spark, rows: int, dim: int) -> int:
    """Rows of a group: enough groups for all cores where a group's vectors are not beyond their bound anyway."""
    sides = int(np.ceil(np.sqrt(4 * spark.sparkContext.defaultParallelism)))
    return max(1, min(_GROUP_ELEMENTS // dim, -(-rows // sides)))


def _meet(k: int, pivots, id_type: pa.DataType):
    """Answers of a group of query blocks in a group of document blocks: the places that a row's ``todo`` names."""

    def meet(asked: pa.Table, docs: pa.Table) -> pa.Table:
        names = asked.column("sig").combine_chunks() if asked.num_rows else pa.array([], pa.string())
        empty = pa.table({"q": pa.array([], pa.string()), "id": pa.array([], id_type), "score": pa.array([], pa.float64())})
        if not asked.num_rows or not docs.num_rows:
            return empty
        centers = pivots.value
        queries = kernels.unit_rows(kernels.pack(asked.column("vec").combine_chunks(), centers.shape[1])[0])
        needed, todo = asked.column("kth").to_numpy(), asked.column("todo").to_numpy()
        vectors = kernels.unit_rows(kernels.pack(docs.column("vec").combine_chunks(), centers.shape[1])[0])
        ids, cells, radii = row_ids(docs.column("id").combine_chunks()), docs.column("cell").to_numpy(), docs.column("radius").to_numpy()
        state = kernels.TopK(len(queries), k)
        state.bound = np.where(needed < -1.0, -np.inf, needed)  # nothing below the k-th answer so far is one
        for place, block in kernels.cell_runs(docs.column("place").to_numpy()):
            rows = np.flatnonzero(todo >> place & 1)
            cell, radius = cells[block[0]], radii[block[0]]
            if cell == _NO_PIVOT:
                ceiling = np.full(len(rows), _SLACK)
            else:
                gap = np.maximum(_distances(queries[rows], centers[cell:cell + 1])[:, 0] - radius, 0.0)
                ceiling = 1.0 - gap * gap / 2 + _SLACK
            rows = rows[ceiling >= needed[rows]]
            if len(rows):
                state.add(queries[rows], rows, vectors[block], ids[block])
        found = emit_rows(state, names, id_type)
        return empty if found is None else found

    return meet


def join_by_bounds(queries: DataFrame, docs: DataFrame, k: int, *, query_id: str = "q", doc_id: str = "id",
                   vec_col: str = "embedding", spec: BoundSpec = BoundSpec()) -> tuple[DataFrame, BoundReport]:
    """The exact join (q, id, score, rank) and what it took."""
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = queries.sparkSession
    vec = F.col(vec_col)
    whole = F.coalesce(vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull()), F.lit(False))
    asked = queries.filter(whole).select(F.col(query_id).alias("q"), vec.alias("vec"), vector_signature(vec_col).alias("sig"))
    lengths = sorted(r[0] for r in asked.select(F.size("vec")).distinct().limit(3).collect())
    if len(lengths) > 1:
        raise ValueError(f"query vectors have several lengths: {lengths}")
    dim = max(1, lengths[0]) if lengths else 1
    rows = docs.withColumn(vec_col, guarded_vector(docs, vec_col, query_model(queries, docs))).filter(whole)
    rows = rows.select(F.col(doc_id).alias("id"), vec.alias("vec"), vector_signature(vec_col).alias("sig"))
    lowest = F.row_number().over(Window.partitionBy("sig").orderBy("id"))
    rows = rows.withColumn("copy", lowest).filter(F.col("copy") <= k).drop("copy")

    rows = materialize(rows, "bound-docs")
    n_docs, straight = rows.count(), (F.size("vec") == dim) & F.exists("vec", lambda x: x != 0)
    count = spec.pivots or -(-n_docs // (spec.doc_block // 8 or 1))
    fit_on = rows.filter(straight)
    cells = min(_MAX_PIVOTS, max(2, count))
    if fit_on.limit(1).count():
        pivots = kernels.unit_rows(fit_centroids(fit_on, cells, vec_col="vec", sample_rows=min(spec.fit_rows, max(1, n_docs))))
    else:
        pivots = np.eye(1, dim)
    placed = materialize(_blocked(rows, _nearest_pivot(pivots, spark), spec.doc_block, "bound-placed"), "bound-docs")
    unique = asked.filter(F.exists("vec", lambda x: x != 0)).groupBy("sig").agg(F.any_value("vec").alias("vec"))
    unique = materialize(_blocked(unique, _nearest_pivot(pivots, spark), spec.query_block, "bound-placed"), "bound-queries")

    blocks = placed.groupBy("block", "cell").agg(F.max("away").alias("radius"))
    blocks = blocks.select(F.col("block").alias("db"), "cell", "radius")
    reach = _reach(unique, pivots).withColumnRenamed("block", "qb")
    bounded = reach.join(blocks, "cell").select("qb", "db", "cell", "radius", _ceiling(F.col("least"), F.col("radius")).alias("ceiling"))
    flat = reach.filter(F.col("cell") == 0).drop("cell", "least")  # every query block once
    none = blocks.filter(F.col("cell") == _NO_PIVOT)
    bounded = bounded.unionByName(
        flat.withColumn("cell", F.lit(_NO_PIVOT)).join(none, "cell").withColumn("ceiling", F.lit(_SLACK)).select(*bounded.columns)
    )
    order = Window.partitionBy("qb").orderBy(F.desc("ceiling"), "db")
    query_groups, doc_groups = (
        materialize(_grouped(df.groupBy("block").agg(F.count(F.lit(1)).alias("n")), _group_rows(spark, df.count(), dim)), "bound-groups")
        for df in (unique, placed)
    )
    bounded = bounded.join(query_groups.select(F.col("block").alias("qb"), F.col("group").alias("qg")), "qb")
    bounded = bounded.join(doc_groups.select(F.col("block").alias("db"), F.col("group").alias("dg"), "place"), "db")
    open_ = materialize(bounded.withColumn("nth", F.row_number().over(order)), "bound-pairs")
    total, joined, passes, take = open_.count(), 0, 0, spec.first

    id_type = rows.schema["id"].dataType.simpleString()
    arrow_id = spark.createDataFrame([], rows.select("id").schema).toArrow().schema.field("id").type
    shared = spark.sparkContext.broadcast(pivots)
    best = spark.createDataFrame([], f"q string, id {id_type}, score double, rank int")
    left_over = total
    while left_over:
        passes += 1
        kth = best.filter(F.col("rank") == k).select(F.col("q").alias("sig"), F.col("score").alias("kth"))
        known = unique.join(kth, "sig", "left").withColumn("kth", F.coalesce("kth", F.lit(-2.0)))
        floor = known.groupBy(F.col("block").alias("qb")).agg(F.min("kth").alias("floor"))
        alive = materialize(open_.join(floor, "qb").filter(F.col("ceiling") >= F.col("floor")).drop("floor"), "bound-pairs")
        now = alive.filter(F.col("nth") <= take)
        here = now.count()
        if here:
            joined += here
            # A row goes once to every group on the other side that holds a block of its own.
            todo = now.groupBy("qb", "qg", "dg").agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("todo"))
            left = known.withColumnRenamed("block", "qb").join(todo, "qb")
            left = left.select(F.col("qg").alias("lq"), F.col("dg").alias("ld"), "sig", "vec", "kth", "todo")
            wanted = now.select("qg", "dg", "db", "place", "cell", "radius").distinct()
            right = placed.withColumnRenamed("block", "db").drop("cell").join(wanted, "db")
            right = right.select("qg", "dg", "id", "vec", "cell", "radius", "place")
            found = left.groupBy("lq", "ld").cogroup(right.groupBy("qg", "dg")).applyInArrow(
                _meet(k, shared, arrow_id), f"q string, id {id_type}, score double"
            )
            best = materialize(merge_best(found.unionByName(best.drop("rank")), k), "bound-best")
        open_ = alive.filter(F.col("nth") > take)
        left_over, take = open_.count(), 2 * take
    answers = asked.select("q", "sig").join(best.withColumnRenamed("q", "sig"), "sig").select("q", "id", "score", "rank")
    first = [r["id"] for r in rows.select("id").orderBy("id").limit(k).collect()]
    ids = F.array(*[F.lit(i) for i in first]).cast(f"array<{id_type}>")
    lost = asked.filter(~F.exists("vec", lambda x: x != 0)).select("q", F.posexplode(ids).alias("at", "id"))
    zero = lost.select("q", "id", F.lit(0.0).alias("score"), (F.col("at") + 1).alias("rank"))
    return answers.unionByName(zero), BoundReport(total, joined, passes)


def knn_join_bounded(queries: DataFrame, docs: DataFrame, k: int, **named) -> DataFrame:
    """Exact ``k`` most similar documents of every query, for two sides of any size: q, id, score, rank."""
    return join_by_bounds(queries, docs, k, **named)[0]
