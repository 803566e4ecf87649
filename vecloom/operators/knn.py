"""Exact and cell-restricted k-nearest-neighbour joins.

Two physical forms, chosen by measuring the query side:

* **queries fit in a checked budget** - their matrix travels to every task once
  and the documents never move; each task keeps a running top ``k`` per query.
* **more queries** - they are cut into passes that each fit the budget; the
  documents are read once per pass and still never move.
* **more passes than is worth reading the documents for** - both sides are cut
  into hash blocks of bounded size that meet in a grid of (cell, query block,
  document block) tasks.  A cell of any size is split into as many blocks as it
  needs.

Neither form emits pairs: a task sends on at most ``k`` rows per query, and a
window with ``row_number <= k`` merges those.  All results are exact for the
documents whose cells a query names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecloom.functions import kernels
from vecloom.operators.search import guarded_vector, query_model
from vecloom.sources.scratch import materialize, small_copy


@dataclass(frozen=True)
class KnnLimits:
    """Size bounds; the defaults suit executors with a GB for the Python of each core.

    A task holds a broadcast side several times over: as it came, as a matrix of doubles, and with its answers.
    """

    broadcast_bytes: int = 32 << 20
    max_broadcast_rows: int = 10_000_000
    max_passes: int = 16
    query_block: int = 16_384
    doc_block: int = 16_384


DEFAULT_LIMITS = KnnLimits()
_NAMED_CELLS = 1_000


def budget_rows(df: DataFrame, vec_col: str, limits: KnnLimits, k: int = 0) -> int:
    """Query rows that fit the budget, with their vectors and ``k`` answers each (all lengths must agree)."""
    vec = F.col(vec_col)
    probe = df.filter(vec.isNotNull()).select(F.size(vec)).take(1)
    width = 4 * max(1, probe[0][0]) if probe else 4
    return max(1, min(limits.max_broadcast_rows, limits.broadcast_bytes // (width + 24 * k)))


def small_side(df: DataFrame, id_col: str, vec_col: str, limits: KnnLimits, k: int = 0) -> pa.Table | None:
    """The rows as one Arrow table if they fit the budget, else ``None``; fetched once, no further than the budget."""
    rows = budget_rows(df, vec_col, limits, k)
    table = df.limit(rows + 1).toArrow()
    return table.combine_chunks() if table.num_rows <= rows and table.nbytes <= 2 * limits.broadcast_bytes else None


def passes(df: DataFrame, id_col: str, vec_col: str, limits: KnnLimits, k: int = 0) -> list[DataFrame] | None:
    """The query side in slices of about half the budget, or ``None`` if there were more than ``max_passes``."""
    stored = materialize(df, "queries")
    count = max(1, -(-2 * stored.count() // budget_rows(stored, vec_col, limits, k)))
    if count > limits.max_passes:
        return None
    number = F.pmod(F.xxhash64(id_col, F.lit(3)), F.lit(count))
    return [stored.filter(number == i) for i in range(count)]


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def row_ids(column: pa.Array) -> np.ndarray:
    values = column.to_numpy(zero_copy_only=False)
    return values.astype("U") if values.dtype == object else values


def _query_matrix(table: pa.Table, vec_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Unit query rows and which of them can be compared at all."""
    vectors = _column(table, vec_col)
    lengths = pc.unique(pc.list_value_length(vectors).drop_null()).to_pylist()
    if len(lengths) > 1:
        raise ValueError(f"query vectors have several lengths: {sorted(lengths)}")
    dim = lengths[0] if lengths else 1
    matrix, present, _ = kernels.pack(vectors, dim)
    return kernels.unit_rows(matrix), present


def merge_best(partials: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.asc("id"))
    return partials.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _schema(q_type: str, id_type: str) -> str:
    return f"q {q_type}, id {id_type}, score double"


def emit_rows(state: kernels.TopK, q_ids: pa.Array, id_type: pa.DataType) -> pa.Table | None:
    found = state.result()
    if found is None:
        return None
    query, score, ids = found
    return pa.table({"q": q_ids.take(pa.array(query)), "id": pa.array(ids).cast(id_type), "score": pa.array(score)})


def _broadcast_topk(queries: pa.Table, docs: DataFrame, k: int, q_type: str, id_type: str) -> DataFrame:
    """Documents stay in place; the bounded query block goes to them."""
    unique = queries.column("q").to_pylist()
    names = list(dict.fromkeys(unique))
    position = {q: i for i, q in enumerate(names)}
    at = np.array([position[q] for q in unique], dtype=np.int64)
    matrix, present = _query_matrix(queries, "vec")
    cells = _column(queries, "cell").to_numpy(zero_copy_only=False).astype(np.int64)
    by_cell = {c: rows[present[rows]] for c, rows in kernels.cell_runs(cells)}
    q_ids = pa.array(names, queries.schema.field("q").type)
    shared = docs.sparkSession.sparkContext.broadcast((matrix, at, by_cell, q_ids))
    probed = sorted(c for c, rows in by_cell.items() if len(rows))
    # Naming the cells prunes partitions; the kernel skips the others anyway.
    reachable = docs.filter(F.col("cell").isin(probed)) if len(probed) <= _NAMED_CELLS else docs

    def score(batches):
        matrix, at, by_cell, q_ids = shared.value
        state, kind = kernels.TopK(len(q_ids), k), None
        for batch in (piece for batch in batches for piece in kernels.pieces(batch, "vec")):
            kind = batch.schema.field("id").type
            docs_matrix, present, _ = kernels.pack(batch.column("vec"), matrix.shape[1])
            unit, ids = kernels.unit_rows(docs_matrix), row_ids(batch.column("id"))
            for cell, run in kernels.cell_runs(batch.column("cell").to_numpy(zero_copy_only=False)):
                rows, mine = by_cell.get(cell), run[present[run]]
                if rows is not None and len(rows) and len(mine):
                    state.add(matrix[rows], at[rows], unit[mine], ids[mine])
        out = emit_rows(state, q_ids, kind)
        if out is not None:
            yield from out.to_batches()

    return reachable.select("cell", "id", "vec").mapInArrow(score, _schema(q_type, id_type))


def _blocks(df: DataFrame, rows_per_block: int, name: str) -> DataFrame:
    return df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / rows_per_block).cast("int").alias(name))


def _sizes(queries: DataFrame, docs: DataFrame, limits: KnnLimits) -> Callable[[DataFrame], DataFrame]:
    """How to add the blocks per cell, counted on ids alone, to either side.

    Joining them by key would move every row of a cell to one task, so they are
    sent out wherever they are few, and are constants where there is one cell.
    """
    sizes = _blocks(docs, limits.doc_block, "d_blocks").join(_blocks(queries, limits.query_block, "q_blocks"), "cell")
    few = small_copy(sizes)
    rows = [] if few is None else few.take(2)
    if len(rows) == 1:
        only = rows[0]
        blocks = {name: F.lit(only[name]) for name in ("d_blocks", "q_blocks")}
        return lambda df: df.filter(F.col("cell") == only["cell"]).withColumns(blocks)
    return lambda df: df.join(sizes if few is None else few, "cell")


def vector_signature(vec: str):
    """128 bits that tell vectors apart."""
    return F.concat_ws(":", F.hex(F.xxhash64(vec)), F.hex(F.xxhash64(F.reverse(F.col(vec)), F.size(vec))))


def _grid_topk(queries: DataFrame, docs: DataFrame, k: int, q_type: str, id_type: str, limits: KnnLimits,
               copies: int = 1) -> DataFrame:
    """Bounded blocks of both sides meet once per (cell, block, block).

    Copies are collapsed first, exactly: equal query vectors have equal answers,
    and of equal documents in a cell only the ``k`` lowest ids can be answers.
    The window limit drops the others before their vectors are shuffled.
    """
    queries = queries.filter(F.col("vec").isNotNull()).withColumn("sig", vector_signature("vec"))
    distinct = queries.groupBy("cell", "sig").agg(F.any_value("vec").alias("vec"))
    equal = Window.partitionBy("cell", "sig").orderBy("id")
    lowest = (
        docs.filter(F.col("vec").isNotNull())
        .withColumn("sig", vector_signature("vec"))
        .withColumn("copy", F.row_number().over(equal))
        .filter(F.col("copy") <= k)
    )
    with_sizes = _sizes(queries, docs, limits)
    left = (
        with_sizes(distinct)
        .withColumn("qb", F.pmod(F.xxhash64("sig"), F.col("q_blocks")).cast("int"))
        .select("cell", "qb", F.explode(F.sequence(F.lit(0), F.col("d_blocks") - 1)).alias("db"), "sig", "vec")
    )
    right = (
        with_sizes(lowest)
        .withColumn("db", F.pmod(F.xxhash64("id"), F.col("d_blocks")).cast("int"))
        .select("cell", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)).alias("qb"), "db", "id", "vec")
    )

    def meet(block: pa.Table, against: pa.Table) -> pa.Table:
        kind = against.schema.field("id").type
        names = _column(block, "sig") if block.num_rows else pa.array([], pa.string())
        empty = pa.table({"q": pa.array([], pa.string()), "id": pa.array([], kind), "score": pa.array([], pa.float64())})
        if not block.num_rows or not against.num_rows:
            return empty
        matrix, present = _query_matrix(block, "vec")
        docs_matrix, known, _ = kernels.pack(_column(against, "vec"), matrix.shape[1])
        state, rows = kernels.TopK(len(matrix), k), np.flatnonzero(present)
        if len(rows) and known.any():
            state.add(matrix[rows], rows, kernels.unit_rows(docs_matrix[known]), row_ids(_column(against, "id"))[known])
        return emit_rows(state, names, kind) or empty

    keys = ["cell", "qb", "db"]
    partials = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, _schema("string", id_type))
    if copies > 1:
        partials = partials.dropDuplicates(["q", "id"])
    best = merge_best(partials, k).withColumnRenamed("q", "sig").drop("rank")
    askers = queries.select("q", "sig").distinct()
    return askers.join(best, "sig").select(F.col("q").cast(q_type), "id", "score")


def cell_topk(queries: DataFrame, docs: DataFrame, k: int, limits: KnnLimits = DEFAULT_LIMITS, copies: int = 1) -> DataFrame:
    """Top ``k`` of ``docs(cell, id, vec)`` per query of ``queries(q, cell, vec)``.

    A query meets the documents of the cells it names.  ``copies`` says in how
    many cells one document may appear.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    q_type, id_type = queries.schema["q"].dataType.simpleString(), docs.schema["id"].dataType.simpleString()
    table = small_side(queries, "q", "vec", limits, k * copies)
    slices = None if table is not None else passes(queries, "q", "vec", limits, k * copies)
    if table is not None or slices is not None:
        # All rows of a query are in one slice.  Within a task a document may fill up to `copies` of its places.
        tables = [table] if table is not None else [s.toArrow().combine_chunks() for s in slices]
        found = [_broadcast_topk(t, docs, k * copies, q_type, id_type) for t in tables if t.num_rows or len(tables) == 1]
        partials = reduce(DataFrame.unionByName, found)
        if copies > 1:
            partials = partials.dropDuplicates(["q", "id"])
    else:
        partials = _grid_topk(queries, docs, k, q_type, id_type, limits, copies)
    return merge_best(partials, k)


def knn_join(queries: DataFrame, docs: DataFrame, k: int, *, query_id: str = "q", doc_id: str = "id",
             vec_col: str = "embedding", limits: KnnLimits = DEFAULT_LIMITS) -> DataFrame:
    """Exact ``k`` most similar documents of every query: q, id, score, rank.

    Queries or documents without a vector are left out.  A query id must name
    one vector, and a document id one row.
    """
    q = queries.select(F.col(query_id).alias("q"), F.lit(0).alias("cell"), F.col(vec_col).alias("vec"))
    vec = guarded_vector(docs, vec_col, query_model(queries, docs))
    d = docs.select(F.lit(0).alias("cell"), F.col(doc_id).alias("id"), vec.alias("vec"))
    return cell_topk(q, d, k, limits)
