"""Approximate nearest neighbours over compressed vectors: product quantisation with exact rerank.

A unit vector is cut into ``parts`` pieces, and each piece is stored as the number of its
nearest centroid in that part's codebook: one byte a piece.  Codebooks are fitted in Spark,
a task per part, on a bounded sample; every row is encoded.

A query makes one table per part, its inner products with the part's centroids; a row's
score is about the sum of the entries that its bytes name, so a scan reads ``parts`` bytes a
vector and not its numbers.  Every task keeps each query's best ``rerank`` rows; of these the
vectors are fetched, and the exact cosine decides, rounded as in the exact join.

Queries within a byte budget go to the codes, which stay in place.  More queries meet the
codes in a grid of bounded blocks; no side passes through the driver.  Vectors that are
NULL, hold a NULL or are all zero take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import vecloom.functions as V
from vecloom.functions import kernels
from vecloom.operators.graph import usable
from vecloom.operators.knn import DEFAULT_LIMITS, KnnLimits, emit_rows, merge_best, row_ids, small_side
from vecloom.operators.search import guarded_vector, query_model
from vecloom.sources.scratch import materialize

PARTS, CENTROIDS, SAMPLE_ROWS, ROUNDS, RERANK = 16, 256, 50_000, 12, 100
_QUERIES_AT_ONCE, _CODES_AT_ONCE, _STATE_QUERIES = 256, 8_192, 1_024


@dataclass(frozen=True)
class Codebooks:
    """Centroids of every part: an array of part, centroid, dimension."""

    centroids: np.ndarray

    @property
    def dim(self) -> int:
        return self.centroids.shape[0] * self.centroids.shape[2]

    def encode(self, unit: np.ndarray) -> np.ndarray:
        """One byte per part: the nearest centroid."""
        parts, _, width = self.centroids.shape
        codes = np.empty((len(unit), parts), dtype=np.uint8)
        for part, book in enumerate(self.centroids):
            piece = unit[:, part * width:(part + 1) * width]
            codes[:, part] = ((book * book).sum(axis=1) - 2 * (piece @ book.T)).argmin(axis=1)
        return codes

    def tables(self, unit: np.ndarray) -> np.ndarray:
        """Inner products of every query's pieces with the centroids: an array of part, centroid, query."""
        parts, _, width = self.centroids.shape
        pieces = unit.reshape(len(unit), parts, width)
        return np.einsum("pcw,qpw->pcq", self.centroids, pieces).astype(np.float32)


def scan(tables: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Approximate scores of all rows (down) and queries (across)."""
    total = np.zeros((len(codes), tables.shape[2]), dtype=np.float32)
    for part, table in enumerate(tables):
        total += table[codes[:, part]]
    return total


def _closest(points: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every piece, and the distance less the piece's own square; a tile at a time."""
    own, least = np.empty(len(points), dtype=np.int64), np.empty(len(points))
    for first in range(0, len(points), _CODES_AT_ONCE):
        some = slice(first, first + _CODES_AT_ONCE)
        away = (books * books).sum(axis=1) - 2 * (points[some] @ books.T)
        own[some] = away.argmin(axis=1)
        least[some] = away[np.arange(len(away)), own[some]]
    return own, least


def _lloyd(centroids: int, rounds: int, seed: int):
    """K-means of one part's pieces; an empty cluster takes the piece that is farthest from its own centroid."""

    def fit(rows: pa.Table) -> pa.Table:
        part = rows.column("part")[0].as_py()
        order = rows.sort_by("draw").column("piece").combine_chunks()
        points = kernels.pack(order, len(order[0]))[0]
        rng = np.random.default_rng([seed, part])
        books = points[rng.permutation(len(points))[:centroids]].copy()
        for _ in range(rounds):
            own, least = _closest(points, books)
            counts = np.bincount(own, minlength=len(books))
            sums = np.stack([np.bincount(own, weights=column, minlength=len(books)) for column in points.T], axis=1)
            books = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], books)
            far = np.argsort(-(least + (points * points).sum(axis=1)), kind="stable")
            empty = np.flatnonzero(counts == 0)
            books[empty] = points[far[:len(empty)]]
        return pa.table({"part": np.full(len(books), part, dtype=np.int32), "number": np.arange(len(books), dtype=np.int32),
                         "centroid": pa.array(books.tolist(), pa.list_(pa.float64()))})

    return fit


def fit_codebooks(docs: DataFrame, *, parts: int = PARTS, centroids: int = CENTROIDS, vec_col: str = "embedding",
                  sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS, seed: int = 42) -> Codebooks:
    """Codebooks from about ``sample_rows`` rows, chosen by hash; vectors of the most common length."""
    if not 1 <= centroids <= 256:
        raise ValueError("centroids must be from 1 to 256")
    vectors = docs.filter(usable(vec_col)).select(F.col(vec_col).alias("vec"))
    sizes = vectors.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return Codebooks(np.zeros((parts, 0, 1)))
    dim, count = sizes["dim"], sizes["count"]
    if dim % parts:
        raise ValueError(f"{dim} dimensions can not be cut into {parts} parts")
    width, draw = dim // parts, F.xxhash64("vec", F.lit(seed))
    sample = vectors.filter(F.size("vec") == dim).withColumn("draw", draw)
    sample = sample.filter(F.pmod("draw", F.lit(1 << 30)) < int(min(1.0, sample_rows / count) * (1 << 30)) + 1)
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    unit = F.transform("vec", lambda x: x / F.col("norm"))
    pieces = sample.withColumn("norm", norm).withColumn("unit", unit).select("draw", F.posexplode(
        F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice("unit", p * width + 1, width))
    ).alias("part", "piece"))
    fitted = pieces.groupBy("part").applyInArrow(_lloyd(centroids, rounds, seed), "part int, number int, centroid array<double>")
    rows = fitted.orderBy("part", "number").collect()  # parts x centroids rows
    return Codebooks(np.array([r["centroid"] for r in rows]).reshape(parts, -1, width))


def code_column(vec: str | Column, books: Codebooks) -> Column:
    """The bytes of a vector; NULL if it has no direction or another length."""
    shared = SparkSession.active().sparkContext.broadcast(books)

    @F.arrow_udf("binary")
    def coded(vectors: pa.Array) -> pa.Array:
        books = shared.value
        matrix, present, sized = kernels.pack(vectors, books.dim)
        known = present & sized & matrix.any(axis=1)
        codes = books.encode(kernels.unit_rows(matrix))
        width = codes.shape[1]
        ends = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * width)
        found = pa.Array.from_buffers(pa.binary(), len(codes), [None, ends.buffers()[1], pa.py_buffer(codes.tobytes())])
        return found if known.all() else pa.array([c if k else None for c, k in zip(found.to_pylist(), known)], pa.binary())

    return coded(vec if isinstance(vec, Column) else F.col(vec))


def build_codes(docs: DataFrame, path: str, books: Codebooks, *, id_col: str = "id", vec_col: str = "embedding") -> None:
    """Write (id, code) of every row that has a direction, and the codebooks."""
    coded = docs.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    if books.centroids.shape[1]:
        coded = coded.withColumn("code", code_column("vec", books)).filter(F.col("code").isNotNull())
    else:
        coded = coded.withColumn("code", F.lit(b"")).filter("false")
    coded.select("id", "code").write.mode("overwrite").parquet(f"{path}/codes")
    rows = [(p, c, [float(x) for x in v]) for p, book in enumerate(books.centroids) for c, v in enumerate(book)]
    spark = docs.sparkSession
    spark.createDataFrame(rows, "part int, number int, centroid array<double>").write.mode("overwrite").parquet(f"{path}/books")


def load_codes(spark: SparkSession, path: str) -> tuple[DataFrame, Codebooks]:
    rows = spark.read.parquet(f"{path}/books").orderBy("part", "number").collect()
    parts = len({r["part"] for r in rows}) or 1
    centroids = np.array([r["centroid"] for r in rows]).reshape(parts, -1, len(rows[0]["centroid"])) if rows else np.zeros((1, 0, 1))
    return spark.read.parquet(f"{path}/codes"), Codebooks(centroids)


def _add(state: kernels.TopK, unit: np.ndarray, rows: np.ndarray, books: Codebooks, codes: np.ndarray, ids: np.ndarray) -> None:
    """Score queries (at positions ``rows``) against codes, a tile at a time."""
    for first in range(0, len(rows), _QUERIES_AT_ONCE):
        some = rows[first:first + _QUERIES_AT_ONCE]
        tables = books.tables(unit[some])
        for start in range(0, len(codes), _CODES_AT_ONCE):
            part = slice(start, start + _CODES_AT_ONCE)
            state._collect(scan(tables, codes[part]).T.astype(np.float64), some, ids[part])


def _bytes_of(codes: pa.Array, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(codes.to_pylist()), dtype=np.uint8).reshape(len(codes), parts)


def candidates(queries: DataFrame, codes: DataFrame, books: Codebooks, rerank: int, limits: KnnLimits = DEFAULT_LIMITS) -> DataFrame:
    """The best ``rerank`` rows of every (q, vec) by their codes: q, id, score, rank."""
    q_type, id_type = queries.schema["q"].dataType.simpleString(), codes.schema["id"].dataType.simpleString()
    schema, spark = f"q {q_type}, id {id_type}, score double", queries.sparkSession
    shared, parts = spark.sparkContext.broadcast(books), books.centroids.shape[0]

    def matrix_of(table: pa.Table) -> np.ndarray:
        return kernels.unit_rows(kernels.pack(table.column("vec").combine_chunks(), shared.value.dim)[0])

    # A task holds twice the answers of all its queries, and sorts them: a fourth of the usual budget.
    table = small_side(queries, "q", "vec", limits, 4 * rerank)
    if table is not None:
        asked = spark.sparkContext.broadcast((table.column("q").combine_chunks(), matrix_of(table)))

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, unit = asked.value
            state, kind = kernels.TopK(len(unit), rerank), None
            for batch in batches:
                if batch.num_rows and len(unit):
                    kind = batch.schema.field("id").type
                    _add(state, unit, np.arange(len(unit)), shared.value, _bytes_of(batch.column("code"), parts), row_ids(batch.column("id")))
            found = emit_rows(state, names, kind)
            if found is not None:
                yield from found.to_batches()

        return merge_best(codes.select("id", "code").mapInArrow(scored, schema), rerank)

    sizes = (max(1, -(-df.count() // rows)) for df, rows in ((queries, limits.query_block), (codes, 8 * limits.doc_block)))
    n_q, n_d = sizes
    arrow = {name: spark.createDataFrame([], df.select(name).schema).toArrow().schema.field(name).type
             for df, name in ((queries, "q"), (codes, "id"))}

    def meet(block: pa.Table, against: pa.Table) -> pa.Table:
        none = pa.table({"q": pa.array([], arrow["q"]), "id": pa.array([], arrow["id"]), "score": pa.array([], pa.float64())})
        if not block.num_rows or not against.num_rows:
            return none
        held, ids = _bytes_of(against.column("code").combine_chunks(), parts), row_ids(against.column("id").combine_chunks())
        found = []
        for first in range(0, block.num_rows, _STATE_QUERIES):  # the state is several times its answers
            some = block.slice(first, _STATE_QUERIES).combine_chunks()
            unit = matrix_of(some)
            state = kernels.TopK(len(unit), rerank)
            _add(state, unit, np.arange(len(unit)), shared.value, held, ids)
            found.append(emit_rows(state, some.column("q").combine_chunks(), arrow["id"]))
        found = [part for part in found if part is not None]
        return pa.concat_tables(found) if found else none

    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = queries.select("q", "vec", F.pmod(F.xxhash64("q"), F.lit(n_q)).alias("qb"), every(n_d).alias("db"))
    right = codes.select("id", "code", F.pmod(F.xxhash64("id"), F.lit(n_d)).alias("db"), every(n_q).alias("qb"))
    return merge_best(left.groupBy("qb", "db").cogroup(right.groupBy("qb", "db")).applyInArrow(meet, schema), rerank)


def pq_search(queries: DataFrame, docs: DataFrame, codes: DataFrame, books: Codebooks, k: int, *, rerank: int = RERANK,
              query_id: str = "q", doc_id: str = "id", vec_col: str = "embedding", limits: KnnLimits = DEFAULT_LIMITS) -> DataFrame:
    """Top ``k`` of the ``rerank`` rows whose codes look nearest: q, id, score, rank.  Ids name one row on either side."""
    if k < 1 or rerank < k:
        raise ValueError("k must be at least 1, and rerank at least k")
    asked = queries.filter(usable(vec_col)).select(F.col(query_id).alias("q"), F.col(vec_col).alias("vec"))
    found = materialize(candidates(asked, codes, books, rerank, limits).select("q", "id"), "pq-candidates")
    vec = guarded_vector(docs, vec_col, query_model(queries, docs))
    stored = docs.select(F.col(doc_id).alias("id"), vec.alias("doc_vec"))
    both = found.join(stored, "id").join(asked, "q")
    exact = F.round(V.cosine_similarity("vec", "doc_vec", out="double"), kernels.SCORE_DIGITS)
    return merge_best(both.select("q", "id", exact.alias("score")), k)
