"""Maximum inner product search by multi-index hashing.

1. Codes.  Vectors are lifted onto a sphere (one more component makes all norms equal
   to the largest), so that inner products order like cosines.  Rotations are learned
   on a bounded sample by iterative quantisation, and the signs of the rotated
   components are the code's bits.
2. Index.  Every row is coded.  Rows are dealt in shards of bounded size; a shard
   keeps its codes split into substrings, and for each substring and value the set of
   rows whose substring lies within the substring radius of that value.
3. Probing.  By the pigeonhole principle a code within Hamming radius ``r`` of the query
   agrees with it in at least one of ``m`` substrings to within ``floor(r / m)`` bits, or
   one less from the ``r mod m + 1``-th on.  The union of one set per substring therefore
   holds every code within the radius; their full distance is then counted.
4. Rerank.  Codes within the radius are ranked by the exact inner product in double
   precision.  A query that finds fewer than ``k`` codes in a shard takes the ``k``
   nearest codes instead, so no query comes back short.

The radius is the smallest that would have reached ``sample_recall`` on the sample, so it
follows the data.  Queries are a stated set; they meet every shard in blocks, and a
block sends on ``k`` rows per query.

Defined results: vectors that are null, zero, or hold a null or non-finite value take no
part; neither do rows with a null id.  A query never returns its own id.  Ties go to the
smaller id.  With fewer than ``k`` candidates all are returned.  Vectors of the most
frequent length take part; the length is found over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vecloom.llm.common import blocks_for
from vecloom.sources.scratch import materialize

K, BITS, SUBSTRING_BITS = 20, 256, 8
SAMPLE_ROWS, SAMPLE_QUERIES, SAMPLE_RECALL, ROUNDS = 8192, 256, 0.98, 12
SHARD_ROWS, QUERY_ROWS = 8192, 2048
_VALUES = 1 << SUBSTRING_BITS


def usable(vector: str) -> Column:
    """Not null, not empty, every value finite, and not all of them zero."""
    column = F.col(vector)
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(column.isNotNull() & finite & F.exists(column, lambda x: x != 0), F.lit(False))


def lifted(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Append the component that gives every vector the norm ``largest``."""
    rest = np.sqrt(np.maximum(largest**2 - np.einsum("ij,ij->i", vectors, vectors), 0.0))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def learn_rotations(sample: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, seed: int = 0) -> np.ndarray:
    """Projection to ``bits`` values: as many learned rotations as needed, each of at most the vectors' length.

    Each starts from a random rotation of the principal axes and alternates between the nearest corners of the cube and
    the rotation that brings the vectors closest to them.
    """
    rng = np.random.default_rng(seed)
    d = sample.shape[1]
    axes = np.linalg.eigh(sample.T @ sample)[1].T[::-1]
    parts = []
    while sum(p.shape[1] for p in parts) < bits:
        turn, _ = np.linalg.qr(rng.normal(size=(d, d)))
        low = sample @ axes.T
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.where(low @ turn > 0, 1.0, -1.0).T @ low)
            turn = (u @ v).T
        parts.append(axes.T @ turn)
    return np.concatenate(parts, axis=1)[:, :bits]


def codes(vectors: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """Packed bits, one byte per substring."""
    return np.packbits(vectors @ rotation > 0, axis=1)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of code ``a`` to each row of ``b``."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def learn_radius(sample: np.ndarray, rotation: np.ndarray, k: int, recall: float, queries: int, full_rows: int) -> int:
    """Smallest radius that holds ``recall`` of the true neighbours of some sample rows.

    The sample stands for ``full_rows`` rows, so its nearest ``k x sample / rows`` (one at least) stand for the nearest k.
    """
    coded = codes(sample, rotation)
    k = max(1, round(k * len(sample) / max(full_rows, len(sample))))
    found = []
    for q in range(min(queries, len(sample))):
        near = sample @ sample[q]
        near[q] = -np.inf
        best = np.argpartition(-near, min(k, len(near) - 1))[:k]
        found.append(hamming(coded[q], coded[best]))
    return int(np.quantile(np.concatenate(found), recall, method="higher")) if found else BITS


def substring_radii(radius: int, parts: int) -> list[int]:
    """Pigeonhole: the first ``radius mod parts + 1`` substrings need ``radius // parts``, the others one bit less."""
    whole, rest = divmod(radius, parts)
    return [whole if j <= rest else whole - 1 for j in range(parts)]


class Shard:
    """Index over a bounded number of codes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rotation: np.ndarray, largest: float, radius: int) -> None:
        self.ids, self.vectors, self.radius = ids, vectors, radius
        self.codes = codes(lifted(vectors, largest), rotation)
        values = np.arange(_VALUES, dtype=np.uint8)
        apart = np.bitwise_count(values[:, None] ^ values[None, :])
        self.sets = []
        for j, bits in enumerate(substring_radii(radius, self.codes.shape[1])):
            # Row v: the rows of the shard whose j-th substring is within `bits` of v, as a bit set.
            inside = (apart <= bits)[:, self.codes[:, j]] if bits >= 0 else np.zeros((_VALUES, len(ids)), dtype=bool)
            self.sets.append(np.packbits(inside, axis=1))

    def probe(self, code: np.ndarray) -> np.ndarray:
        """Positions of every code within the radius."""
        union = self.sets[0][code[0]].copy()
        for j in range(1, len(self.sets)):
            np.bitwise_or(union, self.sets[j][code[j]], out=union)
        at = np.flatnonzero(np.unpackbits(union, count=len(self.ids)))
        return at[hamming(code, self.codes[at]) <= self.radius]

    def nearest(self, query_id: int, query: np.ndarray, code: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        at = self.probe(code)
        at = at[self.ids[at] != query_id]
        if len(at) < k:
            apart = hamming(code, self.codes)
            apart[self.ids == query_id] = BITS + 1
            at = np.argsort(apart, kind="stable")[:k]
            at = at[self.ids[at] != query_id]
        score = self.vectors[at] @ query
        best = np.lexsort((self.ids[at], -score))[:k]
        return self.ids[at[best]], score[best]


def _rows(column: pa.ListArray | pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64)


def search(
    vectors: DataFrame, queries: DataFrame, *, k: int = K, vec_id: str = "vec_id", vector: str = "embedding",
    bits: int = BITS, sample_rows: int = SAMPLE_ROWS, sample_recall: float = SAMPLE_RECALL, radius: int | None = None,
    shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for every usable query row."""
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
        return rows.where(usable("v") & F.col("vec_id").isNotNull())

    rows, asked = clean(vectors), clean(queries)
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    stats = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.sqrt(F.max(squares)).alias("largest"))
    top = stats.orderBy(F.desc("n"), "dim").first()
    if top is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n, largest = top["dim"], top["n"], top["largest"]
    rows, asked = rows.where(F.size("v") == dim), asked.where(F.size("v") == dim)
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("v").collect()  # bounded
    sample = lifted(np.array([r["v"] for r in drawn]), largest)
    rotation = learn_rotations(sample, bits)
    if radius is None:
        radius = learn_radius(sample, rotation, k, sample_recall, SAMPLE_QUERIES, n)

    shards, slices = blocks_for(n, shard_rows), blocks_for(asked.count(), query_rows)

    def packed(df: DataFrame, count: int, name: str) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(count)).cast("int").alias(name)
        return df.groupBy(block).agg(F.collect_list(F.struct("vec_id", "v")).alias(f"{name}_rows"))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                number = batch.column(0)[row].as_py()
                if held != number:
                    held, table = number, batch.column(1)[row].values
                    ids = table.field(0).to_numpy()
                    shard = Shard(ids, _rows(table.field(1)), rotation, largest, radius)
                asked_rows = batch.column(2)[row].values
                query_ids, query_vectors = asked_rows.field(0).to_numpy(), _rows(asked_rows.field(1))
                # A query's own lift is zero: its norm does not change the order of its answers.
                query_codes = codes(np.pad(query_vectors, ((0, 0), (0, 1))), rotation)
                found = [shard.nearest(*q, k) for q in zip(query_ids, query_vectors, query_codes, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(query_ids, [len(f[0]) for f in found])),
                     pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found]))],
                    names=["query_id", "vec_id", "score"],
                )

    index = materialize(packed(rows, shards, "shard"), "hash-index")
    blocks = materialize(packed(asked, slices, "slice"), "hash-queries")
    spread = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).drop("slice")
    work = index.join(spread, "shard").select("shard", "shard_rows", "slice_rows")
    found = work.mapInArrow(answer, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
