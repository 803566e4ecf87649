"""Arrow/NumPy kernels that run inside tasks on one batch at a time.

Spark partitions, shuffles and merges; these only turn a batch of vectors into
a matrix, score it against a bounded block of queries, and keep partial results.
Scores are rounded to nine decimals before they are ranked, below the resolution
of single-precision vectors, so that equal texts tie exactly and the id decides.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SCORE_DIGITS = 9
# Largest score matrix held at once, in elements (32 MB of doubles).
_TILE = 4_000_000
# Queries scored at once, and elements of a score matrix of which several copies are held.
_QUERIES, _SMALL_TILE = 4_096, 1_000_000


def pack(vectors: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matrix of a vector column, with flags for present and well-sized rows.

    Rows that are NULL, hold a NULL element or have another length are zero in
    the matrix; the first two are not ``present``, the last is not ``sized``.
    """
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    n = len(vectors)
    present = vectors.is_valid().to_numpy(zero_copy_only=False)
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    flat = vectors.flatten()
    if flat.null_count:
        owner = np.repeat(np.arange(n), lengths)
        present = present.copy()
        present[owner[flat.is_null().to_numpy(zero_copy_only=False)]] = False
        flat = pc.fill_null(flat, 0.0)
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    sized = lengths == dim
    if sized.all():
        matrix = values.reshape(n, dim)
        if not present.all():
            matrix[~present] = 0.0
        return matrix, present, sized
    matrix = np.zeros((n, dim))
    usable = present & sized
    matrix[usable] = values[np.repeat(sized, lengths)].reshape(-1, dim)[present[sized]]
    return matrix, present, sized


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero and so score zero."""
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    return matrix / np.where(norms > 0, norms, 1.0)[:, None]


def cosine_scores(vectors: pa.Array, query: np.ndarray) -> pa.Array:
    """Rounded cosine of every row with one query; NULL for NULL rows."""
    matrix, present, _ = pack(vectors, len(query))
    scores = unit_rows(matrix) @ unit_rows(query.reshape(1, -1))[0]
    return pa.array(np.round(scores, SCORE_DIGITS), mask=~present)


def cosine_distances(vectors: pa.Array, query: np.ndarray) -> pa.Array:
    """Cosine distance of every row: NaN for zero vectors, error for a mismatch."""
    matrix, present, sized = pack(vectors, len(query))
    if not (sized | ~present).all():
        raise ValueError(f"different vector dimensions, expected {len(query)}")
    unit = unit_rows(query.reshape(1, -1))[0]
    distances = np.round(1.0 - unit_rows(matrix) @ unit, SCORE_DIGITS)
    if not unit.any():
        distances[:] = np.nan
    distances[~matrix.any(axis=1)] = np.nan
    return pa.array(distances, mask=~present)


class TopK:
    """Running top ``k`` per query over any number of document blocks.

    Order: score descending, then id ascending.  State is at most ``k`` rows per
    query plus a bounded buffer, whatever the number of documents seen.
    """

    _BUFFER = 500_000

    def __init__(self, n_queries: int, k: int):
        self.k = k
        # A score no answer of the query can be below, and the id that an equal
        # score must undercut (unknown until k answers have been settled).
        self.bound = np.full(n_queries, -np.inf)
        self.worst: np.ndarray | None = None
        self.settled = np.zeros(n_queries, dtype=bool)
        self._pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._waiting = 0
        self._limit = max(self._BUFFER, 2 * n_queries * k)

    def add(self, queries: np.ndarray, at: np.ndarray, docs: np.ndarray, ids: np.ndarray) -> None:
        """Score unit ``queries`` (global positions ``at``) against unit ``docs``."""
        step = max(1, _SMALL_TILE // max(1, min(_QUERIES, len(queries))))
        for first in range(0, len(queries), _QUERIES):
            some = slice(first, first + _QUERIES)
            for start in range(0, len(docs), step):
                self._collect(queries[some] @ docs[start : start + step].T, at[some], ids[start : start + step])

    def _collect(self, scores: np.ndarray, at: np.ndarray, ids: np.ndarray) -> None:
        k, width = self.k, scores.shape[1]
        bound = self.bound[at]
        if width > k and np.isneginf(bound).any():
            # The k-th best of one block bounds the k-th best of them all.
            best = np.round(np.partition(scores, width - k, axis=1)[:, width - k], SCORE_DIGITS)
            bound = np.maximum(bound, best)
            np.maximum.at(self.bound, at, best)
        rows, cols = np.nonzero(scores >= (bound - 2e-9)[:, None])
        score, query, found = np.round(scores[rows, cols], SCORE_DIGITS), at[rows], ids[cols]
        # A score equal to a settled bound counts only with a lower id, which
        # keeps a crowd of copies out once their first k are known.
        keep = score >= self.bound[query]
        if self.worst is not None:
            tied = np.flatnonzero((score == self.bound[query]) & self.settled[query])
            keep[tied] &= found[tied] < self.worst[query[tied]]
        self._pending.append((query[keep], score[keep], found[keep]))
        self._waiting += int(keep.sum())
        if self._waiting > self._limit:
            self.result()

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Reduce what has been collected to (query, score, id) rows."""
        if not self._pending:
            return None
        query, score, ids = (np.concatenate(parts) for parts in zip(*self._pending))
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        place = np.arange(len(query)) - np.searchsorted(query, query, side="left")
        last = place == self.k - 1
        if self.worst is None:
            self.worst = np.empty(len(self.bound), dtype=object if ids.dtype.kind == "U" else ids.dtype)
        self.bound[query[last]], self.worst[query[last]] = score[last], ids[last]
        self.settled[query[last]] = True
        kept = place < self.k
        self._pending = [(query[kept], score[kept], ids[kept])]
        self._waiting = int(kept.sum())
        return self._pending[0]


def pieces(batch: pa.RecordBatch, vectors: str) -> list[pa.RecordBatch]:
    """A batch in slices whose vectors are a matrix of bounded size."""
    numbers = pc.sum(pc.list_value_length(batch.column(vectors))).as_py() or 1
    rows = max(1, _SMALL_TILE * batch.num_rows // numbers)
    return [batch.slice(start, rows) for start in range(0, batch.num_rows, rows)]


def nearest(rows: np.ndarray, centroids: np.ndarray, probes: int) -> np.ndarray:
    """Positions of the ``probes`` most similar centroids per row, best first."""
    out = np.empty((len(rows), probes), dtype=np.int64)
    step = max(1, _TILE // len(centroids))
    for start in range(0, len(rows), step):
        scores = rows[start : start + step] @ centroids.T
        if probes == 1:
            out[start : start + step, 0] = scores.argmax(axis=1)
            continue
        some = np.argpartition(-scores, probes - 1, axis=1)[:, :probes]
        best = np.argsort(-np.take_along_axis(scores, some, axis=1), axis=1, kind="stable")
        out[start : start + step] = np.take_along_axis(some, best, axis=1)
    return out


def cell_runs(cells: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Row positions of each distinct cell in a batch."""
    if len(cells) == 0:
        return []
    order = np.argsort(cells, kind="stable")
    cuts = np.flatnonzero(np.diff(cells[order])) + 1
    return [(int(cells[run[0]]), run) for run in np.split(order, cuts)]


def count_ahead(
    queries: np.ndarray,
    expect: np.ndarray,
    expect_score: np.ndarray,
    docs: np.ndarray,
    ids: np.ndarray,
    present: np.ndarray,
    ahead: np.ndarray,
    best_wrong: np.ndarray,
) -> None:
    """Add one document block to per-query rank counters, in place.

    ``ahead`` counts documents ranked before the expected one (score descending,
    id ascending, missing vectors last); ``best_wrong`` is the highest score of
    any other document.  ``expect_score`` is NaN if the expected vector is missing.
    """
    step = max(1, _SMALL_TILE // max(1, min(_QUERIES, len(queries))))
    lost = np.isnan(expect_score)
    for first, start in product(range(0, len(queries), _QUERIES), range(0, len(docs), step)):
        some, part = slice(first, first + _QUERIES), slice(start, start + step)
        scores = np.round(queries[some] @ docs[part].T, SCORE_DIGITS)
        here, known = ids[part][None, :], present[part][None, :]
        wanted, hidden = expect_score[some, None], lost[some, None]
        other = here != expect[some, None]
        earlier = here < expect[some, None]
        better = (scores > wanted) | ((scores == wanted) & earlier)
        better = np.where(hidden, True, better) & known
        better |= hidden & ~known & earlier
        ahead[some] += (better & other).sum(axis=1)
        wrong = np.where(other & known, scores, -np.inf).max(axis=1)
        np.maximum(best_wrong[some], wrong, out=best_wrong[some])
