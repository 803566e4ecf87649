"""What a task holds at once is bounded, whatever the sides' sizes."""

import tracemalloc

import numpy as np
import pyarrow as pa

from vecloom.functions import encoders, kernels
from vecloom.operators import knn, quantized


def peak_mb(work):
    tracemalloc.start()
    try:
        result = work()
        return result, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def units(rows, dim, seed=0):
    return kernels.unit_rows(np.random.default_rng(seed).normal(size=(rows, dim)))


def test_score_tiles_of_a_running_top_k(monkeypatch):
    sizes, collect = [], kernels.TopK._collect
    monkeypatch.setattr(kernels.TopK, "_collect", lambda self, scores, *rest: (sizes.append(scores.size), collect(self, scores, *rest))[1])
    queries, docs = units(9_000, 4), units(700, 4, 1)
    state = kernels.TopK(len(queries), 3)
    state.add(queries, np.arange(len(queries)), docs, np.arange(len(docs)))
    query, score, ids = state.result()
    assert max(sizes) <= kernels._SMALL_TILE
    scores = np.round(queries @ docs.T, 9)
    for q in (0, 4_095, 4_096, 8_999):
        best = np.lexsort((np.arange(len(docs)), -scores[q]))[:3]
        assert ids[query == q].tolist() == best.tolist()


def test_counters_of_many_queries():
    queries, docs = units(20_000, 4), units(600, 4, 1)
    expect = np.arange(len(queries)) % len(docs)
    scores = np.round(queries @ docs.T, 9)
    own = scores[np.arange(len(queries)), expect]
    own[7] = np.nan
    ahead, wrong = np.zeros(len(queries), dtype=np.int64), np.full(len(queries), -np.inf)
    count = lambda: kernels.count_ahead(queries, expect, own, docs, np.arange(600), np.ones(600, dtype=bool), ahead, wrong)
    _, peak = peak_mb(count)
    assert peak < 60
    for q in (0, 4_096, 19_999):
        other = np.arange(600) != expect[q]
        assert ahead[q] == ((scores[q] > own[q]) | ((scores[q] == own[q]) & (np.arange(600) < expect[q])))[other].sum()
        assert wrong[q] == scores[q][other].max()
    assert ahead[7] == 599


def test_fitting_a_codebook():
    rows = pa.table({"part": np.zeros(50_000, dtype=np.int32), "draw": np.arange(50_000),
                     "piece": pa.array(units(50_000, 8).tolist(), pa.list_(pa.float64()))})
    books, peak = peak_mb(lambda: quantized._lloyd(256, 2, 42)(rows))
    assert books.num_rows == 256 and peak < 120


def test_words_of_a_large_batch_are_cut_in_slices(spark, monkeypatch):
    seen, by_row = [], encoders._words_by_row
    monkeypatch.setattr(encoders, "_words_by_row", lambda texts, limit: (seen.append(texts.nbytes), by_row(texts, limit))[1])
    texts = pa.array([f"Word{i} " * 2_000 for i in range(800)] + [None, ""])
    found = encoders.words("text")  # a session is needed only to make the column
    assert found is not None
    lists = encoders.word_lists(texts)
    assert max(seen) <= encoders._SLICE_BYTES and len(lists) == len(texts)
    assert lists[3].as_py() == ["word3"] * 2_000 and lists[800].as_py() is None and lists[801].as_py() == []


def test_a_broadcast_side_of_the_join():
    assert knn.DEFAULT_LIMITS.broadcast_bytes <= 32 << 20
