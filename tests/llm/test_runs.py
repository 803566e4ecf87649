"""Periodic runs against enumeration by definition."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from compare import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from vecloom.llm import runs
from vecloom.llm.queries import QUERIES

_WORD = re.compile("[^\x20\x09-\x0D]+")


def plain_runs(words, min_words=6, min_repeats=4):
    """All stretches of equal words a period apart, period by period; the smallest period of a stretch stays."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids, found = np.array([number[w] for w in words], dtype=np.int64), {}
    for q in range(1, len(words) // min_repeats + 1):
        edges = np.diff(np.concatenate([[0], ids[q:] == ids[:-q], [0]]).astype(int))
        for start, end in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
            if end - start + q >= max(min_words, min_repeats * q):
                found.setdefault((start, end - start + q), q)
    return sorted((s, q, n) for (s, n), q in found.items())


def as_tuples(found):
    return [tuple(int(x) for x in row) for row in found]


words = st.one_of(
    st.lists(st.integers(0, 2), max_size=60),
    st.builds(lambda head, body, times, tail: head + body * times + tail, st.lists(st.integers(0, 3), max_size=8),
              st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(1, 12), st.lists(st.integers(0, 3), max_size=8)),
)


@settings(max_examples=400, deadline=None)
@given(st.lists(words, max_size=4), st.sampled_from([(6, 4), (1, 3), (9, 3), (20, 5)]))
def test_runs_equal_definition(texts, limits):
    ids = np.array([w for t in texts for w in t], dtype=np.int64)
    found = runs.runs_of(ids, np.array([len(t) for t in texts], dtype=np.int64), *limits)
    assert as_tuples(found) == [(i, s, n, q) for i, t in enumerate(texts) for s, q, n in plain_runs(t, *limits)]


def test_one_word_many_times_is_one_run():
    assert as_tuples(runs.runs_of(np.zeros(50_000, np.int64), np.array([50_000]))) == [(0, 0, 50_000, 1)]


def test_fewer_than_three_repeats_are_refused():
    with pytest.raises(ValueError):
        runs.runs_of(np.zeros(9, np.int64), np.array([9]), 6, 2)


def plain_row(doc_id, text):
    words = _WORD.findall(text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    gone = {i for s, q, m in found for i in range(s + q, s + m)}
    best = min(((-m, s, q) for s, q, m in found), default=None)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    listed = digest("".join(f"{s},{m},{q}\n" for s, q, m in found))
    collapsed = digest(" ".join(w for i, w in enumerate(words) if i not in gone))
    top = (None, None, None, None) if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    return (doc_id, len(found), *top, listed, collapsed)


ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a b " * 20), (4, "a b " * 20), (4, "x" * 300_000), (None, "go " * 9),
    (5, "la la " * 6 + "é É " * 5), (6, "a b " * 7), (7, "one two three " * 4 + "one two four " * 5),
    (8, " ".join(str(i % 97) for i in range(30_000))), (9, "word"), (10, "퟿\U0001f600 " * 6),
]


def test_query_equals_brute_force_on_odd_texts(spark, tmp_path):
    # Ids up to 200 bring texts whose tail is made periodic.
    rows = ODD + [(i, " ".join(f"w{(i * j * j) % (i % 7 + 2)}" for j in range(i % 61))) for i in range(11, 200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted((plain_row(*r) for r in rows), key=repr)


def test_query_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()]
    expected = sorted((plain_row(*r) for r in docs), key=repr)
    assert sorted(got, key=repr) == expected
    assert any(r[1] for r in expected)


def test_empty_table_and_clashing_names(spark):
    schema = "doc_id long, text string, runs string, Collapsed int, found long"
    empty = runs.find_runs(spark.createDataFrame([], schema))
    assert empty.count() == 0 and empty.columns == ["doc_id", "text", "found", "runs", "collapsed"]
    (row,) = runs.find_runs(spark.createDataFrame([(1, "a " * 8, "x", 3, 4)], schema)).collect()
    assert row["found"] == 4 and row["collapsed"] == "a" and [tuple(r) for r in row["runs"]] == [(0, 8, 1)]
    (own,) = runs.find_runs(spark.createDataFrame([("a " * 8,)], "runs string"), text="runs").collect()
    assert own["collapsed"] == "a"
