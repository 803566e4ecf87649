"""The Jaccard join against brute force over all pairs."""

import random
import re

import numpy as np
import pytest

from vecloom.llm.ngram_join import jaccard_links, keep_one_per_group, least_matches
from vecloom.llm.textbytes import shingle_sets

_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, k=5, threshold=0.8):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[A-Za-z0-9_\x80-\U0010ffff]+", (text or "").translate(_ASCII_LOWER))
        sets[i] = {tuple(words[j:j + k]) for j in range(max(1, len(words) - k + 1))} if words else set()
    links = {i: set() for i in sets}
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if both >= threshold * len(sets[i] | sets[j]) - 1e-9:
                    links[i].add(j)
                    links[j].add(i)
    out = {}
    for i in sets:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        same = min([j for j in sets if sets[j] == sets[i] and sets[i]] + [i])
        out[i] = (same, len(links[i]), min(seen))
    return out


def near_copies(seed=3):
    rng = random.Random(seed)
    words = [f"w{n}" for n in range(400)] + ["Été", "straße", "naïve"]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  two!"), (6, "one two three four five")]
    for group in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([6, 40, 120]))]
        for _ in range(rng.choice([1, 3, 25])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows) + 100, rng.choice([" ", "\n", ", "]).join(copy)))
    return rows


def test_equals_brute_force(spark):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.class_id, r.n_links, r.component_id) for r in jaccard_links(docs).collect()}
    assert got == brute(rows)


def test_blocks_give_the_same_links(spark, monkeypatch):
    import vecloom.llm.ngram_join as module

    monkeypatch.setattr(module, "BUCKET_BLOCK", 4)
    monkeypatch.setattr(module, "GROUP_BLOCK", 4)
    rows = near_copies(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links, r.component_id) for r in jaccard_links(docs).collect()}
    assert got == brute(rows)


def test_filter_keeps_one_and_other_columns(spark):
    text = " ".join(f"a{n}" for n in range(60))
    rows = [(5, text, 1, "x"), (3, text + " b", 2, "y"), (9, "something else entirely is written here", 3, "z"), (None, text, 4, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int, n_links string")
    kept = keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.component_id) for r in kept.collect()) == [(0, 4), (3, 2), (9, 3)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_links(docs).count() == 0


@pytest.mark.parametrize("text", ["", "a", "a b c d", "a b c d e f a b c d e f", "ÄÖ " * 30, "x" * 100_000])
def test_shingles_count_distinct_runs(text):
    import pyarrow as pa

    words = text.split()
    expected = {tuple(words[j:j + 5]) for j in range(max(1, len(words) - 4))} if words else set()
    first, second = shingle_sets(pa.array(["pad pad", text]), 5)
    assert len(second) == len(expected)
    assert (np.sort(second) == second).all()


def test_pruning_bounds_rise():
    bounds = least_matches(0.8, 1e-6)
    assert bounds == sorted(bounds) and 0 < bounds[-1] < 0.8 * 128


def test_different_texts_under_one_id(spark):
    first = " ".join(f"a{i}" for i in range(100))
    second = " ".join(f"b{i}" for i in range(100))
    clean = " ".join(f"c{i}" for i in range(100))
    rows = [(1, first), (1, second), (1, ""), (2, first + " end"), (3, second + " end"), (3, clean), (4, clean + " end"), (5, first)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in jaccard_links(docs).select("doc_id", "class_id", "n_links", "component_id").collect())
    assert got == sorted([
        (1, 1, 2, 1), (1, 1, 1, 1), (1, 1, 0, 1), (2, 2, 2, 1), (3, 3, 1, 1), (3, 3, 1, 3), (4, 4, 1, 3), (5, 1, 2, 1),
    ])
    kept = sorted((r.doc_id, r.text) for r in keep_one_per_group(docs).collect())
    assert kept == sorted([(1, first), (1, second), (1, ""), (3, clean)])
