"""Dual traversal against brute force."""

import numpy as np
import pytest
from compare import SF_DIR

from vecloom.llm.cover_tree import build_tree, cosine_links, dual_traversal, unit_rows
from vecloom.llm.queries import QUERIES


def clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    spread = rng.choice([1e-9, 0.02, 0.2, 1.0], size=(n, 1))
    return centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dim))


def brute(rows, threshold=0.9):
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {i: [] for i, _ in rows}
    for a, (i, x) in enumerate(good):
        for j, y in good[a + 1:]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[i].append(j)
                links[j].append(i)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            new = set(links[todo.pop()]) - seen
            seen |= new
            todo += new
        out[i] = (len(links[i]), min(seen), i == min(seen))
    return out


@pytest.mark.parametrize("dim", [2, 8, 64])
@pytest.mark.parametrize("same", [True, False])
def test_traversal_counts_every_pair(dim, same):
    x, y = unit_rows(clustered(400, dim, 1)), unit_rows(clustered(300, dim, 2))
    weight, weight2 = np.arange(1, 401), np.arange(1, 301)
    left, right = build_tree(x, 8), build_tree(y, 8)
    assert sorted(left.order) == list(range(400))
    for v, kids in enumerate(left.children):
        if len(kids):
            assert left.first[kids[0]] == left.first[v] and left.last[kids[-1]] == left.last[v]
    if same:
        counts, root = dual_traversal(left, left, weight[left.order], weight[left.order], True)
        adjacent = left.points @ left.points.T >= 0.9
        np.fill_diagonal(adjacent, False)
        assert (counts == adjacent @ weight[left.order]).all()
    else:
        counts, root = dual_traversal(left, right, weight[left.order], weight2[right.order], False)
        cross = left.points @ right.points.T >= 0.9
        assert (counts == np.concatenate([cross @ weight2[right.order], cross.T @ weight[left.order]])).all()
        adjacent = np.block([[np.zeros((400, 400), bool), cross], [cross.T, np.zeros((300, 300), bool)]])
    reached = np.arange(len(adjacent))
    for _ in range(60):
        reached = np.minimum(reached, np.where(adjacent, reached[None, :], len(adjacent)).min(axis=1))
    assert (reached == root).all()


def test_equals_brute_force_with_odd_vectors(spark):
    vectors = clustered(150, 6, 4).astype(np.float32).tolist()
    vectors += [vectors[0]] * 5 + [(2 * np.float32(vectors[1])).tolist()]
    vectors += [None, [], [0.0] * 6, [1.0, None] + [0.0] * 4, [float("nan")] * 6, [float("inf")] + [0.0] * 5, [1.0, 2.0], [1.0, 2.1]]
    rows = [(i + 10, v) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    rows = [(i, [None if x is None else float(np.float32(x)) for x in v] if v is not None else None) for i, v in rows]
    for options in ({}, {"block_rows": 16, "max_cells": 12}):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cosine_links(frame, **options).collect()}
        assert got == brute(rows)


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in QUERIES["op2_cover_tree_near_dedup"](spark, SF_DIR).collect()}
    assert got == brute(rows)


def test_empty_table(spark):
    assert cosine_links(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
