"""Blocks of cover trees: what travels, and what the products in single precision leave to decide."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_cover_tree import brute

from vecloom.llm import cover_tree
from vecloom.llm.cover_tree import build_tree, close_points, cosine_links, cover, distances, dual_traversal, unit_rows


def plans_of(monkeypatch):
    """Physical plans of the tables that are stored, by purpose."""
    plans, stored = {}, cover_tree.materialize

    def materialize(df, purpose):
        plans[purpose] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, purpose)

    monkeypatch.setattr(cover_tree, "materialize", materialize)
    return plans


def results(frame, **options):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in cosine_links(frame, **options).collect())


def expected(rows):
    return sorted((i, *found) for i, found in brute(rows).items())


def test_pairs_of_blocks_are_not_shuffled_where_all_meet(spark, monkeypatch):
    vectors = np.random.default_rng(3).normal(size=(400, 24))
    vectors[1::9] = vectors[0::9][:len(vectors[1::9])] + 0.1 * vectors[1::9]
    rows = [(i, v) for i, v in enumerate(vectors.astype(np.float32).tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    plans = plans_of(monkeypatch)
    assert results(frame, block_rows=16, max_cells=1) == expected(rows)
    assert "CartesianProduct" in plans["vector-links"] and "Exchange hashpartitioning" not in plans["vector-links"]
    # Numbers of single precision are kept as such, and vectors are stored once as points and once in blocks.
    assert "v#" in plans["points"] and "cast" not in plans["points"].replace("cast(vec_id", "")
    assert [p for p in plans if p in ("points", "routed", "trees")] == ["points", "trees"]


def test_blocks_that_few_others_meet_are_joined(spark, monkeypatch):
    centres = 10 * np.eye(12)
    rng = np.random.default_rng(5)
    rows = [(i, (centres[i % 12] + 0.3 * rng.normal(size=12)).astype(np.float32).tolist()) for i in range(300)]
    plans = plans_of(monkeypatch)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert results(frame, max_cells=16, block_rows=64) == expected(rows)
    assert "CartesianProduct" not in plans["vector-links"]


@pytest.mark.parametrize("distinct", [True, False])
def test_rows_find_their_points(spark, monkeypatch, distinct):
    if not distinct:  # digests that do not tell the points apart are not used
        monkeypatch.setattr(cover_tree.F, "xxhash64", lambda *_: F.lit(7).cast("long"))
    vectors = [[0.0, 1.0, 2.0], [-0.0, 1.0, 2.0], [0.0, 2.0, 4.0], [1.0, 0.0, -0.0], [1.0, -0.0, 0.0], [1e60, 1.0, 0.0], [1 + 1e-12, 1.0, 0.0]]
    rows = [(10 - i, v) for i, v in enumerate(vectors * 2)]
    assert results(spark.createDataFrame(rows, "vec_id long, embedding array<double>")) == expected(rows)


def test_ids_that_repeat_and_lengths_that_differ(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [1.0]), (4, [2.0]), (None, [1.0, 0.0]), (5, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in cosine_links(frame).collect()), key=str)
    assert got == sorted([(1, 2, 1, True)] * 2 + [(2, 2, 1, False), (3, 1, 3, True), (4, 1, 3, False), (None, 0, None, True), (5, 0, 5, True)], key=str)


def grouped(n, dim, seed, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(2, n // 12), dim))
    return unit_rows(centres[rng.integers(0, len(centres), n)] + spread * rng.normal(size=(n, dim)))


@pytest.mark.parametrize("dim", [3, 40, 64])
@pytest.mark.parametrize("spread", [0.0, 1e-4, 0.15, 0.4, 3.0])
@pytest.mark.parametrize("threshold", [0.5, 0.9, 0.99])
def test_large_blocks_count_every_pair(dim, spread, threshold):
    x, y = grouped(700, dim, 1, spread), grouped(900, dim, 1, spread)
    left, right = build_tree(x), build_tree(y)
    weight, weight2 = np.arange(1, 701), np.arange(1, 901)
    counts, _ = dual_traversal(left, right, weight, weight2, False, threshold)
    cross = left.points @ right.points.T >= threshold
    assert (counts == np.concatenate([cross @ weight2, cross.T @ weight])).all()
    counts, _ = dual_traversal(left, left, weight, weight, True, threshold)
    own = left.points @ left.points.T >= threshold
    np.fill_diagonal(own, False)
    assert (counts == own @ weight).all()


@pytest.mark.parametrize("dim", [5, 64, 300])
def test_close_points_are_those_of_double_precision(dim):
    x = grouped(900, dim, 4, 0.3)
    rng = np.random.default_rng(6)
    across = rng.normal(size=x.shape)
    across = unit_rows(across - np.einsum("ij,ij->i", across, x)[:, None] * x)
    # Cosines within 1e-9 of the threshold, which single precision can not decide.
    cosine = 0.9 + rng.choice([-1e-9, 1e-9], (len(x), 1))
    y = unit_rows(cosine * x + np.sqrt(1 - cosine ** 2) * across)
    found = sorted((int(i), int(j)) for a, b in close_points(x, y, 0.9) for i, j in zip(a, b, strict=True))
    assert found == sorted(zip(*(n.tolist() for n in np.nonzero(x @ y.T >= 0.9)), strict=True))


def test_centres_cover_all_points_in_order():
    x = grouped(1500, 8, 2, 0.5)
    for radius in (1.0, 0.5, 0.1):
        centres, owner = cover(x, radius)
        apart = distances(x, x[centres])
        assert (apart[np.arange(len(x)), owner] <= radius + 1e-9).all() and (owner[centres] == np.arange(len(centres))).all()
        between = distances(x[centres], x[centres])
        np.fill_diagonal(between, 2.0)
        assert between.min() > radius
        # Each point goes to the first centre that is near.
        assert ((apart <= radius).argmax(axis=1) == owner).all()
        assert len(cover(x, radius, most=3)[0]) > 3
