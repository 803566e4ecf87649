"""Neighbour-graph search: recall, exact scores, shards, copies and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecloom.operators import graph
from vecloom.sources.scratch import materialize

TABLE = "/root/testdata/sf0.01/embeddings.parquet"


def unit(m):
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n > 0, n, 1)


def frame(spark, m, name=int, kind="long"):
    rows = [(name(i), [float(x) for x in v]) for i, v in enumerate(m)]
    return materialize(spark.createDataFrame(rows, f"id {kind}, embedding array<float>").repartition(4), "graph-test")


def built(spark, tmp_path, docs, spec, **named):
    graph.build_graph(docs, f"{tmp_path}/graph", spec, **named)
    return graph.load_graph(spark, f"{tmp_path}/graph")


def recall(rows, exact, k):
    """Share of the ``k`` nearest others that were found; every score must be the exact one."""
    found = {}
    for r in rows:
        assert abs(r["score"] - exact[r["q"], r["id"]]) < 2e-9
        if r["q"] != r["id"]:
            found.setdefault(r["q"], []).append((r["rank"], r["id"]))
    hits = []
    for q in {r["q"] for r in rows}:
        best = [j for j in np.lexsort((np.arange(exact.shape[1]), -exact[q])) if j != q][:k]
        hits.append(len(set(best) & {j for _, j in sorted(found.get(q, []))[:k]}) / k)
    return np.mean(hits)


def test_recall_on_the_given_table_across_shards(spark, tmp_path):
    e = spark.read.parquet(TABLE).select(F.col("vec_id").alias("id"), "embedding")
    rows = e.orderBy("id").collect()
    assert [r["id"] for r in rows] == list(range(len(rows)))
    m = unit(np.array([r["embedding"] for r in rows], dtype=float))
    index = built(spark, tmp_path, e, graph.GraphSpec(shard_rows=128), cells=4)
    assert index.nodes.select("shard").distinct().count() >= 4
    found = graph.graph_search(e, index, 6, probes=2, width=24, hops=1, exits=64, query_id="id").collect()
    assert len(found) == 6 * len(rows)
    assert recall(found, np.round(m @ m.T, 9), 5) >= 0.9


def test_clustered_data_compares_few_pairs(spark, tmp_path):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(40, 16))
    m = (centers[rng.integers(0, 40, 4000)] + 0.3 * rng.normal(size=(4000, 16))).astype(np.float32)
    docs = frame(spark, m)
    index = built(spark, tmp_path, docs, graph.GraphSpec(shard_rows=512))
    asked = docs.filter("id % 20 = 0")
    options = {"probes": 2, "width": 32, "hops": 1, "query_id": "id"}
    compared = graph.graph_candidates(asked, index, 6, **options).agg(F.sum("compared")).first()[0]
    assert compared < 0.25 * 200 * 4000
    exact = np.round(unit(m.astype(float)) @ unit(m.astype(float)).T, 9)
    assert recall(graph.graph_search(asked, index, 6, **options).collect(), exact, 5) >= 0.95


def near_random(rows, seed=8):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(rows // 5, 24)).repeat(5, axis=0) + 0.8 * rng.normal(size=(rows, 24))).astype(np.float32)


def test_cells_of_many_shards_are_walked_as_one(spark, tmp_path):
    m = near_random(6000)
    docs = frame(spark, m)
    index = built(spark, tmp_path, docs, graph.GraphSpec(shard_rows=128), cells=4)
    assert index.nodes.select("shard").distinct().count() >= 40
    asked = docs.filter("id % 20 = 0")
    options = {"probes": 1, "width": 16, "hops": 2, "exits": 64, "query_id": "id"}
    found = graph.graph_candidates(asked, index, 6, **options)
    assert found.groupBy("q").count().agg(F.max("count")).first()[0] <= 4 * 6  # a row for each answer of a cell, not of a shard
    exact = np.round(unit(m.astype(float)) @ unit(m.astype(float)).T, 9)
    assert recall(graph.graph_search(asked, index, 6, **options).collect(), exact, 5) >= 0.9


def test_large_cells_have_several_groups_and_finer_cells_of_first_neighbours(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(graph, "_FIRST", 24 * 700)
    monkeypatch.setattr(graph, "_GROUP", 24 * 512)
    monkeypatch.setattr(graph, "_QUERIES", 24 * 40)
    m = near_random(3000)
    docs = frame(spark, m)
    index = built(spark, tmp_path, docs, graph.GraphSpec(shard_rows=64), cells=2)
    assert index.nodes.groupBy("grp").count().agg(F.max("count")).first()[0] <= 2 * 512
    assert index.nodes.select("grp").distinct().count() == index.shards.agg(F.sum("groups")).first()[0] >= 6
    asked = docs.filter("id % 20 = 0")
    rows = graph.graph_search(asked, index, 6, probes=1, width=16, hops=2, exits=64, query_id="id", query_block=16).collect()
    exact = np.round(unit(m.astype(float)) @ unit(m.astype(float)).T, 9)
    assert recall(rows, exact, 5) >= 0.9


def test_rounds_find_more_neighbours(spark):
    m = unit(np.random.default_rng(4).normal(size=(600, 12)))
    nodes = frame(spark, m).select(F.col("id").alias("node"), F.col("embedding").alias("vec"))
    spec = graph.GraphSpec(degree=10, sample=10)
    exact = m @ m.T
    np.fill_diagonal(exact, -2)
    truth = {(i, j) for i in range(600) for j in np.argsort(-exact[i])[:10]}
    start = np.random.default_rng(1)
    some = [(i, int(j), float(exact[i, j])) for i in range(600) for j in start.choice(600, 10, replace=False) if i != j]
    edges, seen = spark.createDataFrame(some, "node long, near long, score double"), []
    for _ in range(4):
        edges = materialize(edges, "graph-test")
        pairs = [(r["node"], r["near"]) for r in edges.collect()]
        assert len(set(pairs)) == len(pairs) and all(a != b for a, b in pairs)
        seen.append(len(truth & set(pairs)) / len(truth))
        edges = graph.improve(nodes, edges, spec)
    assert seen[0] < 0.1 and seen[-1] > 0.5 and seen == sorted(seen)


@pytest.mark.parametrize("name, kind", [(int, "long"), (lambda i: f"row{i:04d}", "string")])
def test_a_third_of_all_rows_are_copies(spark, tmp_path, name, kind):
    m = np.random.default_rng(5).normal(size=(300, 6)).astype(np.float32)
    m[::3] = m[0]
    docs = frame(spark, m, name, kind)
    index = built(spark, tmp_path, docs, graph.GraphSpec(shard_rows=64), cells=3)
    assert index.nodes.count() == 201
    rows = graph.graph_search(docs, index, 4, probes=3, query_id="id").collect()
    assert len(rows) == 1200
    copies = sorted((r["rank"], r["id"]) for r in rows if r["q"] == name(150))
    assert [i for _, i in copies] == [name(0), name(3), name(6), name(9)]


def test_odd_rows_and_empty_tables(spark, tmp_path):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [0.6, 0.8]), (5, [-1.0, 0.0])]
    docs = spark.createDataFrame(rows, "id long, embedding array<float>")
    index = built(spark, tmp_path, docs, graph.GraphSpec())
    found = graph.graph_search(docs, index, 5, query_id="id").collect()
    assert {r["q"] for r in found} == {r["id"] for r in found} == {0, 4, 5}
    assert [r["id"] for r in sorted(found, key=lambda r: r["rank"]) if r["q"] == 4] == [4, 0, 5]
    assert graph.graph_search(docs.limit(0), index, 5, query_id="id").collect() == []
    empty = built(spark, tmp_path, docs.filter("id > 9"), graph.GraphSpec())
    assert graph.graph_search(docs, empty, 5, query_id="id").collect() == []
    with pytest.raises(ValueError):
        graph.graph_search(docs, index, 0)


def test_parts_are_the_connected_ones():
    rng = np.random.default_rng(6)
    for _ in range(50):
        n = int(rng.integers(1, 30))
        links = np.where(rng.random((n, 3)) < 0.4, rng.integers(0, n, (n, 3)), -1)
        part = list(range(n))
        for i, j in [(i, j) for i in range(n) for j in links[i] if j >= 0] * n:
            part[i] = part[j] = min(part[i], part[j])
        assert graph.parts_of(links).tolist() == part


def test_walk_over_all_links_is_exact():
    rng = np.random.default_rng(7)
    vectors, queries = unit(rng.normal(size=(50, 5))), unit(rng.normal(size=(9, 5)))
    ring = np.stack([(np.arange(50) + 1) % 50, (np.arange(50) - 1) % 50, np.full(50, -1)], axis=1)
    places, scores, compared = graph.walk(queries, vectors, ring, np.full((9, 1), 3), 50)
    assert (compared == 50).all()
    assert (places == np.argsort(-(queries @ vectors.T), axis=1)).all()
    assert np.allclose(scores, -np.sort(-(queries @ vectors.T), axis=1))
