"""Filtered search: skipped cells, promised matches, recall and odd attributes."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_graph import recall, unit
from test_knn import brute, got

from vecloom.operators import filtered
from vecloom.operators.filtered import Condition


def clustered(spark, n=900, groups=9, seed=1):
    """Rows whose group, year and tag follow their cluster."""
    rng = np.random.default_rng(seed)
    centers = 3 * rng.normal(size=(groups, 8))
    group = rng.integers(0, groups, n)
    m = (centers[group] + 0.3 * rng.normal(size=(n, 8))).astype(np.float32)
    rows = [(i, [float(x) for x in m[i]], f"g{g}", 2000 + int(g), None if i % 5 == 0 else i % 3) for i, g in enumerate(group)]
    return spark.createDataFrame(rows, "id long, embedding array<float>, grp string, year int, tag int"), m, group


def indexed(spark, tmp_path, docs, attributes, cells=None, **named):
    filtered.build_filtered(docs, f"{tmp_path}/index", attributes, cells, **named)
    return filtered.load_filtered(spark, f"{tmp_path}/index")


def test_cells_without_a_match_are_not_scanned(spark, tmp_path):
    docs, m, group = clustered(spark)
    index = indexed(spark, tmp_path, docs, ["grp", "year"], 9)
    for where in ([Condition("grp", values=("g3",))], [Condition("year", low=2003, high=2003)]):
        cells = filtered.matches(index, where)
        with_match = {r["cell"] for r in index.docs.filter("grp = 'g3'").select("cell").distinct().collect()}
        assert set(cells) == with_match and len(cells) < 9
        result = filtered.search_where(docs, index, where, 4, query_id="id")
        plan = result._jdf.queryExecution().executedPlan().toString()
        pruned = [line for line in plan.splitlines() if "PartitionFilters" in line and "cell" in line.split("PartitionFilters")[1]]
        assert pruned
        names = index.docs.filter(F.col("cell").isin(sorted(cells))).select(F.input_file_name().alias("f")).distinct().collect()
        assert {int(r["f"].split("cell=")[1].split("/")[0]) for r in names} == set(cells)
        ids = np.flatnonzero(group == 3)
        assert got(result) == brute(m, m[ids], 4, d_ids=ids)


def test_recall_inside_a_filter_on_the_given_table(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding", "label")
    index = indexed(spark, tmp_path, e, ["label"], 16)
    m = unit(np.array([r["embedding"] for r in e.orderBy("id").collect()], dtype=float))
    labels = np.array([r["label"] for r in e.orderBy("id").collect()])
    exact = np.round(m @ m.T, 9)
    inside = np.where(labels[None, :] == 4, exact, -2.0)
    asked = e.filter("id % 4 = 0")
    rows = filtered.search_where(asked, index, [Condition("label", values=(4,))], 6, probes=4, least_rows=170, query_id="id").collect()
    assert {labels[r["id"]] for r in rows} == {4}
    assert recall(rows, inside, 5) >= 0.9


def test_promises_are_exact_for_counted_values(spark, tmp_path):
    docs, _, group = clustered(spark)
    index = indexed(spark, tmp_path, docs, ["grp", "tag"], 9)
    found = filtered.matches(index, [Condition("grp", values=("g1", "g2", "none"))])
    assert sum(found.values()) == pytest.approx(((group == 1) | (group == 2)).sum())
    tagged = filtered.matches(index, [Condition("tag", low=1)])
    assert sum(tagged.values()) == pytest.approx(sum(i % 5 and i % 3 >= 1 for i in range(900)))
    assert filtered.matches(index, [Condition("grp", values=("none",))]) == {}
    assert filtered.matches(index, [Condition("grp", values=())]) == {}
    assert len(filtered.matches(index, [Condition("unknown", values=(1,))])) == len(index.summaries)


def test_many_values_fall_back_to_bounds(spark, tmp_path):
    docs, m, _ = clustered(spark)
    index = indexed(spark, tmp_path, docs, ["id", "grp"], 4, max_values=3)
    assert all(s["attributes"]["id"]["counts"] is None for s in index.summaries.values())
    assert filtered.matches(index, [Condition("id", low=5_000)]) == {}
    where = [Condition("id", low=100, high=300), Condition("grp", low="g2")]
    rows = docs.filter("id between 100 and 300 and grp >= 'g2'").select("id").collect()
    ids = np.array(sorted(r["id"] for r in rows))
    result = filtered.search_where(docs, index, where, 3, probes=4, query_id="id")
    assert got(result) == brute(m, m[ids], 3, d_ids=ids)


def test_odd_rows(spark, tmp_path):
    rows = [(0, [1.0, 0.0], 1), (1, None, 1), (2, [0.0, 0.0], 1), (3, [1.0, None], 1), (4, [0.6, 0.8], None), (5, [-1.0, 0.0], 2)]
    docs = spark.createDataFrame(rows, "id long, embedding array<float>, tag int")
    index = indexed(spark, tmp_path, docs, ["tag"], centroids=np.array([[1.0, 0.0], [-1.0, 0.0]]))
    assert got(filtered.search_where(docs, index, [Condition("tag", values=(1, None))], 3, query_id="id")) == {
        (q, i, r) for q, order in ((0, (0, 2)), (4, (0, 2)), (5, (2, 0))) for r, i in enumerate(order, 1)}
    assert filtered.search_where(docs, index, [Condition("tag", values=(9,))], 3, query_id="id").collect() == []
    for wrong in ({}, {"values": (1,), "low": 2}):
        with pytest.raises(ValueError):
            Condition("tag", **wrong)
