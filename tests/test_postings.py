"""Impact-ordered postings: exact answers, early stop, pruned files, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_graph import frame
from test_knn import brute, got

from vecloom.functions import HASHING_WHOLE
from vecloom.operators import knn, postings
from vecloom.sources import maintenance, scratch


def indexed(spark, tmp_path, docs, **named):
    postings.build_postings(docs, f"{tmp_path}/postings", **named)
    return postings.load_postings(spark, f"{tmp_path}/postings")


def asked_of(queries):
    return queries.select(F.col("id").alias("q"), F.col("embedding").alias("vec"))


def sparse(rng, rows, dim=60, share=0.1):
    m = rng.normal(size=(rows, dim)) * (rng.random((rows, dim)) < share)
    m[np.arange(rows), rng.integers(0, dim, rows)] += 1.0
    return m.astype(np.float32)


@pytest.mark.parametrize("few_rows", [scratch._SMALL_ROWS, 0])
def test_equals_brute_force(spark, tmp_path, monkeypatch, few_rows):
    """With cells and candidates sent to the tasks, and with salted shuffled joins."""
    monkeypatch.setattr(scratch, "_SMALL_ROWS", few_rows)
    monkeypatch.setattr(postings, "_CELL_ROWS", 7)
    rng = np.random.default_rng(1)
    d, q = sparse(rng, 400), sparse(rng, 25)
    d[::3] = d[0]
    q[0] = d[0]
    index = indexed(spark, tmp_path, frame(spark, d), buckets=4)
    assert got(postings.postings_search(frame(spark, q), index, 6, query_id="id")) == brute(q, d, 6)


def test_scores_equal_the_exact_join(spark, tmp_path):
    docs = frame(spark, sparse(np.random.default_rng(2), 200))
    index = indexed(spark, tmp_path, docs)
    key = lambda r: (r["q"], r["rank"])
    ours = sorted(postings.postings_search(docs, index, 4, query_id="id").collect(), key=key)
    exact = sorted(knn.knn_join(docs, docs, 4, query_id="id").collect(), key=key)
    assert [(r["q"], r["id"], r["rank"]) for r in ours] == [(r["q"], r["id"], r["rank"]) for r in exact]
    assert np.allclose([r["score"] for r in ours], [r["score"] for r in exact], atol=2e-9)


def test_texts_stop_early(spark, tmp_path):
    """Short texts with few strong matches: most postings of the query's own terms stay unread."""
    rng = np.random.default_rng(3)
    words = np.array([f"w{i}" for i in range(3000)])
    weights = 1 / np.arange(1, 3001)
    texts = [" ".join(rng.choice(words, rng.integers(20, 60), p=weights / weights.sum())) for _ in range(2000)]
    for i in range(20):
        texts[100 * i] = "rare1 rare2 rare3"
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(4)
    docs = scratch.materialize(maintenance.encode_documents(docs, "text", HASHING_WHOLE).select("id", "embedding"), "postings-test")
    index = indexed(spark, tmp_path, docs)
    queries = docs.filter("id in (100, 300)")
    asked = asked_of(queries)
    plan = postings.plan_reads(asked, index, 10)
    for r in postings.share_read(plan, asked, index).collect():
        assert r["read"] < 0.2 * r["listed"] and r["read"] < 0.01 * r["indexed"]
    assert postings.candidates(plan, index).count() < 2 * 60
    assert got(postings.postings_search(queries, index, 10, query_id="id")) == got(knn.knn_join(queries, docs, 10, query_id="id"))


def test_only_named_tiers_and_buckets_are_scanned(spark, tmp_path):
    rng = np.random.default_rng(4)
    index = indexed(spark, tmp_path, frame(spark, sparse(rng, 300)), buckets=16)
    wanted = spark.createDataFrame([(0, 3, 4, 1.0, 5)], "q long, term int, tier int, weight double, n long")
    read = postings._postings_of(index, wanted)
    scan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tier" in scan and "PushedFilters: [IsNotNull(term), EqualTo(term,3)" in scan
    assert {f.split("/tier=")[1].split("/")[0] for f in read.select("id", F.input_file_name().alias("f")).toPandas()["f"]} <= {"4"}
    found = spark.createDataFrame([(0, 7)], "q long, id long")
    asked = spark.createDataFrame([(0, [1.0] * 60)], "q long, vec array<float>")
    assert "PartitionFilters: [isnotnull(bucket" in postings._exact(found, asked, index)._jdf.queryExecution().executedPlan().toString()


def test_bounds_hold_for_every_row(spark, tmp_path):
    """What is unread after each cell is never less than what any row has there."""
    rng = np.random.default_rng(5)
    d, q = sparse(rng, 60, dim=12, share=0.5), sparse(rng, 3, dim=12, share=0.5)
    index = indexed(spark, tmp_path, frame(spark, d))
    lists = {}
    for r in index.postings.collect():
        lists.setdefault((r["term"], r["tier"]), {})[r["id"]] = r["impact"]
    levels = postings.reading_order(asked_of(frame(spark, q)), index.cells).collect()
    for name in range(3):
        own = sorted((r for r in levels if r["q"] == name), key=lambda r: -r["left"])
        for place, cell in enumerate(own):
            unread = [sum(r["weight"] * lists[r["term"], r["tier"]].get(i, 0.0) for r in own[place + 1:]) for i in range(60)]
            assert max(unread) <= cell["left"] + 1e-9


def test_odd_rows_and_empty_tables(spark, tmp_path):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [0.6, 0.8]), (5, [-1.0, 0.0]), (6, [2.0, 0.0])]
    docs = spark.createDataFrame(rows, "id long, embedding array<float>")
    index = indexed(spark, tmp_path, docs)
    for k in (2, 9):
        ours, exact = postings.postings_search(docs, index, k, query_id="id"), knn.knn_join(docs, docs, k, query_id="id")
        assert got(ours) == got(exact)
    assert postings.postings_search(docs.limit(0), index, 3, query_id="id").collect() == []
    empty = indexed(spark, tmp_path / "empty", docs.filter("id > 9"))
    assert postings.postings_search(docs, empty, 3, query_id="id").collect() == []
    with pytest.raises(ValueError):
        postings.postings_search(docs, index, 0, query_id="id")


def test_text_ids(spark, tmp_path):
    d = sparse(np.random.default_rng(6), 80)
    docs = frame(spark, d, name=lambda i: f"row{i:03}", kind="string")
    index = indexed(spark, tmp_path, docs)
    names = np.array([f"row{i:03}" for i in range(80)])
    assert got(postings.postings_search(docs, index, 3, query_id="id")) == brute(d, d, 3, names, names)


def test_a_norm_is_computed_once_a_row(spark):
    rows = spark.createDataFrame([(1, [3.0, 4.0])], "id int, vec array<float>")
    terms = postings.signed_terms(rows, "vec", "impact", "id")
    plan = terms._jdf.queryExecution().optimizedPlan().toString().splitlines()
    above = next(i for i, line in enumerate(plan) if "Generate" in line)
    assert not any("aggregate(" in line for line in plan[:above]) and any("aggregate(" in line for line in plan[above:])
    assert sorted(tuple(r) for r in terms.select("term", "impact").collect()) == [(0, 0.6), (2, 0.8)]
