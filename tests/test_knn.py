import numpy as np
import pytest
from pyspark.sql import functions as F

from vecloom.functions import kernels
from vecloom.operators import ann, knn

GRID = knn.KnnLimits(max_broadcast_rows=5, max_passes=0, query_block=16, doc_block=32)
PASSES = knn.KnnLimits(max_broadcast_rows=14, max_passes=50)
FORMS = {"broadcast": knn.DEFAULT_LIMITS, "passes": PASSES, "grid": GRID}


def unit(m):
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n > 0, n, 1)


def brute(q, d, k, q_ids=None, d_ids=None):
    scores = np.round(unit(q.astype(float)) @ unit(d.astype(float)).T, 9)
    q_ids = range(len(q)) if q_ids is None else q_ids
    d_ids = np.arange(len(d)) if d_ids is None else d_ids
    out = set()
    for i, name in enumerate(q_ids):
        for rank, j in enumerate(np.lexsort((d_ids, -scores[i]))[:k]):
            out.add((name, d_ids[j].item(), rank + 1))
    return out


def frame(spark, m, kind="long", name=int):
    rows = [(name(i), v.tolist()) for i, v in enumerate(m)]
    return spark.createDataFrame(rows, f"id {kind}, embedding array<float>").repartition(5)


def got(df):
    return {(r["q"], r["id"], r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("form", FORMS)
def test_knn_matches_brute_force(spark, form):
    rng = np.random.default_rng(1)
    q, d = rng.normal(size=(40, 12)).astype(np.float32), rng.normal(size=(300, 12)).astype(np.float32)
    result = knn.knn_join(frame(spark, q), frame(spark, d), 7, query_id="id", limits=FORMS[form])
    assert got(result) == brute(q, d, 7)


@pytest.mark.parametrize("form", FORMS)
def test_a_third_of_all_rows_are_copies(spark, form):
    rng = np.random.default_rng(2)
    d = rng.normal(size=(300, 8)).astype(np.float32)
    d[::3] = d[0]
    result = knn.knn_join(frame(spark, d), frame(spark, d), 5, query_id="id", limits=FORMS[form])
    assert got(result) == brute(d, d, 5)


@pytest.mark.parametrize("form", FORMS)
def test_odd_vectors(spark, form):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [1.0]), (4, [1.0, None]), (5, [0.0, 2.0]), (6, [3.0, 0.0]),
            (7, [-1.0, 0.0])]
    docs = spark.createDataFrame(rows, "id long, embedding array<float>")
    queries = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(6)] + [(9, None)], "id long, embedding array<float>")
    result = knn.knn_join(queries, docs, 10, query_id="id", limits=FORMS[form]).filter("q <> 9")
    order = [r["id"] for r in result.filter("q = 3").orderBy("rank").collect()]
    assert order == [0, 6, 2, 3, 5, 7]
    assert result.select("q").distinct().count() == 6


@pytest.mark.parametrize("form", FORMS)
def test_text_ids(spark, form):
    rng = np.random.default_rng(4)
    d = rng.normal(size=(30, 4)).astype(np.float32)
    name = lambda i: f"doc-{i:02d}"
    result = knn.knn_join(frame(spark, d, "string", name), frame(spark, d, "string", name), 3, query_id="id", limits=FORMS[form])
    want = {(name(a), name(b), r) for a, b, r in brute(d, d, 3)}
    assert got(result) == want


def test_fewer_documents_than_k_and_bad_k(spark):
    d = np.eye(3, dtype=np.float32)
    assert knn.knn_join(frame(spark, d), frame(spark, d), 10, query_id="id").count() == 9
    with pytest.raises(ValueError):
        knn.knn_join(frame(spark, d), frame(spark, d), 0, query_id="id")


def test_empty_sides(spark):
    d = frame(spark, np.eye(3, dtype=np.float32))
    assert knn.knn_join(d.limit(0), d, 2, query_id="id").count() == 0
    assert knn.knn_join(d, d.limit(0), 2, query_id="id").count() == 0


def test_top_k_buffer_is_exact_when_it_overflows():
    rng = np.random.default_rng(5)
    q, d = unit(rng.normal(size=(20, 6))), unit(rng.normal(size=(5000, 6)))
    d[1000:3000] = d[7]
    state = kernels.TopK(20, 9)
    state._limit = 50
    for start in range(0, 5000, 333):
        state.add(q, np.arange(20), d[start : start + 333], np.arange(5000)[start : start + 333])
    query, _, ids = state.result()
    scores = np.round(q @ d.T, 9)
    for i in range(20):
        assert list(ids[query == i]) == list(np.lexsort((np.arange(5000), -scores[i]))[:9])


def test_documents_stay_where_they_are(spark, tmp_path):
    d = np.random.default_rng(7).normal(size=(200, 6)).astype(np.float32)
    path = str(tmp_path / "docs")
    frame(spark, d).write.parquet(path)
    docs = spark.read.parquet(path).withColumnRenamed("embedding", "vec").selectExpr("0 AS cell", "id", "vec")
    queries = docs.selectExpr("id AS q", "cell", "vec").limit(60)
    # Three times the budget: several passes, whose only exchange carries (q, id, score).
    found = knn.cell_topk(queries, docs, 3, knn.KnnLimits(max_broadcast_rows=20))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") >= 3
    assert not [line for line in plan.splitlines() if "Exchange" in line and "vec" in line]


def test_small_side_follows_the_byte_budget(spark):
    d = frame(spark, np.eye(8, dtype=np.float32))
    assert knn.small_side(d, "id", "embedding", knn.KnnLimits(broadcast_bytes=8 * 32)).num_rows == 8
    assert knn.small_side(d, "id", "embedding", knn.KnnLimits(broadcast_bytes=7 * 32)) is None


def clustered(rng, n=400, dim=16, centers=8):
    heart = rng.normal(size=(centers, dim)) * 4
    return (heart[rng.integers(0, centers, n)] + rng.normal(size=(n, dim))).astype(np.float32)


def recall(found, want):
    pairs = {(q, i) for q, i, _ in want}
    return len({(q, i) for q, i, _ in found} & pairs) / len(pairs)


def test_ivf_recall_and_exactness(spark, tmp_path):
    d = clustered(np.random.default_rng(8))
    docs, want = frame(spark, d), brute(d, d, 5)
    path = str(tmp_path / "ivf")
    ann.build_ivf(docs, path, 8)
    index, centroids = ann.load_ivf(spark, path)
    for limits in FORMS.values():
        assert got(ann.ivf_search(docs, index, centroids, 5, 8, query_id="id", limits=limits)) == want
    some = got(ann.ivf_search(docs, index, centroids, 5, 2, query_id="id"))
    assert recall(some, want) > 0.9
    assert some == got(ann.ivf_search(docs, index, centroids, 5, 2, query_id="id", limits=GRID))


def test_ivf_prunes_partitions(spark, tmp_path):
    d = clustered(np.random.default_rng(9))
    path = str(tmp_path / "ivf")
    ann.build_ivf(frame(spark, d), path, 8)
    index, centroids = ann.load_ivf(spark, path)
    plan = ann.ivf_search(frame(spark, d[:1]), index, centroids, 3, 1, query_id="id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan


def test_one_cell_with_everything_is_split(spark):
    d = np.random.default_rng(10).normal(size=(200, 6)).astype(np.float32)
    docs = frame(spark, d)
    q = docs.select(F.col("id").alias("q"), F.lit(3).alias("cell"), F.col("embedding").alias("vec"))
    side = docs.select(F.lit(3).alias("cell"), "id", F.col("embedding").alias("vec"))
    assert got(knn.cell_topk(q, side, 4, GRID)) == brute(d, d, 4)


@pytest.mark.parametrize("form", FORMS)
def test_lsh_recall(spark, form):
    d = clustered(np.random.default_rng(11))
    docs, want = frame(spark, d), brute(d, d, 5)
    found = got(ann.lsh_search(docs, docs, 5, query_id="id", tables=8, per_table=4, limits=FORMS[form]))
    assert recall(found, want) > 0.9
    assert len({(q, i) for q, i, _ in found}) == len(found)


def test_zero_and_null_elements_in_approximate_search(spark, tmp_path):
    d = clustered(np.random.default_rng(12), n=60)
    odd = [(100, [0.0] * 16), (101, None), (102, [1.0] * 15 + [None]), (103, [0.0] * 16)]
    docs = frame(spark, d).unionByName(spark.createDataFrame(odd, "id long, embedding array<float>"))
    both = np.concatenate([d, np.zeros((2, 16), np.float32)])
    names = [*range(60), 100, 103]
    path = str(tmp_path / "ivf")
    ann.build_ivf(docs, path, 4)
    index, centroids = ann.load_ivf(spark, path)
    want = brute(both, both, 5, names, np.array(names))
    assert got(ann.ivf_search(docs, index, centroids, 5, 4, query_id="id")) == want
    found = {q for q, _, _ in got(ann.lsh_search(docs, docs, 5, query_id="id", tables=4, per_table=3))}
    assert found == set(names)


def test_lsh_compares_a_small_part_of_all_pairs(spark):
    d = np.random.default_rng(13).normal(size=(500, 64)).astype(np.float32)
    buckets = frame(spark, d).select("id", F.explode(ann.lsh_buckets("embedding")).alias("cell"))
    sizes = [r["count"] for r in buckets.groupBy("cell").count().collect()]
    assert sum(n * n for n in sizes) < 500 * 500 / 4


def test_models_are_not_mixed(spark):
    m = np.eye(3, dtype=np.float32)
    a, b = frame(spark, m).withColumn("model", F.lit("a")), frame(spark, m).withColumn("model", F.lit("b"))
    assert knn.knn_join(a, a, 1, query_id="id").count() == 3
    with pytest.raises(Exception, match="vector of model a compared with one of b"):
        knn.knn_join(a, b, 1, query_id="id").collect()
    with pytest.raises(ValueError, match="several models"):
        knn.knn_join(a.unionByName(b), b, 1, query_id="id")


def test_near_ties_beyond_single_precision_are_ordered():
    # Documents a few billionths apart: single precision cannot tell them apart.
    rng = np.random.default_rng(12)
    base, step = unit(rng.normal(size=(1, 32)))[0], unit(rng.normal(size=(1, 32)))[0]
    d = unit(base + np.linspace(0, 4e-6, 2000)[:, None] * step)
    rng.shuffle(d)
    q = unit(np.vstack([base, step, rng.normal(size=32)]))
    state = kernels.TopK(3, 25)
    for start in range(0, 2000, 170):
        state.add(q, np.arange(3), d[start : start + 170], np.arange(2000)[start : start + 170])
    query, score, ids = state.result()
    exact = np.round(np.einsum("qd,nd->qn", q, d), 9)
    for i in range(3):
        assert list(ids[query == i]) == list(np.lexsort((np.arange(2000), -exact[i]))[:25])


def test_nearest_centroids_match_a_full_sort():
    rng = np.random.default_rng(13)
    rows, centroids = unit(rng.normal(size=(500, 8))), unit(rng.normal(size=(40, 8)))
    for probes in (1, 3, 40):
        want = np.argsort(-(rows @ centroids.T), axis=1, kind="stable")[:, :probes]
        assert (kernels.nearest(rows, centroids, probes) == want).all()


def test_the_grid_neither_crosses_nor_gathers_a_cell(spark):
    d = frame(spark, np.random.default_rng(14).normal(size=(60, 4)).astype(np.float32))
    plan = knn.knn_join(d, d, 3, query_id="id", limits=GRID)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
