import numpy as np
import pytest

from vecloom.operators import evaluate, knn
from vecloom.sources import maintenance

GRID = knn.KnnLimits(max_broadcast_rows=3, max_passes=0, query_block=8, doc_block=16)
PASSES = knn.KnnLimits(max_broadcast_rows=3, max_passes=100)
FORMS = {"broadcast": knn.DEFAULT_LIMITS, "passes": PASSES, "grid": GRID}

DOCS = [
    (1, "the harbour master logs every ship that enters the bay"),
    (2, "granite cools slowly and so grows large crystals"),
    (3, "a violin string is tuned by turning its wooden peg"),
    (4, "honey bees dance to tell the hive where nectar is"),
    (5, "the lighthouse keeper trims the lamp at dusk"),
    (6, "the lighthouse keeper trims the lamp at dusk"),
]
QUERIES = [
    ("how is a violin string tuned", 3),
    ("why does granite have large crystals", 2),
    ("how do bees tell where nectar is", 4),
    ("who trims the lighthouse lamp", 6),
    ("not answered here", 77),
]


def by_hand(q, expect, d, ids):
    unit = lambda m: m / np.where((n := np.linalg.norm(m, axis=1, keepdims=True)) > 0, n, 1)
    scores = np.round(unit(q) @ unit(d).T, 9)
    out = {}
    for i, want in enumerate(expect):
        order = [ids[j] for j in np.lexsort((ids, -scores[i]))]
        own = scores[i][ids.index(want)]
        wrong = max(s for s, j in zip(scores[i], ids) if j != want)
        out[i] = (order.index(want) + 1, round(own, 6), round(own - wrong, 6))
    return out


@pytest.mark.parametrize("form", FORMS)
def test_text_example(spark, form):
    docs = maintenance.encode_documents(spark.createDataFrame(DOCS, "id int, text string"), "text")
    queries = maintenance.encode_queries(spark.createDataFrame(QUERIES, "q string, expect int"), "q")
    result = evaluate.evaluate(queries, docs, limits=FORMS[form])
    rows = {r["query"]: r for r in evaluate.report(result).collect()}
    assert "not answered here" not in rows and len(rows) == 4
    assert rows["why does granite have large crystals"]["rank_of_expected"] == 1
    # An exact copy with a lower id comes first, and leaves no margin.
    tied = rows["who trims the lighthouse lamp"]
    assert (tied["rank_of_expected"], tied["margin_over_best_wrong"]) == (2, 0.0)
    top = evaluate.summarize(result, "m").first()
    ranks = [r["rank_of_expected"] for r in rows.values()]
    assert (top["model"], top["queries"], top["top1_hits"]) == ("m", 4, ranks.count(1))
    assert top["top1_accuracy"] == round(ranks.count(1) / 4, 4)
    assert top["mrr"] == round(sum(1 / r for r in ranks) / 4, 4)
    assert top["mean_rank"] == round(sum(ranks) / 4, 3)


@pytest.mark.parametrize("form", FORMS)
def test_random_vectors_with_copies(spark, form):
    rng = np.random.default_rng(1)
    d = rng.normal(size=(60, 5)).astype(np.float32)
    d[::3] = d[4]
    q, expect = rng.normal(size=(25, 5)).astype(np.float32), rng.integers(0, 60, 25).tolist()
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(d)], "id int, embedding array<float>").repartition(4)
    queries = spark.createDataFrame([(i, e, v.tolist()) for i, (e, v) in enumerate(zip(expect, q))],
                                    "q int, expect int, embedding array<float>")
    rows = evaluate.evaluate(queries, docs, limits=FORMS[form]).collect()
    got = {r["query"]: (r["rank_of_expected"], round(r["score"], 6), round(r["margin_over_best_wrong"], 6)) for r in rows}
    assert got == by_hand(q.astype(float), expect, d.astype(float), list(range(60)))


@pytest.mark.parametrize("form", FORMS)
def test_missing_vectors_rank_last(spark, form):
    docs = spark.createDataFrame([(1, None), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [0.5])],
                                 "id int, embedding array<float>")
    asked = [(f"q{i}", e, [1.0, 0.0]) for i, e in enumerate((3, 4, 2, 1))]
    queries = spark.createDataFrame(asked, "q string, expect int, embedding array<float>")
    rows = {r["query"]: r for r in evaluate.evaluate(queries, docs, limits=FORMS[form]).collect()}
    assert [rows[f"q{i}"]["rank_of_expected"] for i in range(4)] == [5, 2, 1, 4]
    assert rows["q0"]["score"] is None and rows["q0"]["margin_over_best_wrong"] is None


def test_compare(spark):
    schema = "query string, expected_doc int, rank_of_expected long, score double, margin_over_best_wrong double"
    a = spark.createDataFrame([("x", 1, 1, 0.9, 0.1), ("y", 2, 4, 0.5, -0.1)], schema)
    b = spark.createDataFrame([("x", 1, 3, 0.7, -0.2), ("z", 3, 1, 0.8, 0.3)], schema)
    rows = {r["query"]: (r["rank_a"], r["rank_b"], r["rank_delta"]) for r in evaluate.compare_models(a, b).collect()}
    assert rows == {"x": (1, 3, 2), "y": (4, None, None), "z": (None, 1, None)}
    both = evaluate.compare_summaries(evaluate.summarize(a, "a"), evaluate.summarize(b, "b")).first()
    assert (both["model_a"], both["model_b"], both["queries_delta"], both["mean_rank_delta"]) == ("a", "b", 0, -0.5)


def test_rank_of_given_pairs(spark):
    rng = np.random.default_rng(9)
    q, d = rng.normal(size=(3, 5)), rng.normal(size=(40, 5))
    d[7] = d[8]
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "q long, embedding array<float>")
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(d)], "id long, embedding array<float>")
    judged = spark.createDataFrame([(i, j) for i in range(3) for j in (7, 8, 30)] + [(0, 999)], "q long, id long")
    q, d = q.astype(np.float32).astype(float), d.astype(np.float32).astype(float)
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = np.round(unit(q) @ unit(d).T, 9)
    want = {}
    for i in range(3):
        order = list(np.lexsort((np.arange(40), -scores[i])))
        for j in (7, 8, 30):
            want[i, j] = (order.index(j) + 1, scores[i][j] - max(scores[i][x] for x in range(40) if x != j))
    for limits in FORMS.values():
        got = {(r.q, r.id): (r["rank"], r.margin) for r in evaluate.rank_of(queries, judged, docs, limits=limits).collect()}
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
        assert all(abs(got[k][1] - want[k][1]) < 1e-6 for k in want)
