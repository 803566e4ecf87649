import numpy as np
import pytest
from pyspark.sql import functions as F

import vecloom.functions as V
from vecloom.operators import search
from vecloom.sources import maintenance

# Library records: id, name, description, price, category.
SHELF = [
    (210, "Tide tables", "hours of high and low water for the northern coast", 8.5, "Almanac"),
    (214, "Knots of the fishing fleet", "how to tie forty knots", 12.0, "Manual"),
    (305, "Lichens", None, 31.0, "Field guide"),
    (306, "Mosses of wet heaths", "a key to mosses with drawings", 27.5, "Field guide"),
]


@pytest.fixture(scope="module")
def products(spark):
    df = spark.createDataFrame(SHELF, "id int, name string, description string, price double, category string")
    return maintenance.encode_documents(df, V.compose_text("name", "description"))


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [1.0]), (7, [1.0, 0.0]),
            (8, [1.0, None])]
    return spark.createDataFrame(rows, "id int, embedding array<float>")


def ids(df):
    return [r["id"] for r in df.collect()]


def test_topk_order_ties_and_odd_rows(vectors):
    got = search.search_topk(vectors, [1.0, 0.0], 8).collect()
    assert [r["id"] for r in got] == [1, 7, 3, 2, 5, 6, 4, 8]
    assert [r["score"] for r in got] == [1.0, 1.0, pytest.approx(np.sqrt(0.5)), 0.0, 0.0, 0.0, None, None]


def test_reference_null_order(vectors):
    assert ids(search.search_topk(vectors, [1.0, 0.0], 3, nulls="reference")) == [4, 8, 1]
    with pytest.raises(ValueError):
        search.search_topk(vectors, [1.0, 0.0], nulls="first")


def test_limits(vectors):
    assert ids(search.search_topk(vectors, [1.0, 0.0], 0)) == []
    with pytest.raises(ValueError):
        search.search_topk(vectors, [1.0, 0.0], -1)


def test_query_forms(spark, vectors):
    one = spark.createDataFrame([([1.0, 0.0],)], "embedding array<float>")
    assert ids(search.search_topk(vectors, one, 2)) == [1, 7]
    with pytest.raises(ValueError):
        search.search_topk(vectors, one.union(one), 2)
    with pytest.raises(ValueError):
        search.search_topk(vectors, one.limit(0), 2)


def test_threshold_has_no_limit_and_drops_nulls(vectors):
    assert ids(search.search_threshold(vectors, [1.0, 0.0], 0.5)) == [1, 7, 3]
    assert ids(search.search_threshold(vectors, [1.0, 0.0])) == [1, 7, 3]


def test_distance_puts_zero_vectors_and_nulls_last(vectors):
    got = search.search_distance(vectors.filter("id <> 6"), [1.0, 0.0], 10).collect()
    assert [r["id"] for r in got] == [1, 7, 3, 2, 5, 4, 8]
    assert np.isnan(got[4]["similarity"]) and got[5]["similarity"] is None
    with pytest.raises(Exception, match="dimensions"):
        search.search_distance(vectors, [1.0, 0.0], 10).collect()


def test_products(products):
    got = search.search_products(products, "knots to tie a boat", 3)
    assert got.columns == ["id", "name", "description", "price", "similarity"]
    assert got.count() == 3 and got.first()["id"] == 214
    only = search.search_products_by_category(products, "a key to mosses", "Field guide")
    assert only.columns == ["id", "name", "price", "similarity"]
    assert ids(only) == [306, 305]


def test_models_are_not_mixed(spark, products):
    other = V.EncoderSpec(name="other")
    with pytest.raises(Exception, match="vector of model other compared with one of hashing-384"):
        search.search_topk(products, "tides", 3, spec=other).collect()


def test_filter_reaches_the_scan_and_topk_does_not_shuffle(spark, tmp_path, products):
    path = str(tmp_path / "products")
    products.write.parquet(path)
    found = search.search_products_by_category(spark.read.parquet(path), "tides", "Almanac")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(category,Almanac)" in plan
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan and "Join" not in plan
    assert "description" not in plan


def test_threshold_scores_once(spark, vectors):
    plan = search.search_threshold(vectors, [1.0, 0.0], 0.5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_score_column_is_rounded_alike_for_copies(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=384).astype(np.float32).tolist()
    copies = spark.createDataFrame([(i, v) for i in range(500)], "id int, embedding array<float>").repartition(7)
    got = search.search_topk(copies, rng.normal(size=384).tolist(), 5)
    assert ids(got) == [0, 1, 2, 3, 4]
    assert got.select(F.countDistinct("score")).first()[0] == 1
