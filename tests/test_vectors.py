import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

import vecloom.functions as V
from vecloom.functions.vectors import FLOAT_MAX
from vecloom.operators import pooling

PAIR = "a array<float>, b array<float>"


def values(spark, pairs, expr):
    rows = [(i, *(None if v is None else [x if x is None else float(x) for x in v] for v in p)) for i, p in enumerate(pairs)]
    df = spark.createDataFrame(rows, f"i int, {PAIR}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_known_pairs(spark):
    assert values(spark, [([1.0, 0, 0], [1.0, 0, 0]), ([1.0, 0, 0], [0, 1.0, 0])], V.cosine_similarity("a", "b")) == [1.0, 0.0]
    assert values(spark, [([0.0, 0, 0], [3.0, 4, 0])], V.l2_distance("a", "b")) == [5.0]
    assert values(spark, [([1.0, 2], [3.0, 4])], V.dot_product("a", "b")) == [11.0]
    assert values(spark, [([1.0, 0], [-1.0, 0])], V.cosine_distance("a", "b")) == [2.0]


def test_sentinels_differ_by_function(spark):
    odd = [([1.0], [1.0, 2.0]), ([], [])]
    assert values(spark, odd, V.cosine_similarity("a", "b")) == [0.0, 0.0]
    assert values(spark, odd, V.cosine_distance("a", "b")) == [1.0, 1.0]
    assert values(spark, odd, V.l2_distance("a", "b")) == [FLOAT_MAX, FLOAT_MAX]
    assert values(spark, odd, V.dot_product("a", "b")) == [0.0, 0.0]


def test_zero_vector(spark):
    zero = [([0.0, 0.0], [1.0, 1.0])]
    assert values(spark, zero, V.cosine_similarity("a", "b")) == [0.0]
    assert math.isnan(values(spark, zero, V.vector_distance("a", "b"))[0])
    assert values(spark, zero, V.l2_normalize("a")) == [[0.0, 0.0]]


def test_null_vector_and_null_element_give_null(spark):
    holed = [(None, [1.0]), ([1.0, None], [1.0, 1.0])]
    for f in (V.cosine_similarity, V.cosine_distance, V.l2_distance, V.dot_product):
        assert values(spark, holed, f("a", "b")) == [None, None]
    assert values(spark, holed, V.l2_normalize("a")) == [None, None]
    assert values(spark, holed, V.vector_literal("a")) == [None, None]


def test_vector_distance_refuses_mismatch(spark):
    with pytest.raises(Exception, match="different vector dimensions"):
        values(spark, [([1.0], [1.0, 2.0])], V.vector_distance("a", "b"))


def test_random_vectors_match_numpy(spark):
    rng = np.random.default_rng(7)
    a, b = rng.normal(size=(50, 16)).astype(np.float32), rng.normal(size=(50, 16)).astype(np.float32)
    pairs = [(x.tolist(), y.tolist()) for x, y in zip(a, b)]
    x, y = a.astype(float), b.astype(float)
    dot = (x * y).sum(1)
    norms = np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)
    assert np.allclose(values(spark, pairs, V.cosine_similarity("a", "b", out="double")), dot / norms)
    assert np.allclose(values(spark, pairs, V.dot_product("a", "b", out="double")), dot)
    assert np.allclose(values(spark, pairs, V.l2_distance("a", "b", out="double")), np.linalg.norm(x - y, axis=1))
    assert np.allclose(values(spark, pairs, V.vector_distance("a", "b")), 1 - dot / norms)
    assert np.allclose(values(spark, pairs, V.l2_normalize("a")), x / np.linalg.norm(x, axis=1)[:, None], atol=1e-6)


def test_result_types(spark):
    df = spark.createDataFrame([([1.0], [1.0])], PAIR)
    assert df.select(V.cosine_similarity("a", "b").alias("x")).schema["x"].dataType.simpleString() == "float"
    assert df.select(V.vector_distance("a", "b").alias("x")).schema["x"].dataType.simpleString() == "double"


def test_literal_is_plain_shortest_decimal(spark):
    got = values(spark, [([1.0, -0.5, 1.234e-5, 0.1, 1e10], None)], V.vector_literal("a"))
    assert got == ["[1,-0.5,0.00001234,0.1,10000000000]"]
    assert values(spark, [([], None)], V.vector_literal("a")) == ["[]"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.floats(width=32, allow_nan=False, allow_infinity=False), min_size=1, max_size=5), min_size=1, max_size=30))
def test_literal_round_trips(spark, vectors):
    got = values(spark, [(v, None) for v in vectors], V.parse_vector(V.vector_literal("a")))
    assert got == [[float(np.float32(x)) for x in v] for v in vectors]
    assert not any("e" in t for t in values(spark, [(v, None) for v in vectors], V.vector_literal("a")))


def test_parse_and_dimension_check(spark):
    one = spark.range(1)

    def parse(text, *args, **kwargs):
        return one.select(V.parse_vector(F.lit(text), *args, **kwargs)).first()[0]

    assert parse(" [1, 2.5 ,3] ", 3) == [1.0, 2.5, 3.0]
    assert parse("[]") == []
    assert parse(None) is None
    assert parse("[1,2]", 3, strict=False) is None
    assert parse("[1,x]", strict=False) is None
    assert parse("1,2", strict=False) is None
    with pytest.raises(SparkRuntimeException, match="expected 3 dimensions, not 2"):
        parse("[1,2]", 3)
    with pytest.raises(SparkRuntimeException, match="not a vector literal"):
        parse("1,2")


def test_mean_pool_masks_and_guards(spark):
    rows = [("g", 0, [1.0, 2.0], 1.0), ("g", 1, [3.0, 4.0], 1.0), ("g", 2, [100.0, 100.0], 0.0),
            ("off", 0, [5.0, 5.0], 0.0), ("none", 0, None, 1.0)]
    df = spark.createDataFrame(rows, "g string, pos int, v array<float>, m double")
    got = {r["g"]: r["embedding"] for r in pooling.mean_pool(df, "g", "v", mask="m").collect()}
    assert got == {"g": [2.0, 3.0], "off": [0.0, 0.0], "none": None}
    first = {r["g"]: r["embedding"] for r in pooling.cls_pool(df, "g", "v", "pos").collect()}
    assert first["g"] == [1.0, 2.0]
