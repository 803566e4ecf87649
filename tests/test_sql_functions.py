import pytest

import vecloom.functions as V
from vecloom.functions.sql import register_functions


@pytest.fixture(scope="module")
def sql(spark):
    register_functions(spark)
    return lambda q: spark.sql(q).collect()


def test_similarity_functions(sql):
    row = sql("""SELECT cosine_similarity(array(1f, 0f), array(1f, 1f)) AS c, cosine_distance(array(1f), array(1f, 2f)) AS d,
                 l2_distance(array(0f, 0f), array(3f, 4f)) AS l, dot_product(array(1f, 2f), array(3f, 4f)) AS p,
                 cosine_similarity(CAST(NULL AS ARRAY<FLOAT>), array(1f)) AS n, cosine_similarity(array(0f), array(1f)) AS z,
                 l2_distance(array(1f), array(1f, 2f)) AS far""")[0]
    assert row["c"] == pytest.approx(0.70710678) and row["d"] == 1.0 and row["l"] == 5.0 and row["p"] == 11.0
    assert row["n"] is None and row["z"] == 0.0 and row["far"] > 3e38


def test_encoders_and_facts(spark, sql):
    row = sql("""SELECT embed_encode('vector search') AS e, embed_query('vector search') AS q, embed_text('hello') AS t,
                 embed_query_text('hello') AS qt, to_embedding('') AS z, embed_encode(NULL) AS n, embed_model() AS m,
                 embed_dim() AS d, embed_is_asymmetric() AS a, embed_info() AS i, text_similarity('cat', 'cat') AS s,
                 text_similarity('', 'cat') AS s0""")[0]
    assert row["e"] == row["q"] and len(row["e"]) == 384 and row["z"] == [0.0] * 384 and row["n"] is None
    assert row["t"].startswith("[") and row["t"] == row["qt"]
    assert (row["m"], row["d"], row["a"]) == ("hashing-384", 384, False) and row["m"] in row["i"]
    assert row["s"] > 0.99 and row["s0"] == 0.0
    same = spark.createDataFrame([("vector search",)], "t string").select(V.embed_encode("t")).first()[0]
    assert same == row["e"]


def test_search_and_ranking_statements(spark, sql):
    spark.createDataFrame([(1, "green tea"), (2, "office chair"), (3, "tea pot")], "id int, content string").createOrReplaceTempView("sql_docs")
    rows = sql("""WITH query AS (SELECT embed_query('green tea') AS emb)
                  SELECT id, cosine_similarity(embed_encode(content), query.emb) AS score FROM sql_docs, query
                  ORDER BY score DESC LIMIT 2""")
    assert [r["id"] for r in rows] == [1, 3]
    ranks = sql("""SELECT id, ROW_NUMBER() OVER (ORDER BY cosine_similarity(embed_encode(content), embed_query('office')) DESC) AS r
                   FROM sql_docs""")
    assert {r["id"]: r["r"] for r in ranks}[2] == 1


def test_asymmetric_registration(spark):
    spec = V.HASHING_ASYMMETRIC
    register_functions(spark, spec)
    try:
        row = spark.sql("SELECT embed_encode('x') AS e, embed_query('x') AS q, embed_query('') AS z, embed_is_asymmetric() AS a").first()
        assert row["a"] is True and row["e"] != row["q"] and row["z"] == [0.0] * 384
        want = spark.createDataFrame([("x",)], "t string").select(V.embed_query("t", spec)).first()[0]
        assert row["q"] == want
    finally:
        register_functions(spark)


def test_sort_distance_and_checked_vectors(spark, sql):
    row = sql("""SELECT vector_distance(array(1f, 0f), array(0f, 2f)) AS d, vector_distance(array(0f), array(1f)) AS z,
                 vector_distance(array(1f, NULL), array(1f, 1f)) AS n, parse_vector('[1,2.5]', 2) AS p, to_vector(array(1f), 1) AS v,
                 parse_vector(NULL, 2) AS pn""")[0]
    assert row["d"] == 1.0 and row["z"] != row["z"] and row["n"] is None
    assert row["p"] == [1.0, 2.5] and row["v"] == [1.0] and row["pn"] is None
    with pytest.raises(Exception, match="expected 3 dimensions, not 2"):
        sql("SELECT parse_vector('[1,2]', 3)")
    with pytest.raises(Exception, match="different vector dimensions"):
        sql("SELECT vector_distance(array(1f), array(1f, 2f))")
