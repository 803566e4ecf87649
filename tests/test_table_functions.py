"""Table functions called from SQL: results, defaults, plans, odd rows."""

import pytest
from pyspark.sql import functions as F

import vecloom.functions as V
from vecloom.functions import table_functions
from vecloom.operators import chunking, rag, search
from vecloom.sources import maintenance

TEXTS = ["red lamp", "blue lamp for a workbench", "oak workbench", "garden hose", "", None, "red garden lamp"] * 6


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def products(spark, tmp_path_factory):
    rows = [(i, t, f"about {i % 4}", float(i), "AB"[i % 2]) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "id int, name string, description string, price double, category string").repartition(4)
    text = F.when(F.col("name").isNotNull(), V.compose_text("name", "description"))
    path = f"{tmp_path_factory.mktemp('products')}/table"
    maintenance.encode_documents(df, text).write.parquet(path)
    df = spark.read.parquet(path)
    df.createOrReplaceTempView("fn_products")
    table_functions.register_product_search(spark, "fn_products")
    return df


def test_products_equal_the_python_form(spark, products):
    ours = spark.sql("SELECT * FROM search_products('red lamp')")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, search.search_products(products, "red lamp").collect()))
    named = spark.sql("SELECT * FROM search_products_by_category('lamp', cat => 'B', limit_count => 3)")
    python = search.search_products_by_category(products, "lamp", "B", 3)
    assert sorted(map(tuple, named.collect())) == sorted(map(tuple, python.collect())) and named.count() == 3
    # Every row, those without a vector too.
    every = spark.sql("SELECT * FROM search_products('lamp', 100)")
    assert every.count() == len(TEXTS) and every.filter("similarity IS NULL").count() == TEXTS.count(None)
    assert spark.sql("SELECT * FROM search_products('lamp', 0)").collect() == []


def test_plans_keep_the_best_rows_of_each_task(spark, products):
    plan = plan_of(spark.sql("SELECT * FROM search_products_by_category('lamp', 'B')"))
    assert "TakeOrderedAndProject(limit=5" in plan and "EqualTo(category,B)" in plan and "Exchange SinglePartition" not in plan
    assert "NestedLoop" not in plan


@pytest.fixture(scope="module")
def chunks(spark, tmp_path_factory):
    rows = [(d, f"title {d % 3}", " ".join(f"word{(d * 7 + i) % 40}" for i in range(30)), "src") for d in range(12)]
    docs = spark.createDataFrame(rows, "id long, title string, content string, source string")
    path = f"{tmp_path_factory.mktemp('chunks')}/table"
    rag.embed_chunks(chunking.chunk_documents(docs, size=40, overlap=8)[1]).write.parquet(path)
    df = spark.read.parquet(path)
    df.createOrReplaceTempView("fn_chunks")
    table_functions.register_passage_search(spark, "fn_chunks")
    return df


def test_passages_equal_the_python_form(spark, chunks):
    ours, python = spark.sql("SELECT * FROM rag_search('word3 word4')"), rag.rag_search(chunks, "word3 word4")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, python.collect()))
    ours = spark.sql("SELECT * FROM rag_search_with_context('word3 word4', context_window => 2)")
    python = rag.rag_search_with_context(chunks, "word3 word4", 2)
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, python.collect())) and ours.count() == 3
    plan = plan_of(ours)
    assert "TakeOrderedAndProject(limit=3" in plan and "SortMergeJoin" not in plan and "Exchange SinglePartition" not in plan


def test_hits_without_a_position_stay(spark, chunks):
    chunks.withColumn("chunk_index", F.lit(None).cast("int")).createOrReplaceTempView("fn_lost")
    table_functions.register_passage_search(spark, "fn_lost")
    rows = spark.sql("SELECT * FROM rag_search_with_context('word3')").collect()
    assert len(rows) == 3 and all(r["combined_content"] is None for r in rows)


@pytest.mark.parametrize("size, overlap", [(5, 2), (500, 50), (1, 0), (64, 63)])
def test_chunks_equal_the_python_form(spark, size, overlap):
    table_functions.register_chunking(spark)
    texts = ["", None, "a", "héllo wörld 𝄞 " * 40, "x" * 1000]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, content string")
    docs.createOrReplaceTempView("fn_texts")
    ours = spark.sql(f"SELECT d.id, c.* FROM fn_texts d, LATERAL chunk_text(d.content, {size}, {overlap}) c")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, chunking.chunk_text(docs, size=size, overlap=overlap).collect()))
    assert "Exchange" not in plan_of(ours) and "Join" not in plan_of(ours)


def test_chunk_sizes_are_checked(spark):
    table_functions.register_chunking(spark)
    with pytest.raises(Exception, match="overlap"):
        spark.sql("SELECT * FROM chunk_text('some text', 5, 5)").collect()
    assert [r["chunk"] for r in spark.sql("SELECT * FROM chunk_text('some text')").collect()] == ["some text"]


def test_passage_search_compares_in_one_arrow_call(spark):
    """The text's vector is no column, and no number of a vector passes through a lambda."""
    rows = [("a", 1, 0, [1.0, 0.0]), ("b", 1, 1, [0.0, 0.0]), ("c", 1, 2, None), ("d", 1, 3, [None, 1.0]), ("e", None, 4, [1.0, 0.0])]
    spec = V.EncoderSpec(name="two", dim=2)
    view = spark.createDataFrame([(i, "t", f"text {i}", "s", c, p, v) for i, p, c, v in rows],
                                 "id string, title string, content string, source string, chunk_index int, parent_id int, embedding array<float>")
    view.createOrReplaceTempView("odd_chunks")
    table_functions.register_passage_search(spark, "odd_chunks", spec)
    found = spark.sql("SELECT id, similarity FROM rag_search('word')")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" not in plan and "lambda" not in plan
    got = [(r["id"], r["similarity"]) for r in found.collect()]
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW odd_asked AS SELECT *, embed_query('word') AS asked FROM odd_chunks WHERE parent_id IS NOT NULL")
    want = [tuple(r) for r in spark.sql("SELECT id, round(1D - d, 9) AS similarity FROM "
                                        "(SELECT id, round(vector_distance(embedding, asked), 9) AS d FROM odd_asked) ORDER BY d ASC NULLS LAST, id").collect()]
    assert repr(got) == repr(want)
    assert [r["similarity"] for r in spark.sql("SELECT similarity FROM rag_search(NULL)").collect()] == [None] * 4
