import json
import random

import pytest
from pyspark.sql import functions as F

import vecloom.functions as V
from vecloom.operators import chunking, rag


def windows(text, size, overlap):
    out, start = [], 0
    while text is not None and start < len(text):
        out.append(text[start : start + size])
        start += size - overlap
    return out


def cut(spark, texts, size=500, overlap=50):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, content string")
    rows = chunking.chunk_text(df, "content", size, overlap).orderBy("id", "chunk_index").collect()
    got = {i: [] for i in range(len(texts))}
    for r in rows:
        assert r["chunk_index"] == len(got[r["id"]])
        got[r["id"]].append(r["chunk"])
    return got


@pytest.mark.parametrize("length", [0, 1, 450, 451, 500, 501, 950, 64 * 450 - 1, 64 * 450, 64 * 450 + 1, 64 * 450 + 451])
def test_lengths_around_the_edges(spark, length):
    text = "".join(random.Random(length).choices("abcdef gh", k=length))
    assert cut(spark, [text])[0] == windows(text, 500, 50)


def test_random_texts_sizes_and_characters(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices("aé漢🎉 b", k=rng.randint(0, 900))) for _ in range(20)] + [None]
    for size, overlap in ((1, 0), (7, 3), (10, 9), (100, 0)):
        got = cut(spark, texts, size, overlap)
        assert got == {i: windows(t, size, overlap) for i, t in enumerate(texts)}


def test_bad_sizes(spark):
    df = spark.createDataFrame([("x",)], "content string")
    for size, overlap in ((10, 10), (10, 11), (10, -1), (0, 0)):
        with pytest.raises(ValueError):
            chunking.chunk_text(df, "content", size, overlap)


DOCS = [(1, "Databases", "alpha beta " * 100, "docs"), (2, None, "gamma delta " * 60, "web"), (3, "Empty", "", "docs")]


@pytest.fixture(scope="module")
def chunks(spark):
    docs = spark.createDataFrame(DOCS, "id int, title string, content string, source string")
    return chunking.chunk_documents(docs, size=200, overlap=20)


def test_parents_and_chunks(chunks):
    parents, pieces = chunks
    assert parents.count() == 3 and parents.filter("parent_id IS NULL").count() == 3
    assert json.loads(parents.first()["metadata"]) == {"type": "parent"}
    row = pieces.filter("id = '1#2'").first()
    assert (row["parent_id"], row["chunk_index"], row["title"], row["source"]) == (1, 2, "Databases", "docs")
    assert json.loads(row["metadata"]) == {"type": "chunk", "parent_id": 1}
    assert pieces.filter("parent_id = 3").count() == 0


def test_search_returns_only_chunks(spark, chunks):
    parents, pieces = chunks
    table = rag.embed_chunks(pieces.unionByName(parents.withColumn("id", F.col("id").cast("string"))))
    hits = rag.rag_search(table, "gamma delta", 3).collect()
    assert len(hits) == 3 and all(h["id"].startswith("2#") for h in hits)
    only_parents = table.filter("parent_id IS NULL")
    assert rag.rag_search(only_parents, "gamma delta", 3).count() == 0


def context_by_hand(rows, hit, window):
    near = [r for r in rows if r["parent_id"] == hit["parent_id"] and abs(r["chunk_index"] - hit["chunk_index"]) <= window]
    return " ".join(r["content"] for r in sorted(near, key=lambda r: r["chunk_index"]))


@pytest.mark.parametrize("window", [0, 1, 2])
def test_context_matches_neighbours(chunks, window):
    table = rag.embed_chunks(chunks[1])
    rows = {r["id"]: r for r in table.collect()}
    got = rag.rag_search_with_context(table, "beta alpha", window, 4).collect()
    assert len(got) == 4
    for r in got:
        assert r["combined_content"] == context_by_hand(rows.values(), rows[r["chunk_id"]], window)
    assert [r["similarity"] for r in got] == sorted((r["similarity"] for r in got), reverse=True)


def test_hit_without_position_keeps_null_content(spark):
    rows = [("a", "t", "word", "s", None, 1), ("b", "t", "other", "s", 0, 1)]
    df = spark.createDataFrame(rows, "id string, title string, content string, source string, chunk_index int, parent_id int")
    got = rag.rag_search_with_context(rag.embed_chunks(df), "t word", 1, 1).collect()
    assert [(r["chunk_id"], r["combined_content"]) for r in got] == [("a", None)]


def test_negative_window(chunks):
    with pytest.raises(ValueError):
        rag.rag_search_with_context(rag.embed_chunks(chunks[1]), "x", -1)


def test_null_content_has_no_vector(spark):
    df = spark.createDataFrame([("t", None), (None, "x")], "title string, content string")
    got = [r["embedding"] for r in rag.embed_chunks(df).orderBy(F.col("title").desc_nulls_last()).collect()]
    assert got[0] is None and got[1] is not None


def test_context_joins_by_broadcast(spark, tmp_path, chunks):
    path = str(tmp_path / "chunks")
    rag.embed_chunks(chunks[1], V.HASHING).write.parquet(path)
    plan = rag.rag_search_with_context(spark.read.parquet(path), "alpha")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("window", [0, 1])
def test_stored_chunks_answer_many_questions_like_one(spark, tmp_path, chunks, window):
    stored = rag.store_chunks(rag.embed_chunks(chunks[1]), "stored_test", str(tmp_path / "stored"), buckets=4)
    texts = ["beta alpha", "gamma delta", "alpha"]
    asked = spark.createDataFrame(list(enumerate(texts)), "q int, text string").withColumn("embedding", V.embed_query("text", V.HASHING))
    got = rag.rag_batch_with_context(stored, asked, window, 3).collect()
    for i, text in enumerate(texts):
        one = rag.rag_search_with_context(stored, text, window, 3).collect()
        mine = sorted((r for r in got if r["q"] == i), key=lambda r: r["rank"])
        columns = ("chunk_id", "title", "combined_content", "source")
        assert [tuple(r[c] for c in columns) for r in mine] == [tuple(r[c] for c in columns) for r in one]
    rag.drop_chunks(spark, "stored_test")
    with pytest.raises(ValueError):
        rag.rag_batch_with_context(stored, asked, -1)


def test_stored_chunks_are_not_exchanged(spark, tmp_path, chunks):
    rag.store_chunks(rag.embed_chunks(chunks[1]), "stored_plan", str(tmp_path / "stored"), buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = spark.table("stored_plan")
        hits = stored.select(F.col("parent_id").alias("hit_parent"), F.col("id").alias("chunk_id")).repartition(3)
        plan = stored.join(hits, F.col("parent_id") == F.col("hit_parent"))._jdf.queryExecution().executedPlan().toString()
        rows = plan.splitlines()
        bucketed = next(i for i, line in enumerate(rows) if "Bucketed: true" in line and "embedding" in line)
        join = next(i for i, line in enumerate(rows) if "SortMergeJoin" in line)
        assert join < bucketed and not any("Exchange" in line for line in rows[join:bucketed])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        rag.drop_chunks(spark, "stored_plan")


def test_a_bucket_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.createDataFrame([(f"{i}#0", "t", f"c{i}", "s", 0, i, [1.0]) for i in range(64)],
                                 "id string, title string, content string, source string, chunk_index int, parent_id long, embedding array<float>")
    stored = rag.store_chunks(rows, "stored_parts", str(tmp_path / "stored"), buckets=2)
    files = [f.name for f in (tmp_path / "stored").glob("*.parquet")]
    buckets = [name.rsplit("_", 1)[1].split(".")[0] for name in files]
    assert sorted(set(buckets)) == ["00000", "00001"] and min(buckets.count(b) for b in set(buckets)) > 1
    assert stored.count() == 64 and stored.groupBy("parent_id").count().filter("count <> 1").isEmpty()
    rag.drop_chunks(spark, "stored_parts")
