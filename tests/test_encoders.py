import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import vecloom.functions as V
from vecloom.operators.text_similarity import text_similarity
from vecloom.sources import maintenance


def encode(spark, texts, column=lambda: V.embed_encode("text")):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r[0] for r in df.orderBy("i").select(column()).collect()]


def by_hand(text, dim=384, limit=None):
    out = np.zeros(dim)
    for word in re.findall(r"[^\W_]+", text.lower())[:limit]:
        digest = hashlib.md5(word.encode()).hexdigest()
        out[int(digest[:8], 16) % dim] += 1 if digest[8] < "8" else -1
    norm = np.linalg.norm(out)
    return out / norm if norm else out


def test_matches_definition(spark):
    texts = ["Hello World, hello", "a", "Größe ÉTÉ 42", "word " * 2000 + "tail", "x-y_z"]
    for text, vec in zip(texts, encode(spark, texts)):
        assert np.allclose(vec, by_hand(text), atol=1e-6)


def test_dimension_and_norm(spark):
    (vec,) = encode(spark, ["test"])
    assert len(vec) == 384
    assert abs(np.linalg.norm(vec) - 1) < 0.01


def test_empty_null_and_wordless(spark):
    empty, null, signs, blank = encode(spark, ["", None, "!!! --", " "])
    assert null is None
    for vec in (empty, signs, blank):
        assert vec == [0.0] * 384


def test_token_limit(spark):
    long = " ".join(f"w{i}" for i in range(600))
    first = " ".join(f"w{i}" for i in range(512))
    cut, same = encode(spark, [long, first], lambda: V.embed_encode("text", V.HASHING_512))
    assert cut == same
    assert np.allclose(cut, by_hand(long, limit=512), atol=1e-6)
    (whole,) = encode(spark, [long])
    assert whole != cut
    assert np.allclose(whole, by_hand(long), atol=1e-6)


def test_query_side(spark):
    (doc,) = encode(spark, ["vector search"])
    assert encode(spark, ["vector search"], lambda: V.embed_query("text")) == [doc]
    prefixed, empty = encode(spark, ["vector search", ""], lambda: V.embed_query("text", V.HASHING_ASYMMETRIC))
    assert prefixed != doc
    assert empty == [0.0] * 384
    assert V.HASHING_ASYMMETRIC.is_asymmetric and not V.HASHING.is_asymmetric


def test_literals(spark):
    (text,) = encode(spark, ["hello"], lambda: V.embed_text("text"))
    assert text.startswith("[") and text.endswith("]")
    back = encode(spark, ["hello"], lambda: V.parse_vector(V.embed_text("text"), 384))
    assert back == encode(spark, ["hello"])
    assert encode(spark, ["hello"], lambda: V.embed_query_text("text")) == [text]


def test_batch_keeps_order_and_length(spark):
    df = spark.createDataFrame([(0, ["b", "", "a", None]), (1, []), (2, None)], "i int, texts array<string>")
    rows = [r[0] for r in df.orderBy("i").select(V.embed_encode_batch("texts")).collect()]
    a, b = encode(spark, ["a", "b"])
    assert rows[0] == [b, [0.0] * 384, a, None]
    assert rows[1:] == [[], None]


def test_compose_text(spark):
    rows = [("n", "d"), (None, "d"), ("n", None), (None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string").orderBy("i")
    assert [r[0] for r in df.select(V.compose_text("a", "b")).collect()] == ["n d", " d", "n ", " "]
    assert [r[0] for r in df.select(V.compose_text("a", "b", required=(1,))).collect()] == ["n d", " d", None, None]


def test_relevant_outranks_irrelevant(spark):
    df = spark.createDataFrame([("where does the night train to the coast stop",
                                 "The night train stops twice before it reaches the coast.",
                                 "Paint dries slowly when the weather is damp.")], "q string, hit string, miss string")
    scored = text_similarity(text_similarity(df, "q", "hit", out_col="good"), "q", "miss", out_col="bad").first()
    assert scored["good"] > scored["bad"]


def test_text_similarity_edges(spark):
    rows = [("cat", "cat"), ("", "cat"), (None, "cat"), ("cat sat", "cat ran")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string").orderBy("i")
    got = [r["similarity"] for r in text_similarity(df, "a", "b").orderBy("i").collect()]
    assert got == [1.0, 0.0, None, pytest.approx(0.5)]


def test_spec_rules():
    with pytest.raises(ValueError):
        V.EncoderSpec(dim=0)
    with pytest.raises(ValueError):
        V.EncoderSpec(pooling="max")
    with pytest.raises(ValueError):
        V.EncoderSpec(max_tokens=0)
    assert {"name=hashing-384", "dim=384", "max_tokens=none"} <= set(V.HASHING.info().split(";"))


def test_encoding_writes_model_and_dimension(spark):
    df = spark.createDataFrame([("x",)], "text string")
    row = maintenance.encode_documents(df, "text", V.HASHING).first()
    assert (row["model"], row["dim"], len(row["embedding"])) == ("hashing-384", 384, 384)
    row = maintenance.encode_queries(df, "text", V.HASHING_ASYMMETRIC).first()
    assert row["model"] == "hashing-384-asymmetric"


def test_encoding_does_not_shuffle(spark):
    df = spark.createDataFrame([("x",)], "text string").select(V.embed_encode("text").alias("e"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ArrowEvalPython" in plan


def test_dictionary_of_many_texts(spark):
    df = spark.range(25_000).select(F.concat(F.lit("same words "), (F.col("id") % 3).cast("string")).alias("text"))
    assert df.select(V.embed_encode("text").alias("e")).distinct().count() == 3


def test_every_default_reads_the_last_word(spark):
    long = " ".join(f"w{n}" for n in range(2000))
    df = spark.createDataFrame([(long, long + " last")], "a string, b string")
    for function in (V.embed_encode, V.embed_query, V.embed_text, V.embed_query_text):
        row = df.select(function("a").alias("a"), function("b").alias("b")).first()
        assert row["a"] != row["b"]
    row = df.select(V.embed_encode_batch(F.array("a", "b")).alias("v")).first()
    assert row["v"][0] != row["v"][1]
    row = df.select(V.embed_encode("a", V.HASHING_512).alias("a"), V.embed_encode("b", V.HASHING_512).alias("b")).first()
    assert row["a"] == row["b"]


def test_words_are_split_as_the_encoder_splits_them(spark):
    texts = ["\u0130STANBUL and \u03a3\u03a3", "a-b  C", "", None, "\u00c9t\u00e9!"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    got = [r["w"] for r in df.select("i", V.words("t").alias("w")).orderBy("i").collect()]
    assert got[1:] == [["a", "b", "c"], [], None, ["\u00e9t\u00e9"]]
    joined = spark.createDataFrame([(texts[0], " ".join(got[0]))], "a string, b string")
    row = joined.select(V.embed_encode("a").alias("a"), V.embed_encode("b").alias("b")).first()
    assert row["a"] == row["b"]
