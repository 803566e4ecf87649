"""Every operator as a query over the given tables.

A query takes a session and a data folder and returns a DataFrame.  Each one
runs over whole tables and whole texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import vecloom.functions as V
from vecloom.functions import table_functions
from vecloom.functions.sql import register_functions
from vecloom.operators import ann, bounded, chunking, evaluate, filtered, graph, knn, observed, pooling, postings, quantized, rag, search
from vecloom.operators.text_similarity import text_similarity as compare_texts
from vecloom.plans.passages import expected_documents
from vecloom.sources import bucketed, maintenance, status, tables
from vecloom.sources.scratch import materialize, scratch_path
from vecloom.streaming import embed, watched

Query = Callable[[SparkSession, str], DataFrame]

# The embeddings table has its own dimension; the text queries use the default.
TABLE_SPEC = V.EncoderSpec(name="table-64", dim=64)
SMALL_SPEC = V.EncoderSpec(name="hashing-64", dim=64).whole_text()
ASYMMETRIC = V.HASHING_ASYMMETRIC.whole_text()

SEARCH_TEXT = "the thorreou of inin and tion hethan"
PRODUCT_TEXT = "red widget for small orders"
THRESHOLD = 0.2


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents to encode, spread over all cores."""
    return tables.spread(load(spark, sf_dir, "documents").select("doc_id", *columns), "doc_id")


def rounded(value: str | Column, digits: int = 6) -> Column:
    return F.round(F.col(value) if isinstance(value, str) else value, digits)


def checksum(vec: str | Column, digits: int = 6) -> Column:
    """Position-weighted sum of a vector, enough to tell two vectors apart."""
    vec = F.col(vec) if isinstance(vec, str) else vec
    weighted = F.transform(vec, lambda x, i: x.cast("double") * (i + 1))
    return F.round(F.aggregate(weighted, F.lit(0.0), lambda s, x: s + x), digits)


def nonzero(vec: str | Column) -> Column:
    vec = F.col(vec) if isinstance(vec, str) else vec
    return F.size(F.filter(vec, lambda x: x != 0)).cast("long")


def fingerprint(df: DataFrame, *keys: str, vec: str = "embedding") -> DataFrame:
    return df.select(*keys, nonzero(vec).alias("nnz"), checksum(vec).alias("checksum"))


# Vector maths ---------------------------------------------------------------


def _neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "embeddings")
    a = e.select("vec_id", F.col("embedding").alias("a"))
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return a.join(b, "vec_id")


def _pairwise(function) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _neighbours(spark, sf_dir).select("vec_id", rounded(function("a", "b", out="double")).alias("value"))

    return query


def vector_edge_cases(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    v = F.col("embedding")
    short, empty = F.slice(v, 1, 63), F.slice(v, 1, 0)
    zero = F.transform(v, lambda x: F.lit(0.0).cast("float"))
    missing = F.lit(None).cast("array<float>")
    holed = F.transform(v, lambda x, i: F.when(i != 3, x))
    wide = lambda c: c.cast("double")
    return e.select(
        "vec_id",
        wide(V.cosine_similarity(v, short)).alias("cosine_mismatch"),
        wide(V.cosine_similarity(empty, empty)).alias("cosine_empty"),
        wide(V.cosine_similarity(v, zero)).alias("cosine_zero"),
        wide(V.cosine_similarity(v, missing)).alias("cosine_null"),
        wide(V.cosine_similarity(v, holed)).alias("cosine_null_element"),
        wide(V.cosine_distance(v, short)).alias("distance_mismatch"),
        wide(V.cosine_distance(v, zero)).alias("distance_zero"),
        wide(V.l2_distance(v, short)).alias("l2_mismatch"),
        rounded(V.l2_distance(v, zero, out="double")).alias("l2_zero"),
        wide(V.dot_product(v, short)).alias("dot_mismatch"),
        F.isnan(V.vector_distance(v, zero)).alias("sort_distance_is_nan"),
        (V.assert_dim(short, 64, strict=False).isNull()).alias("lenient_dim_is_null"),
    )


def vector_literal(spark, sf_dir):
    return load(spark, sf_dir, "embeddings").select("vec_id", V.vector_literal("embedding").alias("literal"))


def vector_literal_roundtrip(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings").withColumn("parsed", V.parse_vector(V.vector_literal("embedding"), 64))
    return e.select("vec_id", (F.col("parsed") == F.col("embedding")).alias("same"))


def l2_normalize(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    scaled = F.transform("embedding", lambda x: (x * 3).cast("float"))
    return e.select("vec_id", checksum(V.l2_normalize(scaled), 4).alias("checksum"))


def _heavy(vec: str = "embedding") -> Column:
    """A 0/1 mask taken from the data, like an attention mask."""
    return (F.get(vec, F.lit(0)) > 0).cast("double")


def mean_pool(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings").withColumn("mask", _heavy())
    pooled = pooling.mean_pool(e, "label", "embedding", mask="mask")
    return pooled.select(F.col("label").cast("long").alias("label"), checksum("embedding", 4).alias("checksum"))


def cls_pool(spark, sf_dir):
    pooled = pooling.cls_pool(load(spark, sf_dir, "embeddings"), "label", "embedding", "vec_id")
    return pooled.select(F.col("label").cast("long").alias("label"), checksum("embedding", 5).alias("checksum"))


# Encoding -------------------------------------------------------------------


def encode_documents(spark, sf_dir):
    docs = texts(spark, sf_dir, "text")
    encoded = maintenance.encode_documents(docs, "text", V.HASHING_WHOLE)
    return fingerprint(encoded, "doc_id", "model")


def encode_documents_token_limit(spark, sf_dir):
    docs = texts(spark, sf_dir, "text")
    return fingerprint(maintenance.encode_documents(docs, "text", V.HASHING_512), "doc_id")


def encode_queries(spark, sf_dir):
    return fingerprint(maintenance.encode_queries(load(spark, sf_dir, "benchmark"), "text", ASYMMETRIC), "item_id")


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = tables.spread(load(spark, sf_dir, "part"), "p_partkey").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("description"),
        F.col("p_retailprice").alias("price"),
        F.col("p_brand").alias("category"),
    )
    return maintenance.encode_documents(part, V.compose_text("name", "description"), V.HASHING)


def encode_composed_text(spark, sf_dir):
    return fingerprint(_products(spark, sf_dir), "id")


def encode_batch(spark, sf_dir):
    part = tables.spread(load(spark, sf_dir, "part"), "p_partkey")
    fields = F.array("p_name", "p_type", F.lit(""), "p_brand")
    vectors = part.select("p_partkey", V.embed_encode_batch(fields).alias("vectors"))
    return vectors.select(
        "p_partkey",
        F.size("vectors").cast("long").alias("n"),
        *[checksum(F.get("vectors", F.lit(i))).alias(f"checksum_{i}") for i in range(4)],
    )


def embed_text_literal(spark, sf_dir):
    talk = tables.spread(load(spark, sf_dir, "conversations"), "conv_id", "turn")
    same = V.parse_vector(V.embed_text("text", V.HASHING_WHOLE), V.HASHING.dim)
    return fingerprint(talk.withColumn("embedding", same), "conv_id", "turn")


def embed_query_text_literal(spark, sf_dir):
    asked = load(spark, sf_dir, "benchmark")
    parsed = V.parse_vector(V.embed_query_text("text", ASYMMETRIC), ASYMMETRIC.dim)
    return fingerprint(asked.withColumn("embedding", parsed), "item_id")


def text_similarity(spark, sf_dir):
    talk = load(spark, sf_dir, "conversations")
    turns = talk.select("conv_id", "turn", F.col("text").alias("first"))
    replies = talk.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("second"))
    scored = compare_texts(turns.join(replies, ["conv_id", "turn"]), "first", "second", V.HASHING_WHOLE)
    return scored.select("conv_id", "turn", rounded("similarity").alias("similarity"))


def sql_functions(spark, sf_dir):
    register_functions(spark, V.HASHING_WHOLE)
    tables.register_view(load(spark, sf_dir, "benchmark"), "vecloom_texts")
    # A session variable is encoded once and reaches the query as a literal.
    spark.sql("DECLARE OR REPLACE VARIABLE vecloom_query ARRAY<FLOAT>")
    spark.sql(f"SET VAR vecloom_query = (SELECT embed_query('{SEARCH_TEXT}'))")
    return spark.sql(
        """
        SELECT item_id, embed_model() AS model, CAST(embed_dim() AS BIGINT) AS dim,
               round(CAST(cosine_similarity(embed_encode(text), vecloom_query) AS DOUBLE), 4) AS score
        FROM vecloom_texts
        """
    )


def sql_vector_search(spark, sf_dir):
    register_functions(spark, V.HASHING_WHOLE)
    tables.register_view(load(spark, sf_dir, "embeddings"), "vecloom_vectors")
    spark.sql("DECLARE OR REPLACE VARIABLE vecloom_probe ARRAY<FLOAT>")
    spark.sql("SET VAR vecloom_probe = (SELECT parse_vector(vector_literal(embedding), 64) FROM vecloom_vectors WHERE vec_id = 0)")
    return spark.sql(
        """
        SELECT vec_id, round(1 - distance, 6) AS similarity
        FROM (SELECT vec_id, vector_distance(to_vector(embedding, 64), vecloom_probe) AS distance FROM vecloom_vectors)
        ORDER BY distance, vec_id LIMIT 5
        """
    )


def _counters(spark: SparkSession, rows: DataFrame, seen, purpose: str) -> DataFrame:
    materialize(rows, purpose)
    found = seen.get
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{name} long" for name in found))


def encode_warnings(spark, sf_dir):
    docs = texts(spark, sf_dir, "lang", "text")
    odd = F.when(F.col("lang") == "fr", "").when(F.col("lang") != "de", F.col("text"))
    encoded, seen = observed.encode_observed(docs.withColumn("text", odd), "text", V.HASHING_WHOLE)
    return _counters(spark, encoded, seen, "encoded")


def similarity_warnings(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings").withColumn("a", F.col("embedding"))
    zero = F.transform("embedding", lambda x: F.lit(0.0).cast("float"))
    odd = F.when(F.col("label") == 1, F.slice("embedding", 1, 63)).when(F.col("label") == 2, zero)
    pairs = e.withColumn("b", odd.when(F.col("label") != 3, F.col("embedding")))
    scored, seen = observed.similarity_observed(pairs.select("vec_id", "a", "b"), "a", "b")
    return _counters(spark, scored, seen, "scored")


# Retrieval ------------------------------------------------------------------


def _first_vector(e: DataFrame) -> DataFrame:
    return e.filter(F.col("vec_id") == 0)


def _score_rows(df: DataFrame, *keys: str, score: str = "score") -> DataFrame:
    return df.select(*keys, rounded(score).alias(score))


def search_topk(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    return _score_rows(search.search_topk(e, _first_vector(e), 5, id_col="vec_id"), "vec_id", "label")


def search_threshold(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    return _score_rows(search.search_threshold(e, _first_vector(e), THRESHOLD, id_col="vec_id"), "vec_id", "label")


def search_filtered(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    hits = search.search_topk(e, _first_vector(e), 5, id_col="vec_id", where=F.col("label") == 2)
    return _score_rows(hits, "vec_id", "label")


def search_distance(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    hits = search.search_distance(e, _first_vector(e), 5, id_col="vec_id")
    return _score_rows(hits, "vec_id", score="similarity")


def search_documents(spark, sf_dir):
    docs = texts(spark, sf_dir, "lang", "text")
    encoded = maintenance.encode_documents(docs, "text", V.HASHING_WHOLE)
    hits = search.search_topk(encoded, SEARCH_TEXT, 10, id_col="doc_id", spec=V.HASHING_WHOLE)
    return _score_rows(hits, "doc_id", "lang")


def search_documents_postings(spark, sf_dir):
    """The same from impact-ordered postings, which are read as far as the tenth score asks."""
    docs = materialize(maintenance.encode_documents(texts(spark, sf_dir, "lang", "text"), "text", V.HASHING_WHOLE).drop("text"), "encoded")
    path = scratch_path(spark, "postings")
    postings.build_postings(docs, path, id_col="doc_id")
    question = spark.range(1).select(F.col("id").alias("q"), V.embed_query(F.lit(SEARCH_TEXT), V.HASHING_WHOLE).alias("embedding"))
    found = postings.postings_search(question, postings.load_postings(spark, path), 10)
    return _score_rows(found.join(docs.select("doc_id", "lang"), F.col("id") == F.col("doc_id")), "doc_id", "lang")


def search_products(spark, sf_dir):
    hits = search.search_products(_products(spark, sf_dir), PRODUCT_TEXT, 5)
    return hits.select("id", "name", "description", "price", rounded("similarity").alias("similarity"))


def search_products_by_category(spark, sf_dir):
    hits = search.search_products_by_category(_products(spark, sf_dir), PRODUCT_TEXT, "Brand#2", 5)
    return hits.select("id", "name", "price", rounded("similarity").alias("similarity"))


def _chunks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = texts(spark, sf_dir, "lang", "text", "source")
    return chunking.chunk_documents(docs, id_col="doc_id", title_col="lang", content_col="text")


def chunk_documents(spark, sf_dir):
    _, chunks = _chunks(spark, sf_dir)
    return chunks.select("id", "parent_id", F.col("chunk_index").cast("long").alias("chunk_index"), "title", "content",
                         "source", "metadata")


def chunk_parents(spark, sf_dir):
    parents, _ = _chunks(spark, sf_dir)
    return parents.select("id", "title", F.length("content").cast("long").alias("n_chars"), "source", "metadata")


def rag_search(spark, sf_dir):
    hits = rag.rag_search(rag.embed_chunks(_chunks(spark, sf_dir)[1]), SEARCH_TEXT, 5)
    return hits.select("id", "title", "content", "source", rounded("similarity").alias("similarity"))


def rag_search_with_context(spark, sf_dir):
    hits = rag.rag_search_with_context(rag.embed_chunks(_chunks(spark, sf_dir)[1]), SEARCH_TEXT)
    return hits.select("chunk_id", "title", "combined_content", "source", rounded("similarity").alias("similarity"))


def rag_stored_context(spark, sf_dir):
    """The same over a stored table of chunks: encoded once, neighbours joined where they lie."""
    table = "vecloom_chunks_" + uuid.uuid4().hex
    chunks = rag.store_chunks(rag.embed_chunks(_chunks(spark, sf_dir)[1]), table, scratch_path(spark, "chunks"), buckets=8)
    question = spark.range(1).select(F.col("id").alias("q"), V.embed_query(F.lit(SEARCH_TEXT), V.HASHING).alias("embedding"))
    hits = rag.rag_batch_with_context(chunks, question)
    return hits.select("chunk_id", "title", "combined_content", "source", rounded("similarity").alias("similarity"))


# The same as SQL table functions --------------------------------------------


def _view(df: DataFrame) -> str:
    """A view of its own, so that queries of one session do not meet."""
    name = "vecloom_" + uuid.uuid4().hex
    tables.register_view(df, name)
    return name


def sql_search_products(spark, sf_dir):
    table_functions.register_product_search(spark, _view(_products(spark, sf_dir)), V.HASHING)
    return spark.sql(f"SELECT id, name, description, price, round(similarity, 6) AS similarity FROM search_products('{PRODUCT_TEXT}')")


def sql_search_products_by_category(spark, sf_dir):
    table_functions.register_product_search(spark, _view(_products(spark, sf_dir)), V.HASHING)
    return spark.sql(f"""SELECT id, name, price, round(similarity, 6) AS similarity
        FROM search_products_by_category('{PRODUCT_TEXT}', cat => 'Brand#2')""")


def _chunk_view(spark: SparkSession, sf_dir: str) -> None:
    embedded = materialize(rag.embed_chunks(_chunks(spark, sf_dir)[1]), "chunks")
    table_functions.register_passage_search(spark, _view(embedded), V.HASHING)


def sql_rag_search(spark, sf_dir):
    _chunk_view(spark, sf_dir)
    return spark.sql(f"SELECT id, title, content, source, round(similarity, 6) AS similarity FROM rag_search('{SEARCH_TEXT}')")


def sql_rag_search_with_context(spark, sf_dir):
    _chunk_view(spark, sf_dir)
    return spark.sql(f"""SELECT chunk_id, title, combined_content, source, round(similarity, 6) AS similarity
        FROM rag_search_with_context('{SEARCH_TEXT}')""")


def sql_chunk_text(spark, sf_dir):
    table_functions.register_chunking(spark)
    docs = _view(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return spark.sql(f"""SELECT doc_id, CAST(c.chunk_index AS BIGINT) AS chunk_index, c.chunk
        FROM {docs} d, LATERAL chunk_text(d.text) c""")


def _ranked(df: DataFrame) -> DataFrame:
    return df.select("q", "id", rounded("score").alias("score"), F.col("rank").cast("long").alias("rank"))


def knn_join(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    return _ranked(knn.knn_join(e, e, 5, query_id="vec_id", doc_id="vec_id"))


def knn_join_bounded(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    return _ranked(bounded.knn_join_bounded(e, e, 5, query_id="vec_id", doc_id="vec_id"))


def rank_of(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    firsts = pooling.cls_pool(e, "label", "embedding", "vec_id")
    firsts = firsts.select(F.col("label").cast("long").alias("label"), "embedding")
    judged = e.select(F.col("label").cast("long").alias("label"), "vec_id")
    ranked = evaluate.rank_of(firsts, judged, e, query_id="label", doc_id="vec_id")
    return ranked.select("q", "id", "rank", rounded("score").alias("score"), rounded("margin").alias("margin"))


# Approximate retrieval ------------------------------------------------------


def _ivf(spark: SparkSession, sf_dir: str, probes: int, cells: int = 16) -> DataFrame:
    e = load(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "ivf")
    ann.build_ivf(e, path, cells)
    index, centroids = ann.load_ivf(spark, path)
    return _ranked(ann.ivf_search(e, index, centroids, 5, probes, query_id="vec_id", doc_id="vec_id"))


def ann_ivf_full_probe(spark, sf_dir):
    return _ivf(spark, sf_dir, probes=16)


def ann_ivf(spark, sf_dir):
    """Cells around the mean vector of every label, so that the cells can be repeated in SQL."""
    e = load(spark, sf_dir, "embeddings")
    parts = e.select("label", F.posexplode("embedding").alias("at", "x")).groupBy("label", "at").agg(F.avg(F.col("x").cast("double")))
    means = {(r[0], r[1]): r[2] for r in parts.collect()}  # labels x dimensions
    labels, dims = (sorted({key[i] for key in means}) for i in (0, 1))
    path = scratch_path(spark, "ivf")
    ann.build_ivf(e, path, centroids=np.array([[means[c, d] for d in dims] for c in labels]))
    index, centroids = ann.load_ivf(spark, path)
    return _ranked(ann.ivf_search(e, index, centroids, 5, 4, query_id="vec_id", doc_id="vec_id"))


def ann_lsh(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    return _ranked(ann.lsh_search(e, e, 5, query_id="vec_id", doc_id="vec_id"))


def ann_filtered(spark, sf_dir):
    """All cells that may hold rows of two labels, so that the answers are exact within the filter."""
    e = load(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "filtered")
    filtered.build_filtered(e, path, ["label", "vec_id"], 16)
    where = [filtered.Condition("label", values=(2, 7)), filtered.Condition("vec_id", low=10)]
    found = filtered.search_where(e, filtered.load_filtered(spark, path), where, 5, probes=16, query_id="vec_id", doc_id="vec_id")
    return _ranked(found)


def ann_graph(spark, sf_dir):
    """A graph over several shards, so that beams have to cross from one to another."""
    e = load(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "graph")
    graph.build_graph(e, path, graph.GraphSpec(shard_rows=1_024), id_col="vec_id", cells=4)
    found = graph.graph_search(e, graph.load_graph(spark, path), 5, probes=1, width=16, hops=2, exits=64, query_id="vec_id")
    return _ranked(found)


def ann_pq(spark, sf_dir):
    """Eight bytes a vector, and the exact cosine of the hundred best."""
    e = load(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "codes")
    quantized.build_codes(e, path, quantized.fit_codebooks(e, parts=8), id_col="vec_id")
    codes, books = quantized.load_codes(spark, path)
    return _ranked(quantized.pq_search(e, e, codes, books, 5, rerank=100, query_id="vec_id", doc_id="vec_id"))


# Evaluation -----------------------------------------------------------------


def _evaluation(spark: SparkSession, sf_dir: str, specs: list[V.EncoderSpec]) -> list[DataFrame]:
    documents = texts(spark, sf_dir, "text")
    benchmark = load(spark, sf_dir, "benchmark")
    expected = materialize(expected_documents(benchmark, documents, "item_id", "doc_id"), "expected")
    asked = benchmark.join(expected, benchmark.item_id == expected.p).select("item_id", "expect", "text")
    results = []
    for spec in specs:
        docs = materialize(maintenance.encode_documents(documents, "text", spec).drop("text"), "eval_docs")
        queries = maintenance.encode_queries(asked, "text", spec)
        results.append(evaluate.evaluate(queries, docs, query_id="item_id", doc_id="doc_id"))
    return results


def eval_per_query(spark, sf_dir):
    (result,) = _evaluation(spark, sf_dir, [V.HASHING_WHOLE])
    return evaluate.report(result)


def eval_summary(spark, sf_dir):
    (result,) = _evaluation(spark, sf_dir, [V.HASHING_WHOLE])
    return evaluate.summarize(result, V.HASHING_WHOLE.name)


def compare_models(spark, sf_dir):
    before, after = _evaluation(spark, sf_dir, [V.HASHING_WHOLE, SMALL_SPEC])
    compared = evaluate.compare_models(before, after)
    scores = [rounded(c, 4).alias(c) for c in ("score_a", "score_b", "score_delta")]
    return compared.select("query", "rank_a", "rank_b", "rank_delta", *scores)


def compare_summaries(spark, sf_dir):
    specs = [V.HASHING_WHOLE, SMALL_SPEC]
    rows = [evaluate.summarize(r, s.name) for r, s in zip(_evaluation(spark, sf_dir, specs), specs)]
    return evaluate.compare_summaries(*rows)


# Table maintenance ----------------------------------------------------------


def _marked(df: DataFrame, marked: Column | None = None) -> DataFrame:
    """A stored vector that no encoder makes, so kept and new ones differ."""
    dim = V.HASHING_WHOLE.dim
    mark = F.array_repeat(F.lit(0.5).cast("float"), dim)
    vec = mark if marked is None else F.when(marked, mark)
    return df.withColumns({"embedding": vec, "model": F.lit(V.HASHING_WHOLE.name), "dim": F.lit(dim)})


def backfill_missing(spark, sf_dir):
    docs = _marked(texts(spark, sf_dir, "lang", "text"), F.col("lang") != "en")
    return fingerprint(maintenance.backfill_missing(docs, "text", V.HASHING_WHOLE), "doc_id")


def reembed_stale(spark, sf_dir):
    docs = _marked(texts(spark, sf_dir, "lang", "text"))
    old = F.when(F.col("lang") == "fr", F.lit("older-model")).when(F.col("lang") != "de", F.col("model"))
    fresh = maintenance.reembed_stale(docs.withColumn("model", old), "text", V.HASHING_WHOLE)
    return fingerprint(fresh, "doc_id", "model")


def _upsert(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    docs = texts(spark, sf_dir, "lang", "text")
    existing = _marked(docs.filter(F.col("lang") != "fr"))
    edited = F.when(F.col("lang") == "en", F.concat("text", F.lit(" updated once"))).otherwise(F.col("text"))
    changes = docs.filter(F.col("lang") != "de").withColumn("text", edited)
    return maintenance.upsert_embeddings(existing, changes, "doc_id", ["text"], "text", V.HASHING_WHOLE, mode)


def upsert_embeddings(spark, sf_dir):
    return fingerprint(_upsert(spark, sf_dir, "on_change"), "doc_id", "lang")


def upsert_if_null(spark, sf_dir):
    return fingerprint(_upsert(spark, sf_dir, "if_null"), "doc_id", "lang")


def upsert_bucketed(spark, sf_dir):
    """The changes of ``upsert_embeddings`` on a stored table, whose files are rewritten where a changed key meets them."""
    docs = texts(spark, sf_dir, "lang", "text")
    edited = F.when(F.col("lang") == "en", F.concat("text", F.lit(" updated once"))).otherwise(F.col("text"))
    root = scratch_path(spark, "bucketed")
    bucketed.create(_marked(docs.filter(F.col("lang") != "fr")), root, "doc_id", buckets=16)
    bucketed.upsert(docs.filter(F.col("lang") != "de").withColumn("text", edited), root, ["text"], "text", V.HASHING_WHOLE)
    return fingerprint(bucketed.read(spark, root), "doc_id", "lang")


def upsert_partial_columns(spark, sf_dir):
    """Changes without the text: other columns and the vector stay."""
    existing = _marked(load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
    changes = load(spark, sf_dir, "documents").filter("lang = 'de'").select("doc_id", F.lit("moved").alias("source"))
    merged = maintenance.upsert_embeddings(existing, changes, "doc_id", ["text"], "text", V.HASHING_WHOLE)
    return fingerprint(merged.withColumn("n_chars", F.length("text").cast("long")), "doc_id", "lang", "source", "n_chars")


def append_null_keys(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select(F.when(F.col("lang") != "fr", F.col("doc_id")).alias("doc_id"), "source")
    existing = docs.filter(F.col("doc_id").isNull() | (F.col("doc_id") % 2 == 0))
    return maintenance.append_ignore_conflicts(docs, existing, ["doc_id"], first_by="source")


def source_lookup(spark, sf_dir):
    return load(spark, sf_dir, "documents").filter(F.col("source") == "src3").select("doc_id", "lang")


def append_ignore_conflicts(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    again = docs.withColumn("source", F.concat(F.lit("again "), F.col("source")))
    existing = docs.filter(F.col("lang").isin("en", "fr"))
    return maintenance.append_ignore_conflicts(docs.unionByName(again), existing, ["doc_id"], first_by="source")


def column_defaults(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", F.when(F.col("lang") != "en", F.col("source")).alias("source"))
    filled = tables.with_defaults(docs, {"source": "unknown", "metadata": "{}", "chunk_index": F.lit(0).cast("long")})
    return filled.select("doc_id", "source", "metadata", "chunk_index", F.col("created_at").isNotNull().alias("dated"))


def append_rows(spark, sf_dir):
    path = scratch_path(spark, "appended")
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    for part in (docs.filter(F.col("lang") == "en"), docs.filter(F.col("lang") != "en")):
        tables.append_rows(part, path)
    return tables.read_table(spark, path, docs.schema)


def latest_changes(spark, sf_dir):
    talk = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return maintenance.latest_changes(talk, "conv_id", "turn")


def replace_table(spark, sf_dir):
    root = scratch_path(spark, "versions")
    tables.replace_table(_marked(texts(spark, sf_dir, "text")), root)
    current = tables.current_table(spark, root)
    tables.replace_table(maintenance.encode_documents(current, "text", V.HASHING_WHOLE), root)
    return fingerprint(tables.current_table(spark, root), "doc_id")


def add_vector_column(spark, sf_dir):
    e = tables.add_vector_column(load(spark, sf_dir, "embeddings"), "embedding", "vec", 64)
    return e.select("vec_id", F.size("vec").cast("long").alias("dim"), checksum("vec", 5).alias("checksum"))


def embedding_status(spark, sf_dir):
    return status.embedding_status(load(spark, sf_dir, "embeddings"), TABLE_SPEC)


def metadata_filter(spark, sf_dir):
    events = load(spark, sf_dir, "events").filter(tables.metadata_equals("props", "$.k", 7))
    return events.select("event_id", "event_type")


# Streams --------------------------------------------------------------------


def stream_embed(spark, sf_dir):
    root = scratch_path(spark, "stream_embed")
    schema = load(spark, sf_dir, "documents").schema
    # As a glob the table may be one file or a folder of them; the stream takes neither a plain file nor nested files otherwise.
    arriving = spark.readStream.schema(schema).parquet(f"{sf_dir.rstrip('/')}/{{documents.parquet}}")
    embedded = embed.stream_embed(arriving.select("doc_id", "text"), "text", V.HASHING_WHOLE).drop("text")
    embed.write_appends(embedded, f"{root}/table", f"{root}/checkpoint", once=True).awaitTermination()
    return fingerprint(spark.read.parquet(f"{root}/table"), "doc_id")


def stream_upsert(spark, sf_dir):
    root = scratch_path(spark, "stream_upsert")
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "text", F.lit(1).alias("seq"))
    edited = docs.filter(F.col("lang") == "en").withColumns(
        {"text": F.concat("text", F.lit(" updated twice")), "seq": F.lit(3)}
    )
    draft = edited.withColumns({"text": F.lit("draft"), "seq": F.lit(2)})
    # Two runs of one stream: all rows first, then two edits of some of them.
    for step, rows in enumerate((docs, draft.unionByName(edited))):
        rows.write.parquet(f"{root}/changes/step={step}")
        arriving = spark.readStream.schema(docs.schema).parquet(f"{root}/changes/*")
        embed.stream_upsert(arriving, f"{root}/table", f"{root}/checkpoint", key="doc_id", text="text", order_by="seq",
                            spec=V.HASHING_WHOLE, once=True).awaitTermination()
    return fingerprint(embed.read_upserts(spark, f"{root}/table", "doc_id", "seq"), "doc_id", "lang")


def stream_upsert_out_of_order(spark, sf_dir):
    root = scratch_path(spark, "stream_upsert_late")
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "text", F.lit(5).alias("seq"))
    late = docs.filter(F.col("lang") == "en").withColumns({"text": F.lit("too late"), "seq": F.lit(2)})
    for step, rows in enumerate((docs, late)):
        rows.write.parquet(f"{root}/changes/step={step}")
        arriving = spark.readStream.schema(docs.schema).parquet(f"{root}/changes/*")
        embed.stream_upsert(arriving, f"{root}/table", f"{root}/checkpoint", key="doc_id", text="text", order_by="seq",
                            spec=V.HASHING_WHOLE, once=True).awaitTermination()
    return fingerprint(embed.read_upserts(spark, f"{root}/table", "doc_id", "seq"), "doc_id", "lang")


def stream_upsert_watched(spark, sf_dir):
    """All rows first; then sources that move, texts that change, and changes that come too late."""
    root = scratch_path(spark, "stream_watched")
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text", F.lit(5).alias("seq"))
    moved = docs.filter("lang = 'en'").withColumns({"source": F.lit("moved"), "seq": F.lit(6)})
    edited = docs.filter("lang = 'fr'").withColumns({"text": F.concat("text", F.lit(" updated twice")), "seq": F.lit(7)})
    late = docs.filter("lang = 'de'").withColumns({"text": F.lit("too late"), "seq": F.lit(2)})
    for step, rows in enumerate((docs, moved.unionByName(edited).unionByName(late))):
        rows.write.parquet(f"{root}/changes/step={step}")
        arriving = spark.readStream.schema(docs.schema).parquet(f"{root}/changes/*")
        watched.stream_upsert_watched(arriving, f"{root}/table", f"{root}/checkpoint", key="doc_id", watched=["text"], text="text",
                                      order_by="seq", spec=V.HASHING_WHOLE, once=True).awaitTermination()
    return fingerprint(watched.read_watched(spark, f"{root}/table", "doc_id"), "doc_id", "lang", "source", "vector_version")


QUERIES: dict[str, Query] = {
    "cosine_similarity": _pairwise(V.cosine_similarity),
    "cosine_distance": _pairwise(V.cosine_distance),
    "l2_distance": _pairwise(V.l2_distance),
    "dot_product": _pairwise(V.dot_product),
    **{
        q.__name__: q
        for q in (
            vector_edge_cases, vector_literal, vector_literal_roundtrip, l2_normalize, mean_pool, cls_pool,
            encode_documents, encode_documents_token_limit, encode_queries, encode_composed_text, encode_batch,
            embed_text_literal, embed_query_text_literal, text_similarity, sql_functions, sql_vector_search,
            encode_warnings, similarity_warnings, search_topk, search_threshold, search_filtered, search_distance, search_documents, search_documents_postings, search_products,
            search_products_by_category, chunk_documents, chunk_parents, rag_search, rag_search_with_context,
            rag_stored_context,
            sql_search_products, sql_search_products_by_category, sql_rag_search, sql_rag_search_with_context, sql_chunk_text,
            knn_join, knn_join_bounded, rank_of, ann_ivf_full_probe, ann_ivf, ann_lsh, ann_filtered, ann_graph, ann_pq,
            eval_per_query, eval_summary, compare_models, compare_summaries,
            backfill_missing, reembed_stale, upsert_embeddings, upsert_if_null, upsert_bucketed, upsert_partial_columns,
            append_ignore_conflicts, append_null_keys, source_lookup, column_defaults,
            append_rows, latest_changes,
            replace_table, add_vector_column, embedding_status, metadata_filter, stream_embed, stream_upsert,
            stream_upsert_out_of_order, stream_upsert_watched,
        )
    },
}
