"""Search and chunking as SQL table functions with defaults.

    SELECT * FROM search_products('lamp for a workbench');
    SELECT * FROM search_products_by_category('lamp', 'Lighting', limit_count => 3);
    SELECT * FROM rag_search_with_context('when is the ferry late', context_window => 2);
    SELECT d.id, c.* FROM documents d, LATERAL chunk_text(d.content, 500, 50) c;

Their bodies are SQL, so Catalyst sees through a call: filters reach the scan, every task keeps
its best rows and only those meet (``TakeOrderedAndProject``), and chunks are cut where the text
lies.  A ``LIMIT`` can not take a parameter in Spark, so the bodies number the rows and compare;
the planner turns that into a limit up to ``spark.sql.optimizer.windowGroupLimitThreshold`` rows
(1,000 unless set).  Set it above the largest ``limit_count`` in use: beyond it a call is still
right, but orders the whole table in one task.

A call's text is encoded with every batch of rows, which saves a join; for large tables encode it
once into a session variable and search as in :mod:`vecloom.functions.sql`.  Results are those of
:mod:`vecloom.operators.search` and :mod:`vecloom.operators.rag`: scores with nine decimals, ties
to the smaller id, rows without a vector last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vecloom.functions import kernels
from vecloom.functions.encoders import HASHING, EncoderSpec, encoder_udf
from vecloom.functions.kernels import SCORE_DIGITS
from vecloom.functions.sql import _COSINE, query_sql, register_functions

_SEGMENT = 64  # windows of a text that are cut from one piece of it

# Like the score of the Python form: NULL without both vectors, 0 where one of them is zero.
_SCORE = (
    "CASE WHEN a IS NULL OR b IS NULL OR exists(a, x -> x IS NULL) OR exists(b, x -> x IS NULL) THEN NULL "
    "WHEN size(a) <> size(b) THEN 0D "
    f"ELSE round({_COSINE}, {SCORE_DIGITS}) END"
)


def _define(spark: SparkSession, name: str, arguments: str, columns: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE({columns}) RETURN {body}")


def _columns(schema: StructType, **names: str) -> str:
    """Result columns with the types of the table's own: result name = column."""
    return ", ".join(f"`{result}` {schema[column].dataType.simpleString()}" for result, column in names.items())


def _numbered(rows: str, order: str) -> str:
    return f"(SELECT * FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM ({rows})) WHERE place <= limit_count)"


def _scored(view: str, value: str, condition: str = "true") -> str:
    """Rows of a table with the query's vector; there is no join, so the text is encoded with each batch."""
    return f"SELECT t.*, {value} FROM (SELECT *, embed_query(query) AS asked FROM {view}) t WHERE {condition}"


def register_chunking(spark: SparkSession) -> None:
    """``chunk_text(content, size, overlap)``: the windows of one text, for use with ``LATERAL``."""
    step = ("(CASE WHEN size >= 1 AND overlap >= 0 AND overlap < size THEN size - overlap "
            "ELSE raise_error('chunk size must be at least 1, overlap at least 0 and less than it') END)")
    windows = f"(CASE WHEN length(content) >= 1 THEN (length(content) - 1) div {step} + 1 END)"
    piece = f"substring(content, CAST(first * {step} + 1 AS INT), CAST({_SEGMENT - 1} * {step} + size AS INT))"
    many = f"least({_SEGMENT}L, {windows} - first)"
    pieces = f"transform(sequence(0L, {windows} - 1L, {_SEGMENT}L), first -> named_struct('piece', {piece}, 'n', {many}))"
    cut = f"transform(sequence(0L, s.n - 1L), i -> substring(s.piece, CAST(i * {step} + 1 AS INT), size))"
    # One generator: with a second LATERAL Spark would join the texts with themselves.
    _define(spark, "chunk_text", "content STRING, size INT DEFAULT 500, overlap INT DEFAULT 50", "chunk_index INT, chunk STRING",
            f"SELECT at, chunk FROM posexplode(flatten(transform({pieces}, s -> {cut}))) AS w(at, chunk)")


def register_product_search(spark: SparkSession, view: str, spec: EncoderSpec = HASHING) -> None:
    """``search_products(query, limit_count)`` and ``search_products_by_category(query, cat, limit_count)`` over a view."""
    _prepare(spark, spec)
    schema = spark.table(view).schema
    best = "similarity DESC NULLS LAST, id"
    score = "cosine_score(t.embedding, t.asked) AS similarity"
    shown = ("id", "name", "description", "price")
    _define(spark, "search_products", "query STRING, limit_count INT DEFAULT 5",
            _columns(schema, **{c: c for c in shown}) + ", similarity DOUBLE",
            f"SELECT {', '.join(shown)}, similarity FROM {_numbered(_scored(view, score), best)}")
    shown = ("id", "name", "price")
    _define(spark, "search_products_by_category", "query STRING, cat STRING, limit_count INT DEFAULT 5",
            _columns(schema, **{c: c for c in shown}) + ", similarity DOUBLE",
            f"SELECT {', '.join(shown)}, similarity FROM {_numbered(_scored(view, score, 't.category = cat'), best)}")


def register_passage_search(spark: SparkSession, view: str, spec: EncoderSpec = HASHING) -> None:
    """``rag_search(query, limit_count)`` and ``rag_search_with_context(query, context_window, limit_count)`` over a view of chunks."""
    _prepare(spark, spec)
    schema = spark.table(view).schema
    spark.udf.register("vecloom_text_distance", text_distance_udf(spec))
    asked = f"SELECT t.*, vecloom_text_distance(t.embedding, {query_sql('query', spec)}) AS distance FROM {view} t WHERE t.parent_id IS NOT NULL"
    hits = _numbered(asked, "distance ASC NULLS LAST, id")
    similarity = f"round(1D - distance, {SCORE_DIGITS})"
    shown = ("id", "title", "content", "source")
    _define(spark, "rag_search", "query STRING, limit_count INT DEFAULT 5",
            _columns(schema, **{c: c for c in shown}) + ", similarity DOUBLE",
            f"SELECT {', '.join(shown)}, {similarity} FROM {hits}")
    # A hit meets itself, so the join is an inner one and the few hits go to the chunks.
    near = "c.chunk_index BETWEEN h.chunk_index - context_window AND h.chunk_index + context_window"
    _define(spark, "rag_search_with_context", "query STRING, context_window INT DEFAULT 1, limit_count INT DEFAULT 3",
            _columns(schema, chunk_id="id", title="title", combined_content="content", source="source") + ", similarity DOUBLE",
            f"SELECT chunk_id, title, listagg(piece, ' ') WITHIN GROUP (ORDER BY chunk_index), source, similarity FROM "
            f"(SELECT h.id AS chunk_id, h.title, h.source, {similarity} AS similarity, c.chunk_index, "
            f"CASE WHEN {near} THEN c.content END AS piece FROM {view} c JOIN {hits} h "
            f"ON c.parent_id = h.parent_id AND ({near} OR c.id = h.id)) GROUP BY chunk_id, title, source, similarity")


def text_distance_udf(spec: EncoderSpec):
    """Rounded cosine distance of a vector and a text, which is encoded once a batch and never becomes a column of vectors.

    NULL where either is missing, NaN where either is zero, an error where lengths differ, as ``vector_distance``.
    """
    encode = encoder_udf(spec).func

    @F.arrow_udf("double")
    def text_distance(vectors: pa.Array, texts: pa.Array) -> pa.Array:
        if pa.types.is_null(texts.type):
            return pa.nulls(len(vectors), pa.float64())
        coded = texts.dictionary_encode()
        which = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False)
        asked = encode(coded.dictionary)
        out = pa.nulls(len(vectors), pa.float64())
        for i in range(len(asked)):
            of = which == i
            some = vectors if of.all() else vectors.filter(pa.array(of))
            found = kernels.cosine_distances(some, asked[i].values.to_numpy(zero_copy_only=False).astype(np.float64))
            out = found if of.all() else pc.replace_with_mask(out, pa.array(of), found)
        return out

    return text_distance


def _prepare(spark: SparkSession, spec: EncoderSpec) -> None:
    register_functions(spark, spec)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION cosine_score(a ARRAY<FLOAT>, b ARRAY<FLOAT>) RETURNS DOUBLE RETURN {_SCORE}")
