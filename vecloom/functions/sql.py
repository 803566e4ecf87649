"""The function surface for Spark SQL sessions.

Similarity functions are SQL expressions that Catalyst inlines; encoders wrap an
Arrow function.  Spark does not resolve SQL-bodied functions directly inside
``ORDER BY``: alias the score in the select list and sort by the alias.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from vecloom.functions.encoders import HASHING, EncoderSpec, batch_encoder_udf, encoder_udf
from vecloom.functions.vectors import FLOAT_MAX, _vector_literal_udf

_SUM = "aggregate({terms}, 0D, (s, x) -> s + x)"
_DOT = _SUM.format(terms="zip_with(a, b, (x, y) -> double(x) * double(y))")
_NORM_A = "sqrt(" + _SUM.format(terms="transform(a, x -> double(x) * double(x))") + ")"
_NORM_B = "sqrt(" + _SUM.format(terms="transform(b, x -> double(x) * double(x))") + ")"
_SQUARES = _SUM.format(terms="zip_with(a, b, (x, y) -> (double(x) - double(y)) * (double(x) - double(y)))")
_NORMS = f"{_NORM_A} * {_NORM_B}"
_COSINE = f"coalesce(try_divide({_DOT}, {_NORMS}), CASE WHEN {_NORMS} = 0 THEN 0D END)"


def _guarded(value: str, sentinel: str) -> str:
    return (
        "float(CASE WHEN a IS NULL OR b IS NULL THEN NULL "
        f"WHEN size(a) <> size(b) OR size(a) = 0 THEN {sentinel} ELSE {value} END)"
    )


_PAIRWISE = {
    "cosine_similarity": _guarded(_COSINE, "0D"),
    "cosine_distance": _guarded(f"1D - ({_COSINE})", "1D"),
    "l2_distance": _guarded(f"sqrt({_SQUARES})", f"double({FLOAT_MAX!r})"),
    "dot_product": _guarded(_DOT, "0D"),
}


# Sort key: NaN for zero vectors, NULL for missing ones, an error where lengths differ.
_SORT_DISTANCE = (
    "CASE WHEN a IS NULL OR b IS NULL OR exists(a, x -> x IS NULL) OR exists(b, x -> x IS NULL) THEN NULL "
    "WHEN size(a) <> size(b) THEN raise_error(concat('different vector dimensions, ', size(a), ' and ', size(b))) "
    f"WHEN {_NORMS} = 0 THEN double('NaN') ELSE 1D - {_DOT} / ({_NORMS}) END"
)
_CHECKED = (
    "CASE WHEN v IS NULL OR size(v) = n THEN v "
    "ELSE raise_error(concat('expected ', n, ' dimensions, not ', size(v))) END"
)


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _define(spark: SparkSession, name: str, arguments: str, returns: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {returns} RETURN {body}")


def query_sql(text: str, spec: EncoderSpec) -> str:
    """The text of a query as the encoder takes it: with its prefix, unless it is empty."""
    if not spec.is_asymmetric:
        return text
    return f"CASE WHEN {text} = '' THEN {text} ELSE concat({_quote(spec.query_prefix)}, {text}) END"


def register_functions(spark: SparkSession, spec: EncoderSpec = HASHING) -> None:
    """Create the session functions, encoding with ``spec``."""
    for name, body in _PAIRWISE.items():
        _define(spark, name, "a ARRAY<FLOAT>, b ARRAY<FLOAT>", "FLOAT", body)
    _define(spark, "vector_distance", "a ARRAY<FLOAT>, b ARRAY<FLOAT>", "DOUBLE", _SORT_DISTANCE)
    _define(spark, "to_vector", "v ARRAY<FLOAT>, n INT", "ARRAY<FLOAT>", _CHECKED)
    parsed = "from_json(literal, 'array<float>', map('mode', 'FAILFAST'))"
    _define(spark, "parse_vector", "literal STRING, n INT", "ARRAY<FLOAT>", f"to_vector({parsed}, n)")
    spark.udf.register("vector_literal", _vector_literal_udf)
    spark.udf.register("embed_encode", encoder_udf(spec))
    query = query_sql("text", spec)
    vector = "ARRAY<FLOAT>"
    _define(spark, "embed_query", "text STRING", vector, f"embed_encode({query})")
    _define(spark, "embed_text", "text STRING", "STRING", "vector_literal(embed_encode(text))")
    _define(spark, "embed_query_text", "text STRING", "STRING", f"vector_literal(embed_encode({query}))")
    _define(spark, "to_embedding", "text STRING", vector, f"to_vector(embed_encode(text), {spec.dim})")
    pair = _PAIRWISE["cosine_similarity"]
    inner = f"SELECT {pair} FROM (SELECT embed_encode(text1) AS a, embed_encode(text2) AS b)"
    _define(spark, "text_similarity", "text1 STRING, text2 STRING", "FLOAT", f"({inner})")
    spark.udf.register("embed_encode_batch", batch_encoder_udf(spec))
    _define(spark, "embed_model", "", "STRING", _quote(spec.name))
    _define(spark, "embed_dim", "", "INT", str(spec.dim))
    _define(spark, "embed_is_asymmetric", "", "BOOLEAN", str(spec.is_asymmetric).lower())
    _define(spark, "embed_info", "", "STRING", _quote(spec.info()))
