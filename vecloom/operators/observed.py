"""Counts of odd inputs, taken in the pass that computes vectors or scores.

Empty texts, vectors of unequal length and zero vectors have defined results and do not stop a
job; these forms also count them.  The counters are aggregates beside the rows
(``Observation``): no second pass over the table, no shuffle.  They are there once an action
has run over the whole result, for example a write; one that stops early, such as ``limit``, counts
what it has seen.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

import vecloom.functions as V
from vecloom.functions.encoders import HASHING, EncoderSpec
from vecloom.sources.maintenance import encode_documents


def _count(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _zero(vec: Column) -> Column:
    """Whole, not empty, and without any number but zero."""
    return (F.size(vec) > 0) & F.forall(vec, lambda x: x.isNotNull() & (x == 0))


def _observe(df: DataFrame, counters: dict[str, Column]) -> tuple[DataFrame, Observation]:
    seen = Observation("vecloom-" + uuid.uuid4().hex)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in counters.items()]), seen


def encode_observed(df: DataFrame, text, spec: EncoderSpec = HASHING, vec_col: str = "embedding") -> tuple[DataFrame, Observation]:
    """:func:`encode_documents`, and counts: ``rows, null_texts, empty_texts, zero_vectors`` (those of empty texts included)."""
    text = text if isinstance(text, Column) else F.col(text)
    encoded = encode_documents(df, text, spec, vec_col)
    return _observe(encoded, {"null_texts": _count(text.isNull()), "empty_texts": _count(text == ""),
                              "zero_vectors": _count(_zero(F.col(vec_col)))})


def similarity_observed(df: DataFrame, a: str, b: str, score_col: str = "score") -> tuple[DataFrame, Observation]:
    """The cosine of two columns, and counts: ``rows, missing, unequal_lengths, zero_vectors`` (on either side)."""
    left, right = F.col(a), F.col(b)
    scored = df.withColumn(score_col, V.cosine_similarity(a, b, out="double"))
    return _observe(scored, {"missing": _count(left.isNull() | right.isNull()), "unequal_lengths": _count(F.size(left) != F.size(right)),
                             "zero_vectors": _count(_zero(left) | _zero(right))})
