"""Vector maths as column expressions (JVM-side, no Python in the data path).

Every function returns NULL when an input vector is NULL or holds a NULL
element.  Sums run in double; ``out="float"`` (the default) narrows the result
to the single precision of the SQL surface, ``out="double"`` keeps all of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the distance reported for vectors that cannot be compared
# (largest finite single-precision number).
FLOAT_MAX = 3.4028234663852886e38


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def _total(terms: Column) -> Column:
    return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)


def _dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def _norm(a: Column) -> Column:
    return F.sqrt(_total(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def _cosine(a: Column, b: Column, at_zero: float) -> Column:
    """Cosine with its value where a norm is zero; NULL norms stay NULL.

    Dividing first means the norms are only looked at again for a NULL result.
    """
    norms = _norm(a) * _norm(b)
    return F.coalesce(F.try_divide(_dot(a, b), norms), F.when(norms == 0, F.lit(at_zero)))


def _guarded(a: Column, b: Column, value: Column, sentinel: float, out: str) -> Column:
    incomparable = (F.size(a) != F.size(b)) | (F.size(a) == 0)
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
        .when(incomparable, F.lit(sentinel))
        .otherwise(value)
        .cast(out)
    )


def cosine_similarity(a, b, out: str = "float") -> Column:
    """Cosine of the angle; 0 for a length mismatch, empty or zero vectors."""
    a, b = _col(a), _col(b)
    return _guarded(a, b, _cosine(a, b, 0.0), 0.0, out)


def cosine_distance(a, b, out: str = "float") -> Column:
    """``1 - cosine_similarity``; 1 where the vectors cannot be compared."""
    return (F.lit(1.0) - cosine_similarity(a, b, out="double")).cast(out)


def l2_distance(a, b, out: str = "float") -> Column:
    """Euclidean distance; the largest float where lengths differ or are 0."""
    a, b = _col(a), _col(b)
    squares = F.zip_with(
        a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))
    )
    return _guarded(a, b, F.sqrt(_total(squares)), FLOAT_MAX, out)


def dot_product(a, b, out: str = "float") -> Column:
    """Inner product; 0 where lengths differ or are 0."""
    a, b = _col(a), _col(b)
    return _guarded(a, b, _dot(a, b), 0.0, out)


def vector_distance(a, b) -> Column:
    """Double-precision cosine distance used as a sort key.

    Unlike :func:`cosine_distance` it is NaN for a zero vector and an error for
    vectors of different length, the rules of a fixed-dimension vector type.
    """
    a, b = _col(a), _col(b)
    mismatch = F.raise_error(
        F.concat(F.lit("different vector dimensions "), F.size(a).cast("string"), F.lit(" and "), F.size(b).cast("string"))
    ).cast("double")
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
        .when(F.size(a) != F.size(b), mismatch)
        .otherwise(F.lit(1.0) - _cosine(a, b, float("nan")))
    )


def l2_normalize(v) -> Column:
    """Scale to unit length.  A zero vector stays zero (never 0/0)."""
    v = _col(v)
    squares = F.transform(v, lambda x: x.cast("double") * x.cast("double"))

    def scaled(total: Column) -> Column:
        # The finish step binds the total once; inside the element lambda the
        # norm would be summed again for every element.
        unit = F.transform(v, lambda x: F.coalesce(F.try_divide(x.cast("double"), F.sqrt(total)), F.lit(0.0)))
        return F.when(total.isNotNull(), unit.cast("array<float>"))

    return F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x, scaled)


def has_null_element(v) -> Column:
    return F.exists(_col(v), lambda x: x.isNull())


def is_zero_vector(v) -> Column:
    return F.forall(_col(v), lambda x: x == 0)


def assert_dim(v, dim: int, strict: bool = True) -> Column:
    """Pass vectors of ``dim`` elements; raise (or give NULL) for any other."""
    v = _col(v)
    if not strict:
        return F.when(F.size(v) == dim, v)
    bad = F.raise_error(F.concat(F.lit(f"expected {dim} dimensions, not "), F.size(v).cast("string")))
    return F.when(v.isNull() | (F.size(v) == dim), v).otherwise(bad.cast("array<float>"))


def parse_vector(text, dim: int | None = None, strict: bool = True) -> Column:
    """Read a ``[v1,v2,…]`` literal, with an optional dimension check."""
    body = F.trim(_col(text))
    inner = F.regexp_replace(body, r"^\[\s*|\s*\]$", "")
    shaped = body.rlike(r"^\[[^\[\]]*\]$")
    parts = F.when(inner == "", F.array().cast("array<float>")).otherwise(
        F.transform(F.split(inner, ","), lambda x: x.cast("float"))
    )
    if strict:
        bad = F.raise_error(F.concat(F.lit("not a vector literal: "), body)).cast("array<float>")
        parsed = F.when(body.isNull(), F.lit(None).cast("array<float>")).when(shaped, parts).otherwise(bad)
    else:
        lenient = F.transform(F.split(inner, ","), lambda x: x.try_cast("float"))
        empty = F.array().cast("array<float>")
        lenient = F.when(inner == "", empty).otherwise(F.when(~F.exists(lenient, lambda x: x.isNull()), lenient))
        parsed = F.when(shaped, lenient)
    return parsed if dim is None else assert_dim(parsed, dim, strict)


def _plain_decimal(value: str) -> str:
    return np.format_float_positional(np.float32(value), unique=True, trim="-")


def _vector_literals(vectors: pa.Array) -> pa.Array:
    """Arrow kernel behind :func:`vector_literal`: one join per batch."""
    lists = vectors.cast(pa.list_(pa.float32()))
    flat = lists.flatten()
    text = pc.replace_substring_regex(pc.cast(flat, pa.string()), r"\.0$", "")
    # Only the few values that Arrow prints with an exponent take the slow path.
    odd = pc.fill_null(pc.match_substring_regex(text, "[a-zA-Z]"), False)
    if pc.any(odd).as_py():
        at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        values = np.array(text.to_pylist(), dtype=object)
        for i in at:
            values[i] = {"nan": "NaN", "inf": "inf", "-inf": "-inf"}.get(values[i]) or _plain_decimal(values[i])
        text = pa.array(values, pa.string())
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), text), ",")
    framed = pc.binary_join_element_wise("[", joined, "]", "")
    return pc.if_else(lists.is_valid(), framed, pa.scalar(None, pa.string()))


@F.arrow_udf(T.StringType())
def _vector_literal_udf(vectors: pa.Array) -> pa.Array:
    return _vector_literals(vectors)


def vector_literal(v) -> Column:
    """Format as ``[v1,v2,…]``: shortest round-trip decimals, never an exponent.

    The cast of a float to a string in Spark uses exponents and a trailing
    ``.0``, so this formats whole Arrow batches instead.
    """
    return _vector_literal_udf(_col(v))
