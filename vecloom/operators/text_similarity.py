"""Compare two text columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.functions import kernels
from vecloom.functions.encoders import HASHING, EncoderSpec, embed_encode


def _pair_column(dim: int):
    @F.arrow_udf(T.DoubleType())
    def pair_cosine(a: pa.Array, b: pa.Array) -> pa.Array:
        left, known_a, _ = kernels.pack(a, dim)
        right, known_b, _ = kernels.pack(b, dim)
        scores = np.einsum("ij,ij->i", kernels.unit_rows(left), kernels.unit_rows(right))
        return pa.array(np.round(scores, kernels.SCORE_DIGITS), mask=~(known_a & known_b))

    return pair_cosine


def text_similarity(df: DataFrame, first, second, spec: EncoderSpec = HASHING, out_col: str = "similarity") -> DataFrame:
    """Cosine of the document-side vectors of two texts; 0 if either is empty.

    Row-local: a text that fills the table is encoded where it stands, and no
    join on texts is needed.
    """
    first = first if isinstance(first, Column) else F.col(first)
    second = second if isinstance(second, Column) else F.col(second)
    score = _pair_column(spec.dim)(embed_encode(first, spec), embed_encode(second, spec))
    return df.withColumn(out_col, score)
