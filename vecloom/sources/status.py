"""Health report of a table of embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.functions.encoders import EncoderSpec
from vecloom.functions.vectors import has_null_element, is_zero_vector


def embedding_status(df: DataFrame, spec: EncoderSpec, vec_col: str = "embedding") -> DataFrame:
    """Rows of (component, status, details): encoder facts, then table counts.

    One pass of conditional counts, turned into rows afterwards.  A count is
    ``ok`` at zero and ``check`` otherwise.
    """
    vec = F.col(vec_col)
    stale = ~F.col("model").eqNullSafe(F.lit(spec.name)) if "model" in df.columns else F.lit(False)
    checks = {
        "missing": vec.isNull(),
        "null_elements": has_null_element(vec),
        "wrong_dimension": F.size(vec) != spec.dim,
        "zero_vectors": (F.size(vec) > 0) & is_zero_vector(vec),
        "stale_model": stale,
    }
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()]
    )
    state = F.when(F.col("rows") > 0, F.lit("ready")).otherwise(F.lit("empty"))

    def line(component: str, status, details):
        return F.struct(F.lit(component).alias("component"), status.alias("status"), details.alias("details"))

    lines = [
        line("embeddings", state, F.concat(F.col("rows").cast("string"), F.lit(" rows"))),
        line("model", F.lit("configured"), F.lit(spec.name)),
        line("dimension", F.lit("configured"), F.lit(f"{spec.dim} dimensions")),
    ]
    for name in checks:
        verdict = F.when(F.col(name) == 0, F.lit("ok")).otherwise(F.lit("check"))
        lines.append(line(name, verdict, F.concat(F.col(name).cast("string"), F.lit(" rows"))))
    return counts.select(F.inline(F.array(*lines)))
