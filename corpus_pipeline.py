"""Training-data pipeline: quality filter, line dedup, near-duplicate removal, source mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read again as the next stage's documents.  Every stage but the last returns the columns of
``documents``.

Defined results: texts may be null or empty and rows may repeat in any stage; the operators'
docstrings say what becomes of them.  An empty table passes through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm import line_dedup, mixing, ngram_join, quality, queries
from vecloom.sources.scratch import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the rule ensemble rejects go."""
    model = quality.fit_rules(docs, queries.table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: lines found in many documents stay in one; ``n_chars`` follows the text."""
    kept = line_dedup.dedup_lines(docs)
    length = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", length).select(*docs.columns)


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of every group of near-duplicates the smallest id stays."""
    return ngram_join.keep_one_per_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: sources are replicated towards their target weights and shuffled."""
    return mixing.mix_sources(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: token counts and digests of every document."""
    return queries.token_digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near_copies),
    ("mixing", mix),
    ("tokens", tokens),
]

# Not expressible in SQL: a trained classifier, byte-pair merges.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
