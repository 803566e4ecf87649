"""The rule ensemble: statistics against plain counting, rules as columns, held-out accuracy, edge cases."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from compare import SF_DIR
from pyspark.sql import functions as F

from vecloom.llm import quality
from vecloom.llm.queries import QUERIES

TEXTS = ["", "One line.\nTwo line.\nTwo line.", "A | B | C", "LOUD!! LOUD!!\nquiet text here.", "\n\n", "é ü ß", "x" * 50_000, "a a b b\n"]


def test_statistics_equal_plain_counts():
    got = {s: c for s, c in zip(quality.STATS, quality.text_stats(pa.array([*TEXTS, None])).T, strict=True)}
    for i, text in enumerate([*TEXTS, ""]):
        tokens = text.split()
        lines = [line for line in text.split("\n") if line.strip()]
        assert got["log_chars"][i] == pytest.approx(np.log1p(len(text)))
        assert got["words"][i] == pytest.approx(np.log1p(len(tokens)))
        assert got["bars"][i] == pytest.approx(text.count("|") / max(1, len(tokens)))
        assert got["ended_lines"][i] == pytest.approx(sum(line[-1] in ".!?" for line in lines) / max(1, len(lines)))
        assert got["repeated_lines"][i] == pytest.approx(1 - len(set(lines)) / len(lines) if lines else 1)
        assert got["short_lines"][i] == pytest.approx(sum(len(line) < 30 for line in lines) / max(1, len(lines)))
        assert got["long_words"][i] == pytest.approx(sum(len(t) > 16 for t in tokens) / max(1, len(tokens)))
    assert got["doubled_words"][7] == pytest.approx(0.5)


def test_statistics_do_not_depend_on_the_batch():
    alone = np.concatenate([quality.text_stats(pa.array([t])) for t in TEXTS])
    assert np.allclose(quality.text_stats(pa.array(TEXTS)), alone)


def test_held_out_accuracy(spark):
    result = QUERIES["op9_rule_ensemble_quality"](spark, SF_DIR)
    assert [f.name for f in result.schema] == ["doc_id", "held_out", "score", "predicted"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = result.join(labels, "doc_id").collect()
    assert result.count() == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9


def test_null_and_missing_labels_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, None, 9.0), (None, "text", 8.0), (2, "", 7.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    model = quality.fit_rules(docs, labels)
    rows = quality.score_quality(docs, model).collect()
    assert [r.score for r in rows] == [0.5] * 3 and [r.predicted for r in rows] == [1] * 3
    assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.score_quality(docs.where("false"), model).count() == 0


def test_rules_are_columns(spark):
    rule = quality.Rule((("words", True, 2.0), ("bars", False, 0.5)), 1.5)
    model = quality.RuleEnsemble(-1.0, (rule,))
    docs = spark.createDataFrame([("a | b",), ("| |",)], "text string")
    scores = [r[0] for r in quality.with_stats(docs).select(F.round(model.score(), 6)).collect()]
    assert scores == [round(1 / (1 + np.exp(1.0)), 6), round(1 / (1 + np.exp(-0.5)), 6)]
