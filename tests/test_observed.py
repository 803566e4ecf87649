"""Counts taken beside the rows."""

from vecloom.functions import EncoderSpec
from vecloom.operators import observed

SPEC = EncoderSpec(name="eight", dim=8)


def test_encoding_counts_its_odd_texts_in_one_pass(spark):
    rows = [(0, "some words"), (1, ""), (2, None), (3, "?!"), (4, "more"), (5, "")]
    df = spark.createDataFrame(rows, "id int, text string").repartition(3)
    encoded, seen = observed.encode_observed(df, "text", SPEC)
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("CollectMetrics") == 1
    assert len(encoded.collect()) == 6
    assert seen.get == {"rows": 6, "null_texts": 1, "empty_texts": 2, "zero_vectors": 3}


def test_similarity_counts_its_odd_vectors(spark):
    rows = [([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0], [1.0, 1.0]), (None, [1.0]), ([1.0], None), ([], []), ([0.0], [0.0, 0.0])]
    scored, seen = observed.similarity_observed(spark.createDataFrame(rows, "a array<float>, b array<float>"), "a", "b")
    assert len(scored.collect()) == 7
    assert seen.get == {"rows": 7, "missing": 2, "unequal_lengths": 2, "zero_vectors": 2}


def test_empty_table(spark):
    encoded, seen = observed.encode_observed(spark.createDataFrame([], "text string"), "text", SPEC)
    assert encoded.collect() == [] and seen.get["rows"] == 0
