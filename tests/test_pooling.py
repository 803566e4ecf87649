"""Mean pooling by whole vectors against plain sums."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecloom.operators import pooling


def plain(rows):
    """Per group and position: weighted sum over weight; NULL elements and masks add nothing, the latter no weight either."""
    groups = {}
    for g, v, m in rows:
        sums = groups.setdefault(g, None)
        if v is not None:
            sums = groups[g] = groups[g] or {}
            for i, x in enumerate(v):
                s, w = sums.get(i, (0.0, 0.0))
                sums[i] = (s + (x or 0.0) * (m or 0.0), w + (m or 0.0))
    return {g: s if s is None else [s[i][0] / max(s[i][1], 1e-9) for i in range(len(s))] for g, s in groups.items()}


@pytest.mark.parametrize("batch", ["10000", "7"])
def test_equals_plain_sums(spark, batch):
    rng = np.random.default_rng(1)
    rows = [(int(g) if g else None, [None if rng.random() < 0.1 else float(x) for x in rng.normal(size=rng.integers(0, 6))]
             if rng.random() < 0.9 else None, None if rng.random() < 0.1 else float(rng.random())) for g in rng.integers(0, 40, 500)]
    rows += [(1, [1.0, 2.0, 3.0], 0.5)] * 400 + [(99, None, 1.0)] * 3 + [(98, [2.0], 0.0)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        df = spark.createDataFrame(rows, "g int, v array<float>, m double").repartition(5)
        got = {r["g"]: r["v"] for r in pooling.mean_pool(df, "g", "v", mask="m", out_col="v").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = plain(rows)
    assert set(got) == set(expected)
    for g, vector in expected.items():
        assert (vector is None) == (got[g] is None)
        assert vector is None or got[g] == pytest.approx(vector, rel=1e-5, abs=1e-6)


def test_groups_of_several_columns_and_odd_values(spark):
    rows = [("a", math.nan, [1.0]), ("a", math.nan, [3.0]), ("a", None, [5.0]), (None, 0.0, [7.0]), (None, -0.0, [9.0])]
    df = spark.createDataFrame(rows, "`k 1` string, x double, v array<double>").repartition(3)
    got = {(r[0], str(r[1])): r[2] for r in pooling.mean_pool(df, ["`k 1`", "x"], "v").collect()}
    assert sorted(got.values()) == [[2.0], [5.0], [8.0]]
    nested = pooling.mean_pool(df.select(F.array("`k 1`").alias("k"), "v"), "k", "v").collect()
    assert sorted(r[1][0] for r in nested) == [3.0, 8.0]
    assert pooling.mean_pool(df.limit(0), "x", "v").collect() == []


def test_no_element_becomes_a_row(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "g int, v array<float>")
    plan = pooling.mean_pool(df, "g", "v")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("MapInArrow") == 2
