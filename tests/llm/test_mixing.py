"""Poisson replication: the inverse against direct sums, rates, nulls and ties."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from vecloom.llm import mixing


def copies(rate, u):
    k, log, total = 0, -rate, math.exp(-rate)
    while total < u:
        k += 1
        log += math.log(rate) - math.log(k)
        total += math.exp(log)
    return k


def number(*parts):
    return (int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:13], 16) + 0.5) / 16**13


def corpus(spark, n=300):
    rows = [(i, f"t{i}", "big" if i % 3 else f"s{i % 5}", i) for i in range(n)] + [(None, "x", None, 0), (None, "y", None, 0), (7, "t7", "big", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_copies int")


@pytest.mark.parametrize("options", [{}, {"epochs": 3.0}, {"weights": {"big": 1.0, "s0": 3.0, None: 0.5}}, {"weights": {"s1": 1.0}, "epochs": 40.0}])
def test_counts_equal_direct_inversion(spark, options):
    docs = corpus(spark)
    rates = {r.source: r.rate for r in mixing.source_rates(docs, **options).collect()}
    want = {}
    for r in docs.collect():
        identity = r.doc_id if r.doc_id is not None else hashlib.md5(r.text.encode()).hexdigest()
        n = copies(rates[r.source], number(mixing.SEED, identity)) if rates[r.source] > 0 else 0
        if n:
            want[r.doc_id, r.text] = want.get((r.doc_id, r.text), 0) + n
    mixed = mixing.mix_sources(docs, **options)
    got = {}
    for r in mixed.collect():
        assert 1 <= r.copy <= r.n_copies
        got[r.doc_id, r.text] = got.get((r.doc_id, r.text), 0) + 1
    assert got == want


def test_mean_follows_the_target_and_large_rates_hold(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("source"))
    assert abs(mixing.mix_sources(docs, epochs=2.0).count() - 4000) < 5 * math.sqrt(4000)
    assert abs(mixing.mix_sources(docs.limit(3), epochs=1500.0).count() - 4500) < 6 * math.sqrt(4500)


def test_order_is_random_and_repeatable(spark):
    docs = corpus(spark)
    first = [(r.doc_id, r.copy) for r in mixing.mix_sources(docs, partitions=2).collect()]
    assert first == [(r.doc_id, r.copy) for r in mixing.mix_sources(docs.repartition(5), partitions=2).collect()]
    assert first != sorted(first, key=str)


def test_empty_table(spark):
    assert mixing.mix_sources(corpus(spark).where("false")).count() == 0
