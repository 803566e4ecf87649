"""The line index against a direct count: batches that undo each other, columns that clash."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vecloom.llm import line_dedup, mixing, quality, url_filter

LINES = [f"a line that is long enough to be counted as one, number {i:02}" for i in range(8)]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def corpus(n=30):
    return [(i, "\n".join(LINES[j] for j in range(8) if (i * 5 + j * j) % 7 < 3) + f"\nshort {i}") for i in range(n)]


def hot_of(index):
    return {(bytes(r["key"]), r["n_docs"], r["keeper"]) for r in index.hot().collect()}


def counted(rows, least=5):
    held = defaultdict(set)
    for i, text in rows:
        for line in text.split("\n"):
            if line_dedup.line_key(line, 40) is not None:
                held[line_dedup.line_key(line, 40)].add(i)
    return {(bytes(k), len(v), max(v)) for k, v in held.items() if len(v) >= least}


def test_batches_equal_a_direct_count_and_undo_each_other(spark, tmp_path):
    rows = corpus()
    index = line_dedup.LineIndex(spark, f"{tmp_path}/index")
    index.insert(docs_of(spark, rows[:20]))
    assert hot_of(index) == counted(rows[:20])
    index.insert(docs_of(spark, rows[10:]))  # ten of them are held already
    assert hot_of(index) == counted(rows)
    index.delete(docs_of(spark, rows[20:]))
    assert hot_of(index) == counted(rows[:20])


def test_deleting_what_is_not_held_changes_nothing(spark, tmp_path):
    rows = [(i, LINES[0]) for i in range(5)]
    index = line_dedup.LineIndex(spark, f"{tmp_path}/index")
    index.delete(docs_of(spark, rows))
    assert hot_of(index) == set()
    index.insert(docs_of(spark, rows[:4] + rows[:1]))
    index.delete(docs_of(spark, rows[4:]))
    index.insert(docs_of(spark, rows[4:]))
    assert hot_of(index) == counted(rows)
    # A document that was inserted by two rows goes by one.
    index.delete(docs_of(spark, rows[:1]))
    assert hot_of(index) == set()


@pytest.mark.parametrize("names", [("__id", "__keys", "__cut", "n_lines"), ("__source", "__cdf", "__u", "__order", "copy"),
                                   ("__stats", "score"), ("__judged", "host")])
def test_columns_named_like_the_internal_ones(spark, names):
    rows = docs_of(spark, [(i, LINES[0] + f"\nown {i}") for i in range(6)]).withColumns(
        {"source": F.lit("s"), "url": F.concat(F.lit("http://www.example.com/en/"), "doc_id")})
    clash = rows.withColumns({n: F.concat(F.lit(n), "doc_id") for n in names})
    model = quality.RuleEnsemble(0.1, (quality.Rule(((quality.STATS[0], True, 3.0),), 1.0),))
    rules = spark.createDataFrame([("block", "example.com", "/en/")], "action string, host string, path string")
    for operator in (line_dedup.dedup_lines, lambda d: mixing.mix_sources(d, epochs=2.0), lambda d: quality.score_quality(d, model),
                     lambda d: quality.keep_good(d, model), lambda d: url_filter.filter_urls(d, rules)):
        plain, found = operator(rows), operator(clash)
        assert sorted(map(repr, found.select(*plain.columns).collect())) == sorted(map(repr, plain.collect()))
        for n in names:
            if n not in plain.columns and n in found.columns and n.startswith("__"):
                assert {r[0] for r in found.select(F.col(n) == F.concat(F.lit(n), "doc_id")).collect()} == {True}
        assert {n for n in names if n.startswith("__")} <= set(found.columns)
