"""The corpus pipeline: its stages against brute force on a small fixture, and odd inputs."""

import hashlib
import random
import sys
from pathlib import Path

import public_tokenizers
import tiktoken
from compare import SF_DIR
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline as pipeline  # noqa: E402

from vecloom.llm import bpe, line_dedup, mixing  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    shared = " ".join(word() for _ in range(12)) + "."
    rows = []
    for i in range(40):
        lines = [" ".join(word() for _ in range(15)) + "." for _ in range(4)]
        if i % 4 == 0:
            lines.insert(2, shared)
        rows.append((i, "\n".join(lines), "en", f"s{i % 3}", 0))
    rows += [(100 + i, rows[5][1] + " more" * (i % 2), "en", "s0", 0) for i in range(3)]
    return [(a, b, c, d, len(b)) for a, b, c, d, _ in rows] + [(200, None, None, None, None), (201, "", "en", "s1", 0)]


def test_stages_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, COLUMNS)
    texts = {r[0]: r[1] for r in rows}

    # Lines of at least 40 characters in at least 5 documents stay in the largest id.
    keys = lambda t: [line.strip(" \t\n\v\f\r").lower() for line in (t or "").split("\n")]
    holders = {}
    for i, t in texts.items():
        for key in set(keys(t)):
            holders.setdefault(key, []).append(i)
    gone = {k: max(v) for k, v in holders.items() if len(k) >= 40 and len(v) >= 5}
    want = {}
    for i, t in texts.items():
        lines = (t or "").split("\n")
        kept = [line for line, key in zip(lines, keys(t), strict=True) if gone.get(key, i) == i]
        want[i] = t if len(kept) == len(lines) else "\n".join(kept)
    lined = pipeline.dedup_lines(spark, docs, "")
    assert lined.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in lined.collect()}
    assert {i: t for i, (t, _) in got.items()} == want
    assert all(n == len(t) for t, n in got.values() if t)

    near = pipeline.dedup_near_copies(spark, docs, "")
    assert near.columns == docs.columns
    assert {r.doc_id for r in near.collect()} == set(texts) - {100, 101, 102}

    mixed = pipeline.mix(spark, docs, "")
    assert mixed.columns == docs.columns
    counts = {}
    for r in mixed.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    direct = mixing.mix_sources(docs).groupBy("doc_id").agg(F.max("n_copies").alias("n"), F.count("*").alias("c")).collect()
    assert counts == {r.doc_id: r.n for r in direct} and all(r.n == r.c for r in direct)

    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
    )
    for r in pipeline.tokens(spark, docs, "").collect():
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())


def test_whole_run(spark):
    result = pipeline.run(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert 0 < result.count() <= 2 * docs.count()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    good = labels.where("quality = 1").join(docs, "doc_id")
    kept = pipeline.keep_quality(spark, docs, SF_DIR).join(good.select("doc_id"), "doc_id")
    assert kept.count() >= 0.98 * good.count()


def test_an_index_undoes_its_insertions(spark, tmp_path):
    rows = [(i, "x" * 45 + f"\nline {i}") for i in range(6)] + [(9, None), (None, "x" * 45)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = line_dedup.LineIndex(spark, str(tmp_path / "index"))
    first = docs.where("doc_id < 4 or doc_id is null or doc_id = 9")
    index.insert(first)
    assert index.hot().count() == 0
    index.insert(docs.where("doc_id in (4, 5)"))
    assert [(r.n_docs, r.keeper) for r in index.hot().collect()] == [(6, 5)]
    kept = {r.doc_id: r.text for r in index.rewrite(docs).collect()}
    assert kept[0] == "line 0" and kept[5] == rows[5][1] and kept[9] is None and kept[None] == "x" * 45
    index.delete(docs.where("doc_id in (4, 5)"))
    assert index.hot().count() == 0
    assert {r.text for r in index.rewrite(first).collect()} == {r.text for r in first.collect()}


def test_cuckoo_filter_knows_what_it_holds():
    import numpy as np

    keys = [hashlib.md5(str(i).encode()).digest() for i in range(3000)]
    held = line_dedup.CuckooFilter.build(keys)
    packed = np.frombuffer(b"".join(keys), dtype="V16")
    assert held.contains(packed).all()
    for key in keys[:1500]:
        held.remove(key)
    assert held.contains(packed[1500:]).all()
    assert held.contains(packed[:1500]).mean() < 0.01


def test_empty_tables(spark):
    docs = spark.createDataFrame([], COLUMNS)
    for stage in (pipeline.dedup_lines, pipeline.dedup_near_copies, pipeline.mix, pipeline.tokens):
        assert stage(spark, docs, SF_DIR).count() == 0
    assert pipeline.keep_quality(spark, docs, SF_DIR).count() == 0


def test_many_shards_give_the_result_of_one(spark, tmp_path):
    # 300 lines in six documents each, enough for keys that start with bytes of every kind.
    lines = [f"{hashlib.md5(str(i).encode()).hexdigest()} stands in six documents" for i in range(300)]
    rows = [(i, "\n".join(lines[i // 6 * 10 : i // 6 * 10 + 10]) + f"\nown {i}") for i in range(180)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def result(df):
        return {r.doc_id: (r.text, r.n_dropped) for r in df.collect()}

    want = result(line_dedup.dedup_lines(docs))
    assert sum(n for _, n in want.values()) == 300 * 5
    assert result(line_dedup.dedup_lines(docs, shard_keys=4)) == want

    indexes = [line_dedup.LineIndex(spark, str(tmp_path / f"index{keys}"), shard_keys=keys) for keys in (4, 1 << 18)]
    for change, part in (("insert", docs.where("doc_id % 6 < 5")), ("insert", docs.where("doc_id % 6 = 5")), ("delete", docs.where("doc_id < 90"))):
        many, one = (getattr(index, change)(part) for index in indexes)
        assert result(many.rewrite(docs)) == result(one.rewrite(docs))
    assert indexes[0].shards > 1 and indexes[1].shards == 1
    held = spark.read.parquet(f"{indexes[0].path}/filters/version=3").collect()
    assert sum(r.n for r in held) == indexes[0].hot().count()
    keys = [bytes(r.key) for r in indexes[0].hot().collect()]
    shards = {bytes(r.key): r.shard for r in indexes[0]._sharded(indexes[0].hot()).collect()}
    assert shards == {key: line_dedup.shard_of(key, indexes[0].shards) for key in keys}
