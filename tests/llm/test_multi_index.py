"""Multi-index hashing: probing against all codes, search against brute force, recall, edge cases."""

import numpy as np
import pytest
from compare import SF_DIR

from vecloom.llm import multi_index as mih
from vecloom.llm.queries import QUERIES


def brute(rows, queries, k):
    good = {i: np.array(v, dtype=np.float64) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q in queries:
        if q in good:
            ranked = sorted(((-float(good[q] @ v), i) for i, v in good.items() if i != q))
            out[q] = [(i, -s) for s, i in ranked[:k]]
    return out


@pytest.mark.parametrize("radius", [0, 5, 31, 32, 60])
def test_probing_finds_every_code_within_the_radius(radius):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(500, 10))
    largest = np.linalg.norm(vectors, axis=1).max()
    rotation = mih.learn_rotations(mih.lifted(vectors, largest), 128)
    shard = mih.Shard(np.arange(500), vectors, rotation, largest, radius)
    for code in shard.codes[:20]:
        assert set(shard.probe(code)) == set(np.flatnonzero(mih.hamming(code, shard.codes) <= radius))


def test_equals_brute_force_at_full_radius(spark):
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(90, 5)) * rng.choice([0.5, 1, 3], size=(90, 1))).round(2).tolist()
    vectors += [vectors[0]] * 30 + [None, [0.0] * 5, [float("nan")] * 5, [1.0, None, 0.0, 0.0, 0.0], [1.0, 2.0], []]
    rows = list(enumerate(vectors))
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    expected = brute([(i, v) for i, v in rows if v is None or len(v) == 5], range(0, len(rows), 5), 7)
    for options in ({"radius": mih.BITS}, {"radius": 0, "shard_rows": 1000}, {"radius": mih.BITS, "shard_rows": 16, "query_rows": 4}):
        found = mih.search(frame, frame.where("vec_id % 5 = 0"), k=7, **options).collect()
        got = {}
        for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert got.keys() == expected.keys()
        if options["radius"]:
            for q in got:
                assert [i for i, _ in got[q]] == [i for i, _ in expected[q]]
                assert np.allclose([s for _, s in got[q]], [s for _, s in expected[q]], atol=1e-12)
        assert all(len(v) == 7 for v in got.values())


def test_query_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    expected = brute(rows, [i for i, _ in rows if i % 20 == 0], 20)
    got = {}
    for r in QUERIES["op4_multi_index_hashing"](spark, SF_DIR).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert got.keys() == expected.keys()
    assert np.mean([len(got[q] & {i for i, _ in expected[q]}) / 20 for q in got]) >= 0.9


def test_empty_and_few(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert mih.search(frame, frame).count() == 0
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in mih.search(frame, frame.where("vec_id = 0")).collect()] == [(0, 1, 1, 0.5)]
