"""Streams that encode by watched columns: against the batch form, with late and repeated changes."""

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

import vecloom.functions as V
from vecloom.sources import maintenance
from vecloom.streaming import watched

SPEC = V.EncoderSpec(name="small", dim=8)
MARK = [0.5] * 8
SCHEMA = "id long, text string, price double, at timestamp, embedding array<float>, model string, dim int"


def when(day):
    return datetime.datetime(2024, 1, day, 3, 4, 5, 678_901)


def run(spark, root, rows, mode, table="table", checkpoint="checkpoint"):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
    watched.stream_upsert_watched(stream, f"{root}/{table}", f"{root}/{checkpoint}", key="id", watched=["text"], text="text",
                                  order_by="at", spec=SPEC, mode=mode, once=True).awaitTermination()
    return watched.read_watched(spark, f"{root}/{table}", "id")


def change(i, text, price, day, vector=None):
    return (i, text, price, when(day), vector, "given" if vector else None, 8 if vector else None)


BIG = 2**62 + 1
FIRST = [change(1, "a", 1.0, 2), change(2, "b", 0.1, 2), change(BIG, None, None, 2), change(4, "d", 4.0, 2, MARK), change(None, "x", 1.0, 2)]
SECOND = [
    change(1, "a", 9.5, 3),  # only the price
    change(2, "b2", 2.0, 3), change(2, "draft", 2.0, 1),  # an edit, and a late change beside it
    change(BIG, "c", 3.0, 3),
    change(4, "d4", 4.0, 4, None), change(5, "e", 5.0, 4, MARK), change(6, "f", 6.0, 4),
]
LATE = [change(1, "late", 0.0, 1), change(6, "f", 6.5, 5)]


@pytest.mark.parametrize("mode", ["on_change", "if_null"])
def test_equals_the_batch_form(spark, tmp_path, mode):
    empty = spark.createDataFrame([], SCHEMA)
    expected, keep = empty, []
    for rows in (FIRST, SECOND, LATE):
        got = run(spark, tmp_path, rows, mode)
        changes = spark.createDataFrame([r for r in rows if r[0] is not None], SCHEMA)
        held = {r["id"]: r["at"] for r in expected.collect()}
        changes = maintenance.latest_changes(changes, "id", "at")
        keep = [tuple(r) for r in changes.collect() if r["at"] >= held.get(r["id"], when(1))]
        fresh = spark.createDataFrame(keep, changes.schema)
        if mode == "on_change":
            fresh = fresh.drop("embedding", "model", "dim")
        merged = maintenance.upsert_embeddings(expected, fresh, "id", ["text"], "text", SPEC, mode).collect()
        expected = spark.createDataFrame([tuple(r) for r in merged], SCHEMA)
        columns = ["id", "text", "price", "at", "embedding", "model", "dim"]
        rows_of = lambda df: sorted(map(tuple, df.select(*columns).collect()), key=lambda r: r[0])
        assert rows_of(got) == rows_of(expected)


def test_a_price_encodes_nothing_and_compaction_goes_on(spark, tmp_path):
    run(spark, tmp_path, FIRST, "on_change")
    now = run(spark, tmp_path, SECOND, "on_change")
    made = {r["id"]: r["vector_version"] for r in now.collect()}
    assert made == {1: 1, 2: 2, BIG: 2, 4: 2, 5: 1, 6: 1}
    second = spark.read.parquet(f"{tmp_path}/table").filter("batch_id = 1").select("id", "_made", "embedding").collect()
    assert {r["id"]: (r["_made"], r["embedding"] is None) for r in second}[1] == (False, True)
    before = sorted(map(tuple, now.collect()))
    watched.compact_watched(spark, f"{tmp_path}/table", f"{tmp_path}/compacted", "id")
    assert sorted(map(tuple, watched.read_watched(spark, f"{tmp_path}/compacted", "id").collect())) == before
    after = {r["id"]: r for r in run(spark, tmp_path, LATE, "on_change", table="compacted").collect()}
    assert after[1]["text"] == "a" and after[6]["price"] == 6.5 and after[6]["vector_version"] == 1
    assert after[6]["embedding"] == {r["id"]: r for r in now.collect()}[6]["embedding"]


def test_many_changes_of_one_key(spark, tmp_path):
    rows = [change(1 if i % 3 else i, f"t{i}", float(i), 2 + i % 20) for i in range(600)]
    got = {r["id"]: r for r in run(spark, tmp_path, rows, "on_change").collect()}
    assert len(got) == 201 and got[1]["at"] == when(21) and got[1]["vector_version"] == 1


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError):
        watched.watched_changes(spark.createDataFrame([], SCHEMA).withColumn("x", F.lit(1)), key="id", watched=["text"], order_by="at", mode="no")


def test_calls_of_the_state_function_are_bounded(spark, tmp_path, monkeypatch):
    """Keys share states: 3,000 keys are no more calls than there are drawers."""
    monkeypatch.setattr(watched, "_DRAWERS", 8)
    calls = spark.sparkContext.accumulator(0)
    follow = watched._follow

    def counted(mode):
        inner = follow(mode)

        def called(key, parts, state):
            calls.add(1)
            yield from inner(key, parts, state)

        return called

    monkeypatch.setattr(watched, "_follow", counted)
    got = run(spark, tmp_path, [change(i, f"t{i}", 1.0, 2) for i in range(3_000)], "on_change")
    assert got.count() == 3_000 and 0 < calls.value <= 8
    again = run(spark, tmp_path, [change(i, f"t{i}" if i % 2 else "new", 2.0, 3) for i in range(3_000)], "on_change")
    assert again.filter("vector_version = 2").count() == 1_500 and again.filter("price = 2").count() == 3_000


@pytest.mark.parametrize("kind, keys", [("double", [0.5, -2.0, 0.0]), ("timestamp", [when(1), when(2)]), ("decimal(20,3)", [decimal.Decimal("1.5"), decimal.Decimal("-2")]),
                                        ("string", ["a", 'b"\n']), ("date", [datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)])])
def test_keys_of_any_type(spark, tmp_path, kind, keys):
    for step, text in enumerate(("a", "b")):
        rows = spark.createDataFrame([(k, text, step) for k in keys], f"id {kind}, text string, seq int")
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
        watched.stream_upsert_watched(stream, f"{tmp_path}/table", f"{tmp_path}/checkpoint", key="id", watched=["text"], text="text",
                                      order_by="seq", spec=SPEC, once=True).awaitTermination()
    got = watched.read_watched(spark, f"{tmp_path}/table", "id").collect()
    assert sorted(str(r["id"]) for r in got) == sorted(str(r["id"]) for r in rows.select("id").collect())
    assert {(r["text"], r["vector_version"]) for r in got} == {("b", 2)}
