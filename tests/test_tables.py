import pytest
from pyspark.sql import functions as F

import vecloom.functions as V
from vecloom.sources import maintenance, scratch, status, tables

SPEC = V.EncoderSpec(name="small", dim=8)
MARK = [0.5] * 8


def encoded(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r[0] for r in df.orderBy("i").select(V.embed_encode("text", SPEC)).collect()]


def stored(spark, rows):
    return spark.createDataFrame(rows, "id int, text string, embedding array<float>, model string, dim int")


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_backfill_only_touches_missing(spark):
    a, b = encoded(spark, "a", "b")
    got = by_id(maintenance.backfill_missing(stored(spark, [(1, "a", None, None, None), (2, "b", MARK, "x", 8)]), "text", SPEC))
    assert (got[1]["embedding"], got[1]["model"], got[1]["dim"]) == (a, "small", 8)
    assert (got[2]["embedding"], got[2]["model"]) == (MARK, "x")


def test_reembed_is_null_safe(spark):
    rows = [(1, "a", MARK, "old", 8), (2, "a", MARK, None, 8), (3, "a", MARK, "small", None), (4, "a", None, "small", 8),
            (5, "a", MARK, "small", 8)]
    (a,) = encoded(spark, "a")
    got = by_id(maintenance.reembed_stale(stored(spark, rows), "text", SPEC))
    assert [got[i]["embedding"] for i in range(1, 6)] == [a, a, a, a, MARK]
    assert {(r["model"], r["dim"]) for r in got.values()} == {("small", 8)}


def test_upsert_on_change(spark):
    existing = stored(spark, [(1, "same", MARK, "small", 8), (2, "old", MARK, "small", 8), (3, None, MARK, "small", 8),
                              (4, "kept", MARK, "small", 8), (6, "gone", MARK, "small", 8)])
    changes = spark.createDataFrame([(1, "same"), (2, "new"), (3, None), (5, "added"), (6, None)], "id int, text string")
    new, added = encoded(spark, "new", "added")
    got = by_id(maintenance.upsert_embeddings(existing, changes, "id", ["text"], "text", SPEC))
    assert {i: r["embedding"] for i, r in got.items()} == {1: MARK, 2: new, 3: MARK, 4: MARK, 5: added, 6: None}
    assert got[5]["model"] == "small" and got[2]["text"] == "new"


def test_upsert_if_null(spark):
    mine = [1.0] * 8
    existing = stored(spark, [(1, "old", MARK, "small", 8), (2, "old", MARK, "small", 8)])
    rows = [(1, "new", None), (2, "new", mine), (3, "added", None), (4, "added", mine)]
    changes = spark.createDataFrame(rows, "id int, text string, embedding array<float>")
    (added,) = encoded(spark, "added")
    got = by_id(maintenance.upsert_embeddings(existing, changes, "id", ["text"], "text", SPEC, mode="if_null"))
    assert {i: r["embedding"] for i, r in got.items()} == {1: MARK, 2: mine, 3: added, 4: mine}
    with pytest.raises(ValueError):
        maintenance.upsert_embeddings(existing, changes, "id", ["text"], "text", SPEC, mode="other")


def test_latest_changes(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "c", 3), (1, "b", 2), (2, "z", 1)], "id int, text string, seq int")
    got = {r["id"]: r["text"] for r in maintenance.latest_changes(df, "id", "seq").collect()}
    assert got == {1: "c", 2: "z"}


def test_append_ignore_conflicts(spark):
    existing = spark.createDataFrame([(1, "a")] * 50, "id int, text string")
    new = spark.createDataFrame([(1, "b"), (2, "z"), (2, "c"), (3, "d")], "id int, text string")
    got = {(r["id"], r["text"]) for r in maintenance.append_ignore_conflicts(new, existing, ["id"], "text").collect()}
    assert got == {(2, "c"), (3, "d")}
    assert maintenance.append_ignore_conflicts(new, existing, ["id"]).count() == 2


def test_defaults(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, metadata string")
    got = by_id(tables.with_defaults(df, {"metadata": "{}", "chunk_index": 0}))
    assert (got[1]["metadata"], got[2]["metadata"], got[1]["chunk_index"]) == ("{}", "x", 0)
    assert got[1]["created_at"] is not None
    assert "created_at" not in tables.with_defaults(df, {}, created_at=None).columns


def test_append_and_versions(spark, tmp_path):
    path, root = str(tmp_path / "plain"), str(tmp_path / "versions")
    df = spark.range(3)
    tables.append_rows(df, path)
    tables.append_rows(df, path)
    assert tables.read_table(spark, path, "id long").count() == 6
    assert tables.replace_table(df, root) == 0
    assert tables.replace_table(tables.current_table(spark, root).filter("id > 0"), root) == 1
    assert sorted(r["id"] for r in tables.current_table(spark, root).collect()) == [1, 2]


def test_vector_column_checks_dimension(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "id int, e array<float>")
    lenient = by_id(tables.add_vector_column(df, "e", "v", 2, strict=False))
    assert (lenient[1]["v"], lenient[2]["v"]) == ([1.0, 2.0], None)
    with pytest.raises(Exception, match="expected 2 dimensions, not 1"):
        tables.add_vector_column(df, "e", "v", 2).collect()


def test_metadata_filter(spark):
    df = spark.createDataFrame([(1, '{"type":"chunk","parent_id":7}'), (2, '{"type":"parent"}'), (3, None)], "id int, m string")
    assert [r["id"] for r in df.filter(tables.metadata_equals("m", "$.parent_id", 7)).collect()] == [1]


def test_status_counts_each_fault(spark):
    rows = [(1, MARK, "small"), (2, None, "small"), (3, [0.0] * 8, "small"), (4, [1.0], "old"), (5, [None] * 8, None), (6, [], "small")]
    df = spark.createDataFrame(rows, "id int, embedding array<float>, model string")
    got = {r["component"]: (r["status"], r["details"]) for r in status.embedding_status(df, SPEC).collect()}
    assert got == {
        "embeddings": ("ready", "6 rows"), "model": ("configured", "small"), "dimension": ("configured", "8 dimensions"),
        "missing": ("check", "1 rows"), "null_elements": ("check", "1 rows"), "wrong_dimension": ("check", "2 rows"),
        "zero_vectors": ("check", "1 rows"), "stale_model": ("check", "2 rows"),
    }
    empty = {r["component"]: r["status"] for r in status.embedding_status(df.limit(0), SPEC).collect()}
    assert empty["embeddings"] == "empty" and empty["missing"] == "ok"


def test_scratch_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    paths = {scratch.scratch_path(spark, "x") for _ in range(3)}
    assert len(paths) == 3
    if named:
        assert all(p.startswith(f"{named.rstrip('/')}/x-") for p in paths)


def test_spread_leaves_wide_tables_alone(spark):
    wide, narrow = spark.range(100).repartition(20), spark.range(100).repartition(1)
    assert tables.spread(wide, "id") is wide
    assert "REPARTITION_BY_NUM" in tables.spread(narrow, "id")._jdf.queryExecution().executedPlan().toString()


def test_upsert_does_not_shuffle_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    stored(spark, [(i, "x", MARK, "small", 8) for i in range(20)]).write.parquet(path)
    changes = spark.createDataFrame([(1, "y")], "id int, text string")
    changes.write.parquet(path + "c")
    df = maintenance.upsert_embeddings(spark.read.parquet(path), spark.read.parquet(path + "c"), "id", ["text"], F.col("text"), SPEC)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_an_emptied_table_stays_empty_and_unfinished_versions_do_not_count(spark, tmp_path):
    root = str(tmp_path / "versions")
    tables.replace_table(spark.range(3), root)
    assert tables.replace_table(tables.current_table(spark, root).filter("id < 0"), root) == 1
    assert tables.current_table(spark, root).count() == 0
    spark.range(9).write.parquet(f"{root}/version=2")
    (tmp_path / "versions" / "version=2" / "_SUCCESS").unlink()
    assert tables.current_table(spark, root).count() == 0
    assert tables.replace_table(spark.range(5), root) == 2
    assert tables.current_table(spark, root).count() == 5


def test_null_keys_conflict_with_nothing(spark):
    existing = spark.createDataFrame([(1, "a"), (None, "b")], "id int, text string")
    new = spark.createDataFrame([(None, "x"), (None, "y"), (1, "z"), (2, "w")], "id int, text string")
    got = sorted(r["text"] for r in maintenance.append_ignore_conflicts(new, existing, ["id"]).collect())
    assert got == ["w", "x", "y"]


@pytest.mark.parametrize("few", [True, False])
def test_upsert_keeps_what_the_change_does_not_carry(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(maintenance, "small_copy", lambda df: None)
    schema = "id int, name string, price double, note string, embedding array<float>, model string, dim int"
    rows = [(i, "a", 1.0, "keep me", MARK, SPEC.name, 8) for i in (1, 2, 3)] + [(None, "n", 1.0, "null key", MARK, SPEC.name, 8)]
    existing = spark.createDataFrame(rows, schema)
    changes = spark.createDataFrame([(1, 9.0), (4, 5.0)], "id int, price double")
    got = by_id(maintenance.upsert_embeddings(existing, changes, "id", ["name"], F.concat_ws(" ", "name", "note"), SPEC))
    assert (got[1]["name"], got[1]["price"], got[1]["note"], got[1]["embedding"]) == ("a", 9.0, "keep me", MARK)
    assert got[2]["embedding"] == MARK and got[None]["note"] == "null key" and len(got) == 5
    assert got[4]["note"] is None and got[4]["embedding"] == [0.0] * 8
    renamed = spark.createDataFrame([(1, "b")], "id int, name string")
    got = by_id(maintenance.upsert_embeddings(existing, renamed, "id", ["name"], F.concat_ws(" ", "name", "note"), SPEC))
    want = spark.createDataFrame([("b keep me",)], "t string").select(V.embed_encode("t", SPEC)).first()[0]
    assert got[1]["embedding"] == want and got[1]["price"] == 1.0
