"""Upserts of a stored table: results, files that stay, versions, writers that meet."""

import os

import pytest
from pyspark.sql import functions as F

from vecloom.functions import EncoderSpec
from vecloom.sources import bucketed, maintenance, tables

SPEC = EncoderSpec(name="eight", dim=8)


def rows_of(spark, ids, text="first words"):
    rows = [(i, f"{text} {i}", float(i)) for i in ids]
    return maintenance.encode_documents(spark.createDataFrame(rows, "id long, text string, price double"), "text", SPEC)


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{root}/data") for f in names if f.endswith(".parquet")}


def plain(df):
    return sorted((r["id"], r["text"], r["price"], tuple(r["embedding"])) for r in df.collect())


def used(spark, root):
    """The files that the latest version reads."""
    return {p.removeprefix("file://") for p in bucketed.read(spark, root).inputFiles()}


def change(spark, root, rows):
    changes = spark.createDataFrame(rows, "id long, text string, price double")
    return bucketed.upsert(changes, root, ["text"], "text", SPEC), changes


def test_upsert_equals_the_whole_table_form_and_keeps_other_files(spark, tmp_path):
    root = f"{tmp_path}/table"
    first = rows_of(spark, range(200))
    bucketed.create(first, root, "id", buckets=16)
    before = used(spark, root)
    version, changes = change(spark, root, [(7, "new text", 1.0), (8, "first words 8", 99.0), (500, "added", 5.0)])
    assert version == 1
    expected = maintenance.upsert_embeddings(first, changes, "id", ["text"], "text", SPEC)
    assert plain(bucketed.read(spark, root)) == plain(expected)
    after = used(spark, root)
    # Rows 7 and 8 meet one group each, row 500 lies beyond the keys of its bucket.
    assert 1 <= len(before - after) <= 2 and len(after - before) <= 3
    assert all(os.path.exists(f) for f in before)
    assert plain(bucketed.read(spark, root, 0)) == plain(first)


def test_higher_keys_are_appended_without_reading(spark, tmp_path):
    root = f"{tmp_path}/table"
    bucketed.create(rows_of(spark, range(100)), root, "id", buckets=4)
    before = used(spark, root)
    later = spark.createDataFrame([(i,) for i in range(1000, 1050)], "id long")
    assert bucketed.groups_met(later, root) == []
    change(spark, root, [(i, f"later {i}", 0.0) for i in range(1000, 1050)])
    assert before < used(spark, root)
    assert bucketed.read(spark, root).count() == 150
    assert bucketed.compact(spark, root, most_groups=1) == 2
    groups = bucketed.manifest(spark, root)[1].collect()
    assert len(groups) == 4 and sum(g["n"] for g in groups) == 150
    assert bucketed.read(spark, root).count() == 150 and bucketed.compact(spark, root, most_groups=1) == 2


def test_lookup_reads_the_groups_of_its_keys(spark, tmp_path):
    root = f"{tmp_path}/table"
    bucketed.create(rows_of(spark, range(100)), root, "id", buckets=32)
    found = bucketed.lookup(spark.createDataFrame([(5,), (5,), (9999,)], "id long"), root)
    assert [r["id"] for r in found.collect()] == [5] and len(found.inputFiles()) == 1


def test_unchanged_watched_columns_keep_their_vector(spark, tmp_path):
    root = f"{tmp_path}/table"
    first = rows_of(spark, range(10)).withColumn("embedding", F.array_repeat(F.lit(0.5).cast("float"), 8))
    bucketed.create(first, root, "id", buckets=2)
    change(spark, root, [(3, "first words 3", 42.0), (4, "other", 4.0)])
    vectors = {r["id"]: (r["price"], list(r["embedding"])) for r in bucketed.read(spark, root).collect()}
    assert vectors[3] == (42.0, [0.5] * 8) and vectors[4][1] != [0.5] * 8 and vectors[5] == (5.0, [0.5] * 8)


def test_the_second_of_two_writers_is_refused(spark, tmp_path):
    root = f"{tmp_path}/table"
    bucketed.create(rows_of(spark, range(20)), root, "id", buckets=2)
    layout, (version, groups) = bucketed.layout_of(spark, root), bucketed.manifest(spark, root)
    change(spark, root, [(1, "won", 1.0)])
    with pytest.raises(FileExistsError):
        bucketed._replace(rows_of(spark, [1], "lost"), [], groups, root, layout, version)
    assert {r["text"] for r in bucketed.read(spark, root).filter("id = 1").collect()} == {"won"}


def test_empty_tables_and_changes(spark, tmp_path):
    root = f"{tmp_path}/table"
    bucketed.create(rows_of(spark, [0]).filter("id > 5"), root, "id", buckets=3)
    assert bucketed.read(spark, root).collect() == []
    change(spark, root, [(1, "one", 1.0)])
    assert bucketed.upsert(spark.createDataFrame([], "id long, text string, price double"), root, ["text"], "text", SPEC) == 2
    assert [r["id"] for r in bucketed.read(spark, root).collect()] == [1]
    with pytest.raises(FileNotFoundError):
        bucketed.manifest(spark, f"{tmp_path}/none")


def test_whole_table_writers_take_numbers_of_their_own(spark, tmp_path):
    root = f"{tmp_path}/versions"
    assert tables.replace_table(spark.range(3), root) == 0
    assert tables.replace_table(spark.range(4), root, expected=0) == 1
    with pytest.raises(FileExistsError):
        tables.replace_table(spark.range(5), root, expected=0)
    assert tables.replace_table(spark.range(6), root) == 2
    assert tables.current_table(spark, root).count() == 6 and spark.read.parquet(f"{root}/version=1").count() == 4
    # A number that another writer took between the look and the rename is never written over.
    spark.range(1).write.parquet(f"{root}/_late")
    with pytest.raises(FileExistsError):
        tables.publish(spark, f"{root}/_late", f"{root}/version=2")
    assert tables.current_table(spark, root).count() == 6
