"""A stored table whose upserts rewrite only the files that a changed key may lie in.

Rows are dealt to a fixed number of buckets by a hash of their key.  What one batch writes
into a bucket is a *group* of files, and the manifest has one row per group: bucket, data
version, rows, smallest and largest key.  A batch reads and writes anew the groups of its
buckets whose key range holds one of its keys; the others keep their files.  So the cost of a
batch follows the keys it brings, and rows with ever higher keys are appended without reading
anything.  :func:`compact` folds buckets that have gathered many groups.

    root/data/version=N/bucket=B/...    rows, sorted by key
    root/manifest/version=N/...         one row per group
    root/layout/...                     key, buckets and schema, written once

A version exists when its manifest does, which one rename brings into place: readers see a
batch whole or not at all, a failed batch leaves no trace but unread files, and of two writers
that started from one version the second is refused (run it again).  Old files are never
changed; keep them for readers of older versions, or clear data versions that no kept manifest names.

Choose ``buckets`` so that a bucket of the full table fits a task.  Keys are not NULL and name
one row on either side, see :func:`vecloom.sources.maintenance.latest_changes`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.functions.encoders import HASHING, EncoderSpec
from vecloom.sources.maintenance import upsert_embeddings
from vecloom.sources.scratch import materialize, small_copy
from vecloom.sources.tables import _versions, publish

BUCKETS = 64
_GROUP = "bucket int, version long, n long, low {key}, high {key}"


@dataclass(frozen=True)
class Layout:
    """What is fixed for the life of a table."""

    key: str
    buckets: int
    schema: T.StructType

    @property
    def key_type(self) -> str:
        return self.schema[self.key].dataType.simpleString()

    @property
    def groups(self) -> str:
        return _GROUP.format(key=self.key_type)


def _bucket(layout: Layout):
    return F.pmod(F.xxhash64(F.col(layout.key)), F.lit(layout.buckets)).cast("int")


def layout_of(spark: SparkSession, root: str) -> Layout:
    stored = spark.read.schema("key string, buckets int, schema string").json(f"{root}/layout").first()
    return Layout(stored["key"], stored["buckets"], T.StructType.fromJson(json.loads(stored["schema"])))


def manifest(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, DataFrame]:
    """The number of a version (default: the latest) and its groups."""
    number = max(_versions(spark, f"{root}/manifest"), default=None) if version is None else version
    if number is None:
        raise FileNotFoundError(f"no complete version under {root}")
    return number, spark.read.schema(layout_of(spark, root).groups).parquet(f"{root}/manifest/version={number}")


def _rows_of(spark: SparkSession, root: str, layout: Layout, groups: Sequence[Row]) -> DataFrame:
    """The rows of some groups; the files of others are not listed."""
    if not groups:
        return spark.createDataFrame([], layout.schema)
    paths = [f"{root}/data/version={g['version']}/bucket={g['bucket']}" for g in groups]
    return spark.read.schema(layout.schema).parquet(*paths)


def _write(rows: DataFrame, root: str, layout: Layout, version: int) -> tuple[int, DataFrame]:
    """Write rows as the groups of a new data version; returns its number and its manifest rows."""
    spark = rows.sparkSession
    # Numbers that two writers take at once must differ: the random low bits see to that.
    number = (version << 40) | (uuid.uuid4().int & ((1 << 40) - 1))
    path = f"{root}/data/version={number}"
    dealt = rows.withColumn("_bucket", _bucket(layout)).repartition(layout.buckets, "_bucket").sortWithinPartitions("_bucket", layout.key)
    dealt.withColumnRenamed("_bucket", "bucket").write.partitionBy("bucket").parquet(path)
    written = spark.read.schema(T.StructType([layout.schema[layout.key], T.StructField("bucket", T.IntegerType())])).parquet(path)
    key = F.col(layout.key)
    return number, written.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).select(
        "bucket", F.lit(number).cast("long").alias("version"), "n", "low", "high")


def _commit(groups: DataFrame, root: str, version: int) -> int:
    spark, written = groups.sparkSession, f"{root}/manifest/_writing-{uuid.uuid4().hex}"
    groups.coalesce(1).write.parquet(written)
    publish(spark, written, f"{root}/manifest/version={version}")
    return version


def create(rows: DataFrame, root: str, key: str, buckets: int = BUCKETS) -> int:
    """Write the first version of a table."""
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    if "bucket" in rows.columns:
        raise ValueError("the table may not have a column named bucket")
    spark, layout = rows.sparkSession, Layout(key, buckets, rows.schema)
    fixed = spark.createDataFrame([(key, buckets, rows.schema.json())], "key string, buckets int, schema string")
    fixed.coalesce(1).write.json(f"{root}/layout")  # refused where there is a table
    return _commit(_write(rows, root, layout, 0)[1], root, 0)


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """All rows of the latest or a given version."""
    groups = manifest(spark, root, version)[1].collect()  # a row per group, not per row
    return _rows_of(spark, root, layout_of(spark, root), groups)


def groups_met(keys: DataFrame, root: str, version: int | None = None) -> list[Row]:
    """The groups whose key range holds one of the keys, in the keys' own buckets."""
    spark = keys.sparkSession
    layout, (_, groups) = layout_of(spark, root), manifest(spark, root, version)
    groups = small_copy(groups) or groups
    asked = keys.select(F.col(layout.key), _bucket(layout).alias("bucket"))
    met = asked.join(groups, "bucket").filter(F.col(layout.key).between(F.col("low"), F.col("high")))
    return met.select("bucket", "version", "n", "low", "high").distinct().collect()


def lookup(keys: DataFrame, root: str) -> DataFrame:
    """The rows of given keys, read from the groups that may hold them."""
    spark, layout = keys.sparkSession, layout_of(keys.sparkSession, root)
    rows = _rows_of(spark, root, layout, groups_met(keys, root))
    return rows.join(keys.select(layout.key).distinct(), layout.key, "left_semi").select(*layout.schema.names)


def upsert(changes: DataFrame, root: str, watched: Sequence[str], text, spec: EncoderSpec = HASHING, mode: str = "on_change",
           vec_col: str = "embedding") -> int:
    """Insert or update rows by key as :func:`upsert_embeddings` does, in the files they meet; returns the new version."""
    spark = changes.sparkSession
    layout, (version, groups) = layout_of(spark, root), manifest(spark, root)
    changes = materialize(changes, "changes")
    met = groups_met(changes, root, version)
    merged = upsert_embeddings(_rows_of(spark, root, layout, met), changes, layout.key, watched, text, spec, mode, vec_col)
    return _replace(merged.select(*layout.schema.names), met, groups, root, layout, version)


def _replace(rows: DataFrame, met: Sequence[Row], groups: DataFrame, root: str, layout: Layout, version: int) -> int:
    spark = rows.sparkSession
    added = _write(rows, root, layout, version + 1)[1]
    gone = spark.createDataFrame([(g["bucket"], g["version"]) for g in met], "bucket int, version long")
    kept = groups.join(F.broadcast(gone), ["bucket", "version"], "left_anti")
    return _commit(kept.select("bucket", "version", "n", "low", "high").unionByName(added), root, version + 1)


def compact(spark: SparkSession, root: str, most_groups: int = 4) -> int:
    """Fold every bucket with more than ``most_groups`` groups into one; returns the version that holds the result."""
    layout, (version, groups) = layout_of(spark, root), manifest(spark, root)
    many = groups.groupBy("bucket").count().filter(F.col("count") > most_groups).select("bucket")
    met = groups.join(many, "bucket").collect()
    if not met:
        return version
    return _replace(_rows_of(spark, root, layout, met), met, groups, root, layout, version)
