"""Reading and writing tables of texts and vectors kept as Parquet."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.functions.vectors import assert_dim


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Scan a Parquet table, with a declared schema where one is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give every core work where a table has fewer partitions than cores.

    A small file is one partition, which leaves a CPU-heavy encoder on one core.
    A table of at least as many partitions as cores comes back as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def register_view(df: DataFrame, name: str, cached: bool = False) -> DataFrame:
    """Name a DataFrame for SQL in this session; cache it where it is reused."""
    if cached:
        df.cache()
    df.createOrReplaceTempView(name)
    return df


def append_rows(rows: DataFrame, path: str) -> None:
    """Add rows to a Parquet table."""
    rows.write.mode("append").parquet(path)


def with_defaults(df: DataFrame, defaults: Mapping[str, Column | object], created_at: str | None = "created_at") -> DataFrame:
    """Fill missing columns and NULLs the way column defaults do on insert.

    ``created_at`` names the column that gets the current time (``None``: none).
    """
    filled = dict(defaults)
    if created_at is not None:
        filled[created_at] = F.current_timestamp()
    columns = {}
    for name, value in filled.items():
        value = value if isinstance(value, Column) else F.lit(value)
        columns[name] = F.coalesce(F.col(name), value) if name in df.columns else value
    return df.withColumns(columns)


def add_vector_column(df: DataFrame, source: str, target: str, dim: int, strict: bool = True) -> DataFrame:
    """Copy an array column into one whose dimension is checked."""
    return df.withColumn(target, assert_dim(F.col(source).cast("array<float>"), dim, strict))


def metadata_equals(column: str, path: str, value) -> Column:
    """Filter on a key of a JSON text column."""
    return F.get_json_object(F.col(column), path) == str(value)


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete versions: their folders hold the mark that a finished write leaves."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    found = []
    for entry in files.listStatus(path):
        name = entry.getPath().getName()
        if re.fullmatch(r"version=\d+", name) and files.exists(spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")):
            found.append(int(name.removeprefix("version=")))
    return found


def publish(spark: SparkSession, written: str, target: str) -> None:
    """Give a finished folder its name, or fail where another writer has taken that name.

    One rename, which file systems with directories do at once and refuse if the target exists.
    """
    fs = spark._jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(fs.Path(target).toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        context.rename(fs.Path(written), fs.Path(target), plain)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception):
            raise FileExistsError(f"{target} was written by another writer") from error
        raise


def replace_table(df: DataFrame, root: str, expected: int | None = None) -> int:
    """Write a whole new version of a table and return its number.

    The new version may be computed from the current one: readers move to it
    only when it is complete, and a failed write leaves the old one in place.
    A version without rows counts like any other.  Writers do not disturb each
    other: rows are written beside the versions, and the folder gets the next free
    number.  With ``expected``, the version that the rows were computed from, a
    writer that comes after another one is refused.
    """
    spark, written = df.sparkSession, f"{root}/_writing-{uuid.uuid4().hex}"
    df.write.parquet(written)
    while True:
        latest = max(_versions(spark, root), default=-1)
        if expected is not None and latest != expected:
            raise FileExistsError(f"version {latest} came after version {expected} of {root}")
        try:
            publish(spark, written, f"{root}/version={latest + 1}")
            return latest + 1
        except FileExistsError:
            if latest == max(_versions(spark, root), default=-1):
                _move_remains(spark, root, latest + 1)


def _move_remains(spark: SparkSession, root: str, version: int) -> None:
    """Move aside a folder of that number which no write has finished."""
    target, aside = f"{root}/version={version}", f"{root}/_remains-{uuid.uuid4().hex}"
    publish(spark, target, aside)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{aside}/_SUCCESS")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        publish(spark, aside, target)  # another writer had finished it in between


def current_table(spark: SparkSession, root: str) -> DataFrame:
    """The latest complete version of a table written by :func:`replace_table`."""
    versions = _versions(spark, root)
    if not versions:
        raise FileNotFoundError(f"no complete version under {root}")
    return spark.read.parquet(f"{root}/version={max(versions)}")
