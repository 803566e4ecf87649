"""Where intermediate tables live.

On a cluster the session names a shared folder in ``spark.checkpoint.dir``; it
is read from there.  With a local master and nothing set (tests), a temporary
folder is used for the life of the process; any other master without the setting
is refused, as each executor would write to its own disk.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"


_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    global _local_root
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"set {_SETTING} to a folder that all executors of {master} share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="vecloom-")
    return _local_root


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path, so that no run reads or overwrites another's files."""
    return f"{scratch_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


# Bounds for rows that are sent to every task.
_SMALL_ROWS, _SMALL_BYTES = 100_000, 32 << 20


def small_copy(df: DataFrame) -> DataFrame | None:
    """A local copy of narrow rows, marked for broadcast, if they are few.

    ``None`` beyond the row or byte bound.  No more than the bounded number of
    rows is fetched to find out, once; give it rows that need no shuffle.
    """
    rows = df.limit(_SMALL_ROWS + 1).toArrow()
    if rows.num_rows > _SMALL_ROWS or rows.nbytes > _SMALL_BYTES:
        return None
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a derived table once and read it back.

    Cuts the lineage where several steps read the same rows, survives lost
    executors, and gives the planner the true size for its next join.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
