"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Characters of text that one slice of an Arrow batch may hold, and how far a
# single longer text may go beyond it (it is never cut).
SLICE_CHARS = 8_000_000


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with a bounded amount of text, at least one row each."""
    texts = batch.column(batch.schema.get_field_index(column))
    sizes = texts.nbytes
    if sizes <= limit or batch.num_rows <= 1:
        if batch.num_rows:
            yield batch
        return
    half = batch.num_rows // 2
    yield from text_slices(batch.slice(0, half), column, limit)
    yield from text_slices(batch.slice(half), column, limit)


def rows_per_batch(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))


def whole_text(column: str = "text"):
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def blocks_for(rows: int, per_block: int) -> int:
    return max(1, math.ceil(rows / per_block))


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns of these names, so that an operator's own can take their place."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, for an operator's own use."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
