"""Cut long texts into overlapping character windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Windows per intermediate segment: bounds the characters skipped to reach one.
_SEGMENT = 64


def _check(size: int, overlap: int) -> int:
    if size < 1:
        raise ValueError("chunk size must be at least 1")
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than the chunk size")
    return size - overlap


def chunk_text(df: DataFrame, content_col: str = "content", size: int = 500, overlap: int = 50,
               index_col: str = "chunk_index", chunk_col: str = "chunk") -> DataFrame:
    """One row per window of ``size`` characters, every ``size - overlap``.

    Windows start at character 1 and go on while the start is inside the text,
    so the last one may lie wholly inside the overlap.  Empty and NULL texts
    give no rows.  The other columns are kept; the text itself is dropped.

    Finding a character position in UTF-8 walks the text from its start, so a
    text is first cut into segments of 64 windows and those into windows: a text
    of n windows costs n/64 walks over it instead of n.
    """
    step = _check(size, overlap)
    kept = [F.col(c) for c in df.columns if c != content_col]
    content = F.col(content_col)
    chars = F.length(content)
    # Windows of a text; the guard keeps the sequence bounds in order.
    windows = F.when(chars >= 1, F.floor((chars - 1) / step).cast("int") + 1).otherwise(F.lit(0))
    segments = F.when(windows >= 1, F.sequence(F.lit(0), windows - 1, F.lit(_SEGMENT)))
    cut = df.withColumn("_n", windows).select("*", F.explode(segments).alias("_first"))
    span = (_SEGMENT - 1) * step + size
    cut = cut.select(
        *kept, "_n", "_first", F.substring(content, F.col("_first") * step + 1, F.lit(span)).alias("_segment")
    )
    inside = F.sequence(F.lit(0), F.least(F.lit(_SEGMENT), F.col("_n") - F.col("_first")) - 1)
    return cut.select("*", F.explode(inside).alias("_i")).select(
        *kept,
        (F.col("_first") + F.col("_i")).alias(index_col),
        F.substring("_segment", F.col("_i") * step + 1, F.lit(size)).alias(chunk_col),
    )


def _metadata(kind: str, parent: Column | None = None) -> Column:
    fields = [F.lit(kind).alias("type")]
    if parent is not None:
        fields.append(parent.alias("parent_id"))
    return F.to_json(F.struct(*fields))


def chunk_documents(docs: DataFrame, *, id_col: str = "id", title_col: str = "title", content_col: str = "content",
                    source_col: str = "source", size: int = 500, overlap: int = 50) -> tuple[DataFrame, DataFrame]:
    """Parent rows and chunk rows of documents, both without embeddings.

    A chunk is identified by ``(parent_id, chunk_index)`` and its ``id`` is that
    pair as text, so ids need no sequence and a rerun gives the same ones.
    """
    base = docs.select(
        F.col(id_col).alias("parent_id"),
        F.col(title_col).alias("title"),
        F.col(content_col).alias("content"),
        F.col(source_col).alias("source"),
    )
    parents = base.select(
        F.col("parent_id").alias("id"),
        "title",
        "content",
        "source",
        F.lit(0).alias("chunk_index"),
        F.lit(None).cast(base.schema["parent_id"].dataType).alias("parent_id"),
        _metadata("parent").alias("metadata"),
    )
    chunks = chunk_text(base, "content", size, overlap, chunk_col="content").select(
        F.concat_ws("#", F.col("parent_id").cast("string"), F.col("chunk_index").cast("string")).alias("id"),
        "title",
        "content",
        "source",
        "chunk_index",
        "parent_id",
        _metadata("chunk", F.col("parent_id")).alias("metadata"),
    )
    return parents, chunks
