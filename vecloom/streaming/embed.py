"""Embed rows as they arrive, with Structured Streaming.

Encoding is row-local, so no stream in this module needs state, a watermark or a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vecloom.functions.encoders import HASHING, EncoderSpec, embed_encode
from vecloom.sources.maintenance import latest_changes


def stream_embed(stream: DataFrame, text, spec: EncoderSpec = HASHING, vec_col: str = "embedding") -> DataFrame:
    """Add the vector to arriving rows; a vector that a row brings is kept."""
    text = F.col(text) if isinstance(text, str) else text
    if vec_col in stream.columns:
        fresh = embed_encode(F.when(F.col(vec_col).isNull(), text), spec)
        vector = F.coalesce(F.col(vec_col), fresh)
        brought = F.col(vec_col).isNotNull()
    else:
        vector, brought = embed_encode(text, spec), F.lit(False)
    stamps = {}
    for name, value in (("model", F.lit(spec.name)), ("dim", F.lit(spec.dim))):
        stamps[name] = F.when(brought, F.col(name)).otherwise(value) if name in stream.columns else value
    return stream.withColumns({vec_col: vector, **stamps})


def write_appends(embedded: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append an embedded stream to a Parquet table, exactly once."""
    writer = embedded.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def stream_upsert(stream: DataFrame, path: str, checkpoint: str, *, key: str, text, order_by: str,
                  spec: EncoderSpec = HASHING, vec_col: str = "embedding", mode: str = "on_change",
                  once: bool = False) -> StreamingQuery:
    """Insert or update rows by key from a stream of changes.

    Every micro-batch writes its own folder under ``path`` with the last change
    per key and its vector, and never reads or rewrites the rest of the table:
    its cost follows the batch, not the table.  A replayed batch overwrites its
    own folder, so a restart changes nothing.  :func:`read_upserts` gives the
    current rows and :func:`compact` folds the folders into one.  A change that
    arrives late loses to a newer one by ``order_by``, whatever its batch.

    ``on_change`` encodes every change; ``if_null`` keeps a vector (and model)
    that a change brings and encodes the others.  A stream that has to know
    whether a key is new or a column has changed needs state:
    :func:`vecloom.streaming.watched.stream_upsert_watched`.

    Because encoding is deterministic, encoding a change whose text is the same
    as before gives the vector it already had.
    """
    if mode not in ("on_change", "if_null"):
        raise ValueError("mode must be 'on_change' or 'if_null'")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        changes = latest_changes(batch, key, order_by)
        if mode == "on_change":
            changes = changes.drop(vec_col, "model", "dim")
        embedded = stream_embed(changes, text, spec, vec_col)
        embedded.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_upserts(spark: SparkSession, path: str, key: str, order_by: str) -> DataFrame:
    """Current rows of an upserted table: per key the newest by ``order_by``, then by batch.

    Keys are unique inside a batch folder, so the batch number names the row.
    Which one wins is settled on narrow columns before any vector moves.
    """
    versions = spark.read.parquet(path)
    newest = versions.groupBy(key).agg(F.max(F.struct(order_by, "batch_id"))["batch_id"].alias("batch_id"))
    return versions.join(newest, [key, "batch_id"], "left_semi").drop("batch_id")


def compact(spark: SparkSession, path: str, target: str, key: str, order_by: str) -> None:
    """Write the current rows as the oldest batch of a new table at ``target``."""
    read_upserts(spark, path, key, order_by).write.mode("overwrite").parquet(f"{target}/batch_id=-1")
