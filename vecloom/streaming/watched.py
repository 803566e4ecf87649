"""Upserts from a stream that encode a row only when a watched column has changed.

Structured Streaming keeps a small entry per key: a digest of the watched columns, the order
of the newest change, and the numbers of the row's version and of the version that made its
vector.  Entries lie in a fixed number of drawers by the key's hash, so that a batch of many
keys is a bounded number of calls, and a batch of few opens few drawers.  A change whose digest is the same brings new values but no new vector, and points to
the one there is, so a price that changes every minute encodes nothing.  A change that is
older than the newest one seen writes nothing.  State is checkpointed by Spark, so a batch
that runs again gives the same rows.

``mode`` is that of :func:`vecloom.sources.maintenance.upsert_embeddings`: ``on_change``
encodes new keys and keys whose watched columns differ; ``if_null`` encodes new keys that
bring no vector and leaves the others with the vector they have or bring.

Every micro-batch writes a folder of its own.  :func:`read_watched` gives the current rows
and settles on narrow columns which rows and vectors those are; :func:`compact_watched`
folds the folders.

Before the rows of a key meet its state, each Arrow batch is reduced to the newest change per
key, so that a key with a third of all changes sends few of them.  Rows with a null key
or order are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vecloom.functions.encoders import HASHING, EncoderSpec, embed_encode

# Keys share so many states: a call of the state function for every key took most of a stream's time.
# The number is part of a stream's checkpoint.
_DRAWERS = 1 << 14
# Rows travel through the state operator as text, which keeps every type exact.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def _newest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The newest change of every key in each Arrow batch."""
    for batch in batches:
        if batch.num_rows:
            order = pc.sort_indices(batch, sort_keys=[("key", "ascending"), ("seq", "ascending")])
            rows = batch.take(order)
            key = rows.column("key")
            last = pc.not_equal(key[1:], key[:-1])
            yield rows.filter(pa.concat_arrays([pc.fill_null(last, True), pa.array([True])]))


def _plain(value: Any) -> Any:
    """A value as the state's encoder takes it."""
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value.item() if hasattr(value, "item") else value


def _follow(mode: str):
    def follow(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best: dict[str, tuple] = {}
        for part in parts:
            for row in zip(*(part[c] for c in ("name", "key", "seq", "digest", "brought", "body"))):
                held = best.get(row[0])
                if held is None or row[2] >= held[2]:
                    best[row[0]] = row
        known = dict(state.get[0]) if state.exists else {}
        out = []
        for name, key, seq, digest, brought, body in best.values():
            found = name in known
            before, newest, version, vector = known[name] if found else (None, None, 0, 0)
            if found and _plain(seq) < newest:
                continue
            if mode == "on_change":
                brought, encode = False, not found or digest != before
            else:
                encode = not found and not brought
            version += 1
            vector = version if encode or brought else vector
            known[name] = (digest, _plain(seq), version, vector)
            out.append((key, version, vector, bool(encode), body))
        if out:
            state.update((known,))
            yield pd.DataFrame(out, columns=["key", "version", "vector_version", "encode", "body"])

    return follow


def _name(key: str, kind: T.DataType) -> Column:
    """A key as text, the same for keys that Spark groups together."""
    value = F.col(key) + F.lit(0).cast(kind) if isinstance(kind, T.FloatType | T.DoubleType) else F.col(key)  # no -0.0
    return F.to_json(F.struct(value.alias("key")), _JSON)


def watched_changes(stream: DataFrame, *, key: str, watched: Sequence[str], order_by: str, vec_col: str = "embedding",
                    mode: str = "on_change") -> DataFrame:
    """The changes that count, with ``_version``, ``_vector_version`` and ``_encode``."""
    if mode not in ("on_change", "if_null"):
        raise ValueError("mode must be 'on_change' or 'if_null'")
    fields = {f.name: f.dataType for f in stream.schema.fields}
    body = T.StructType([f for f in stream.schema.fields if f.name != key])
    brings = F.col(vec_col).isNotNull() if vec_col in fields else F.lit(False)
    narrow = stream.filter(F.col(key).isNotNull() & F.col(order_by).isNotNull()).select(
        F.col(key).alias("key"),
        _name(key, fields[key]).alias("name"),
        F.col(order_by).alias("seq"),
        F.sha2(F.to_json(F.struct(*watched), _JSON), 256).alias("digest"),
        brings.alias("brought"),
        F.to_json(F.struct(*[F.col(f.name) for f in body]), _JSON).alias("body"),
    )
    key_type, seq_type = fields[key].simpleString(), fields[order_by].simpleString()
    newest = narrow.mapInArrow(_newest, narrow.schema).withColumn("drawer", F.pmod(F.xxhash64("name"), F.lit(_DRAWERS)))
    followed = newest.groupBy("drawer").applyInPandasWithState(
        _follow(mode),
        f"key {key_type}, version long, vector_version long, encode boolean, body string",
        f"known map<string, struct<digest: string, newest: {seq_type}, version: long, vector_version: long>>",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    values = followed.withColumn("body", F.from_json("body", body, _JSON))
    return values.select(
        F.col("key").alias(key), *[F.col(f"body.`{f.name}`").alias(f.name) for f in body],
        F.col("version").alias("_version"), F.col("vector_version").alias("_vector_version"), F.col("encode").alias("_encode"),
    )


def stream_upsert_watched(stream: DataFrame, path: str, checkpoint: str, *, key: str, watched: Sequence[str], text, order_by: str,
                          spec: EncoderSpec = HASHING, vec_col: str = "embedding", mode: str = "on_change",
                          once: bool = False) -> StreamingQuery:
    """Insert or update rows by key from a stream, encoding only what the watched columns ask for."""
    text = F.col(text) if isinstance(text, str) else text
    brings = vec_col in stream.columns and mode == "if_null"

    def stamped(rows: DataFrame, name: str, value: Any) -> Any:
        own = F.col(name) if name in rows.columns and brings else F.lit(None)
        return F.when(F.col("_encode"), F.lit(value)).when(F.col("_own"), own)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("_own", F.col(vec_col).isNotNull() & F.lit(brings) if vec_col in batch.columns else F.lit(False))
        fresh = embed_encode(F.when(F.col("_encode"), text), spec)
        vector = F.when(F.col("_own"), F.col(vec_col)).otherwise(fresh) if brings else fresh
        rows = rows.withColumns({vec_col: vector, "model": stamped(rows, "model", spec.name), "dim": stamped(rows, "dim", spec.dim)})
        rows = rows.withColumn("_made", F.col("_encode") | F.col("_own")).drop("_encode", "_own")
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    changes = watched_changes(stream, key=key, watched=watched, order_by=order_by, vec_col=vec_col, mode=mode)
    writer = changes.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _current(spark: SparkSession, path: str, key: str, vec_col: str) -> DataFrame:
    versions = spark.read.parquet(path).drop("batch_id")
    newest = versions.groupBy(key).agg(F.max("_version").alias("_version"))
    vectors = versions.filter("_made").select(key, "_vector_version", vec_col, "model", "dim")
    rows = versions.drop(vec_col, "model", "dim", "_made").join(newest, [key, "_version"], "left_semi")
    return rows.join(vectors, [key, "_vector_version"], "left")


def read_watched(spark: SparkSession, path: str, key: str, vec_col: str = "embedding") -> DataFrame:
    """Current rows with their vectors; ``vector_version`` is the version of the row that made the vector."""
    return _current(spark, path, key, vec_col).drop("_version").withColumnRenamed("_vector_version", "vector_version")


def compact_watched(spark: SparkSession, path: str, target: str, key: str, vec_col: str = "embedding") -> None:
    """Write the current rows as the oldest batch of a table at ``target``, to which the stream may go on writing."""
    rows = _current(spark, path, key, vec_col).withColumn("_made", F.lit(True))
    rows.write.mode("overwrite").parquet(f"{target}/batch_id=-1")
