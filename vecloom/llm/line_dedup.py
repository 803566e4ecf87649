"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

A :class:`LineIndex` is a folder of three tables.

* ``refs``: the exact reference-count table, a log of (key, doc_id, +1 or -1) with
  one folder per inserted or deleted batch.  A document holds a line while its sum
  is positive.  After the first batch, an insertion logs only what is not held yet and a
  deletion takes back exactly what is, so deleting a batch undoes its insertion, and
  deleting what was never inserted or inserting twice changes nothing.
* ``hot``: per version, the keys held by at least ``min_docs`` documents and the
  largest doc_id holding each (its keeper).  A batch only recounts the keys it
  touches.
* ``filters``: one cuckoo filter per shard of the key space, with the hot keys.
  Keys that become hot are inserted, keys that cease to be are deleted.

Rewriting documents asks the filters about every line; only lines they may know
meet the exact table in a join, which decides.  Filters are sent to the tasks while
their measured size is below ``max_filter_bytes``; beyond that every line goes to
the join and the result is the same.

A key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z
lower-cased, if it has at least ``min_chars`` code points.  It is carried as its
128-bit xxhash.  Counting is a partial aggregation, so a line found in a third of
all documents costs one row per task.

Defined results: a null text is one empty line (kept as null by :meth:`rewrite`
unless lines are dropped).  Rows with a null id are neither counted nor changed.
Rows that repeat an id are one document.  An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm.common import blocks_for, fresh_name, text_slices, without
from vecloom.sources.scratch import materialize, scratch_path

MIN_CHARS, MIN_DOCS = 40, 5
SHARD_KEYS, MAX_FILTER_BYTES = 1 << 18, 64 << 20
_SPACE = " \t\n\v\f\r"
_SLOTS, _MAX_KICKS = 4, 500


def line_key(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """Digest of the line's key, ``None`` if the key is too short to count."""
    line = line.strip(_SPACE)
    if len(line) < min_chars:
        return None
    return xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass").lower())  # bytes.lower() only maps A-Z


class CuckooFilter:
    """Set of 16-byte keys with deletion: 16-bit fingerprints in two possible buckets of four slots.

    ``keys`` are distinct; the exact table behind it guarantees that only keys that were inserted are removed.
    """

    def __init__(self, table: np.ndarray) -> None:
        self.table = table  # (buckets, slots), buckets a power of two, 0 is free

    @classmethod
    def build(cls, keys: list[bytes]) -> CuckooFilter:
        buckets = 1
        while buckets * _SLOTS * 0.9 < max(1, len(keys)):
            buckets *= 2
        while True:
            made = cls(np.zeros((buckets, _SLOTS), dtype=np.uint16))
            if all(made.insert(k) for k in keys):
                return made
            buckets *= 2

    @classmethod
    def load(cls, blob: bytes) -> CuckooFilter:
        return cls(np.frombuffer(blob, dtype=np.uint16).reshape(-1, _SLOTS).copy())

    def blob(self) -> bytes:
        return self.table.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        halves = keys.view("<u8").reshape(-1, 2)
        print16 = (halves[:, 1] & np.uint64(0xFFFF)).astype(np.uint16)
        print16[print16 == 0] = 1
        first = (halves[:, 0] >> np.uint64(16)) & np.uint64(len(self.table) - 1)
        return print16, first, first ^ self._jump(print16)

    def _jump(self, print16: np.ndarray) -> np.ndarray:
        spread = print16.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(32)) & np.uint64(len(self.table) - 1)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """For an array of ``V16`` keys, whether each may be in the set."""
        print16, first, second = self._places(keys)
        hit = (self.table[first] == print16[:, None]).any(axis=1)
        return hit | (self.table[second] == print16[:, None]).any(axis=1)

    def insert(self, key: bytes) -> bool:
        print16, first, second = (int(x[0]) for x in self._places(np.frombuffer(key, dtype="V16")))
        for at in (first, second):
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = print16
                return True
        at = second
        for kick in range(_MAX_KICKS):
            slot = kick % _SLOTS
            print16, self.table[at, slot] = int(self.table[at, slot]), print16
            at ^= int(self._jump(np.array([print16], dtype=np.uint16))[0])
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = print16
                return True
        return False  # full: a fingerprint is lost, so the caller builds a larger one from the exact table

    def remove(self, key: bytes) -> None:
        print16, first, second = (int(x[0]) for x in self._places(np.frombuffer(key, dtype="V16")))
        for at in (first, second):
            held = np.flatnonzero(self.table[at] == print16)
            if len(held):
                self.table[at, held[0]] = 0
                return


def shard_of(key: bytes, shards: int) -> int:
    return int.from_bytes(key[:2], "little") % shards


def _document_keys(texts: pa.Array, min_chars: int) -> Iterator[list[bytes]]:
    for text in texts:
        text = text.as_py() or ""
        found = {line_key(line, min_chars) for line in text.split("\n")} if len(text) >= min_chars else set()
        found.discard(None)
        yield sorted(found)


class LineIndex:
    """Reference counts of lines over all inserted documents, in the folder ``path``."""

    def __init__(
        self, spark: SparkSession, path: str, *, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, doc_id: str = "doc_id",
        text: str = "text", shard_keys: int = SHARD_KEYS, max_filter_bytes: int = MAX_FILTER_BYTES,
    ) -> None:
        self.spark, self.path, self.min_chars, self.min_docs = spark, path.rstrip("/"), min_chars, min_docs
        self.doc_id, self.text, self.shard_keys, self.max_filter_bytes = doc_id, text, shard_keys, max_filter_bytes
        self.batches = self.shards = 0

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._change(docs, 1)

    def delete(self, docs: DataFrame) -> LineIndex:
        """Undo the insertion of these documents (the same ids and texts)."""
        return self._change(docs, -1)

    def hot(self) -> DataFrame:
        """``key, n_docs, keeper``: the lines to drop everywhere but in their keeper."""
        return self.spark.read.parquet(f"{self.path}/hot/version={self.batches}")

    def _refs(self) -> DataFrame:
        paths = [f"{self.path}/refs/batch={b}" for b in range(1, self.batches + 1)]
        return self.spark.read.parquet(*paths)

    def _postings(self, docs: DataFrame) -> DataFrame:
        min_chars = self.min_chars

        def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in text_slices(whole, "text"):
                    own = list(_document_keys(batch.column(1), min_chars))
                    ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(k) for k in own])
                    flat = pa.array([k for ks in own for k in ks], type=pa.binary())
                    yield pa.RecordBatch.from_arrays([flat, pa.array(ids, type=pa.int64())], names=["key", "doc_id"])

        rows = docs.select(F.col(self.doc_id).cast("long").alias("doc_id"), F.col(self.text).alias("text"))
        return rows.where("doc_id is not null").mapInArrow(keys, "key binary, doc_id long")

    def _logged(self, docs: DataFrame, delta: int, before: int) -> DataFrame:
        """The batch's rows for the log, against what the earlier batches hold."""
        came = self._postings(docs)
        if not before:
            return came.withColumn("delta", F.lit(delta)).where("delta > 0")  # nothing is held yet
        came = materialize(came.distinct(), "line-batch")
        earlier = self.spark.read.parquet(*[f"{self.path}/refs/batch={b}" for b in range(1, before + 1)])
        held = earlier.join(came, ["key", "doc_id"], "left_semi").groupBy("key", "doc_id").agg(F.sum("delta").cast("int").alias("n"))
        held = held.where("n > 0")
        if delta > 0:
            return came.join(held, ["key", "doc_id"], "left_anti").withColumn("delta", F.lit(1))
        return held.select("key", "doc_id", (-F.col("n")).alias("delta"))

    def _change(self, docs: DataFrame, delta: int) -> LineIndex:
        before, self.batches = self.batches, self.batches + 1
        self._logged(docs, delta, before).write.parquet(f"{self.path}/refs/batch={self.batches}")
        refs = self._refs()
        touched = None
        if before:
            touched = self.spark.read.parquet(f"{self.path}/refs/batch={self.batches}").select("key").distinct()
            refs = refs.join(touched, "key", "left_semi")
        held = refs.groupBy("key", "doc_id").agg(F.sum("delta").alias("n")).where("n > 0")
        hot = held.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper")).where(
            F.col("n_docs") >= self.min_docs
        )
        if before:
            old = self.spark.read.parquet(f"{self.path}/hot/version={before}")
            hot = old.join(touched, "key", "left_anti").unionByName(hot)
        hot.write.parquet(f"{self.path}/hot/version={self.batches}")
        self._update_filters(before)
        return self

    def _sharded(self, table: DataFrame) -> DataFrame:
        # The key is a digest, so its first bytes deal the keys evenly.  Read as in shard_of: low byte first.
        number = F.conv(F.concat(F.hex(F.expr("substr(key, 2, 1)")), F.hex(F.expr("substr(key, 1, 1)"))), 16, 10)
        return table.withColumn("shard", F.pmod(number.cast("int"), F.lit(self.shards)))

    def _update_filters(self, before: int) -> None:
        new = self.hot().select("key")
        wanted = min(65536, blocks_for(new.count(), self.shard_keys))
        target = f"{self.path}/filters/version={self.batches}"
        schema = "shard int, n long, filter binary"

        def build(shard: tuple, keys: pd.DataFrame) -> pd.DataFrame:
            made = CuckooFilter.build(list(keys["key"]))
            return pd.DataFrame({"shard": [shard[0]], "n": [len(keys)], "filter": [made.blob()]})

        if not before or wanted > 2 * self.shards:
            self.shards = wanted
            self._sharded(new).groupBy("shard").applyInPandas(build, schema).write.parquet(target)
            return

        old = self.spark.read.parquet(f"{self.path}/hot/version={before}").select("key")
        added = new.join(old, "key", "left_anti").withColumn("added", F.lit(True))
        removed = old.join(new, "key", "left_anti").withColumn("added", F.lit(False))
        changes = self._sharded(added.unionByName(removed))

        def update(shard: tuple, held: pd.DataFrame, changed: pd.DataFrame) -> pd.DataFrame:
            n = int(held["n"].sum()) + int(2 * changed["added"].sum() - len(changed))
            made = CuckooFilter.load(held["filter"].iloc[0]) if len(held) else CuckooFilter.build([])
            for key in changed["key"][~changed["added"].astype(bool)]:
                made.remove(key)
            full = not all(made.insert(key) for key in changed["key"][changed["added"].astype(bool)])
            # A full filter is marked and built again below, from the exact table.
            return pd.DataFrame({"shard": [shard[0]], "n": [-1 if full else n], "filter": [made.blob()]})

        held = self.spark.read.parquet(f"{self.path}/filters/version={before}")
        pending = f"{target}-pending"
        held.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(update, schema).write.parquet(pending)
        updated = self.spark.read.parquet(pending)
        full = F.broadcast(updated.where("n < 0").select("shard"))  # at most one row per shard
        rebuilt = self._sharded(new).join(full, "shard", "left_semi").groupBy("shard").applyInPandas(build, schema)
        updated.where("n >= 0").unionByName(rebuilt).write.parquet(target)

    def _filters(self) -> dict[int, bytes] | None:
        table = self.spark.read.parquet(f"{self.path}/filters/version={self.batches}")
        size = table.agg(F.sum(F.octet_length("filter"))).first()[0] or 0
        if size > self.max_filter_bytes:
            return None
        return {r["shard"]: bytes(r["filter"]) for r in table.select("shard", "filter").toLocalIterator()}

    def drops(self, docs: DataFrame) -> DataFrame:
        """``doc_id, keys``: per document that loses lines, the digests of their keys."""
        postings = self._postings(docs)
        filters = self._filters()
        if filters is not None:
            shared, shards = self.spark.sparkContext.broadcast(filters), self.shards

            def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                loaded = {s: CuckooFilter.load(b) for s, b in shared.value.items()}
                for batch in batches:
                    if not batch.num_rows or not loaded:
                        continue
                    flat = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype="V16")
                    owner = flat.view("<u2").reshape(-1, 8)[:, 0] % shards
                    known = np.zeros(len(flat), dtype=bool)
                    for shard in np.unique(owner):
                        if shard in loaded:
                            mine = owner == shard
                            known[mine] = loaded[shard].contains(np.ascontiguousarray(flat[mine]))
                    yield batch.filter(pa.array(known))

            postings = postings.mapInArrow(maybe, "key binary, doc_id long")
        exact = postings.join(self.hot().select("key", "keeper"), "key").where("doc_id <> keeper")
        return exact.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))

    def rewrite(self, docs: DataFrame) -> DataFrame:
        """The documents without their dropped lines, and ``n_lines`` (before) and ``n_dropped``."""
        min_chars = self.min_chars

        @F.pandas_udf("text string, n_dropped long")
        def cut(texts: pd.Series, keys: pd.Series) -> pd.DataFrame:
            out: list[tuple[Any, int]] = []
            for text, drop in zip(texts, keys, strict=True):
                lines, drop = text.split("\n"), set(drop)
                kept = [line for line in lines if line_key(line, min_chars) not in drop]
                out.append(("\n".join(kept), len(lines) - len(kept)))
            return pd.DataFrame(out, columns=["text", "n_dropped"])

        own = without(docs, "n_lines", "n_dropped")
        loser, lost, made = (fresh_name(docs, n) for n in ("__id", "__keys", "__cut"))
        drops = self.drops(docs).select(F.col("doc_id").alias(loser), F.col("keys").alias(lost))
        joined = own.join(drops, own[self.doc_id].cast("long") == F.col(loser), "left")
        text = F.col(f"`{self.text}`")
        # Python sees only texts that lose lines: the others are sent as nothing and kept as they are.
        changed = F.col(lost).isNotNull()
        sent = F.when(changed, text).otherwise(F.lit("")), F.coalesce(lost, F.array().cast("array<binary>"))
        joined = joined.withColumn(made, cut(*sent))
        columns = {
            "n_lines": F.size(F.split(F.coalesce(text, F.lit("")), "\n")).cast("long"),
            "n_dropped": F.when(changed, F.col(f"{made}.n_dropped")).otherwise(F.lit(0).cast("long")),
            self.text: F.when(changed, F.col(f"{made}.text")).otherwise(text),
        }
        return joined.withColumns(columns).select(*[F.col(f"`{c}`") for c in own.columns], "n_lines", "n_dropped")


def dedup_lines(docs: DataFrame, **options: Any) -> DataFrame:
    """One-shot form: index all documents, then rewrite them."""
    index = LineIndex(docs.sparkSession, scratch_path(docs.sparkSession, "line-index"), **options)
    return index.insert(docs).rewrite(docs)
