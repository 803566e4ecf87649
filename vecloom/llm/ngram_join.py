"""Jaccard join on word n-grams with Bayesian candidate pruning.

1. Texts with the same shingle set form a class; only the text of its smallest doc_id goes on.
2. Banded MinHash buckets propose pairs.  Inside a bucket, MinHash values are
   compared a few at a time, and a pair is dropped as soon as the posterior
   probability that its similarity reaches the threshold falls below ``tolerance``.
   What a bucket sends on is a spanning forest of its surviving pairs, never the
   pairs.  Buckets larger than a block meet in pairs of blocks.
3. Connected survivors form a candidate group.  Its members' signatures and
   shingle sets are dealt in blocks; every pair of blocks is one unit of work, in
   which all pairs are pruned the same way and the rest is verified exactly, by
   sorted intersection or, for dense groups, by products of 0/1 matrices.
4. A unit returns link counts per class and a spanning forest of its exact links.

A pair at the threshold shares no bucket with probability ``(1 - t^rows)^bands``
(5e-8 by default), and Bayesian pruning loses it with about ``tolerance``; all
others are exact.

Defined results: similarity counts distinct shingles.  A document without words, or
with a null id, links with nothing.  Rows that repeat an id count as rows: each has the
class and links of its own text.  Classes are told apart by 64 bits of their digest.  Texts
shorter than ``k`` words are one shingle.  An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import text_slices, without
from vecloom.llm.components import connected_components, local_components
from vecloom.llm.textbytes import mixed, shingle_sets
from vecloom.sources.scratch import materialize

WORDS, THRESHOLD, TOLERANCE = 5, 0.8, 1e-6
BANDS, ROWS, STEP = 32, 4, 16
BUCKET_BLOCK, GROUP_BLOCK = 1024, 256
_PERMUTATIONS = BANDS * ROWS
_FLIP = mixed(np.arange(1, _PERMUTATIONS + 1, dtype=np.uint64)).astype(np.uint32)
_SCALE = mixed(np.arange(1001, 1001 + _PERMUTATIONS, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """``BANDS * ROWS`` MinHash values of a non-empty set of 64-bit hashes."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(_PERMUTATIONS, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(short), 2048):
        np.minimum(least, ((short[i:i + 2048, None] ^ _FLIP) * _SCALE).min(axis=0), out=least)
    return least


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per band."""
    rows = signature.reshape(BANDS, ROWS).astype(np.uint64)
    key = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
    for r in range(ROWS):
        key = mixed(key ^ (rows[:, r] + np.uint64(0x9E3779B9)))
    return key.view(np.int64)


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """After each ``STEP`` compared values, the fewest matches with P(similarity >= threshold) >= tolerance.

    The prior is uniform, so the posterior of m matches in n is Beta(m + 1, n - m + 1), integrated numerically.
    """
    grid = (np.arange(20_000) + 0.5) / 20_000
    high = grid >= threshold
    bounds = []
    for n in range(STEP, _PERMUTATIONS + 1, STEP):
        for m in range(n + 1):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            weight = np.exp(log - log.max())
            if weight[high].sum() >= tolerance * weight.sum():
                bounds.append(m)
                break
        else:
            bounds.append(n)
    return bounds


def likely_pairs(
    left: np.ndarray, right: np.ndarray | None, left_size: np.ndarray, right_size: np.ndarray, threshold: float, bounds: list[int]
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that survive; within ``left`` (each pair once) if ``right`` is None."""
    own = right is None
    right = left if own else right
    found_a, found_b = [], []
    for i in range(len(left)):
        begin = i + 1 if own else 0
        # The sizes alone bound the similarity, exactly.
        small, large = np.minimum(right_size[begin:], left_size[i]), np.maximum(right_size[begin:], left_size[i])
        j = np.flatnonzero(small >= threshold * large) + begin
        matches = np.zeros(len(j), dtype=np.int64)
        for step, bound in enumerate(bounds):
            if not len(j):
                break
            part = slice(step * STEP, (step + 1) * STEP)
            matches += (right[j, part] == left[i, part]).sum(axis=1)
            stay = matches >= bound
            j, matches = j[stay], matches[stay]
        if len(j):
            found_a.append(np.full(len(j), i))
            found_b.append(j)
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def exact_links(
    left: list[np.ndarray], right: list[np.ndarray], a: np.ndarray, b: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Those of the index pairs (a, b) whose sets reach the threshold."""
    if not len(a):
        return a, b
    used_a, at_a = np.unique(a, return_inverse=True)
    used_b, at_b = np.unique(b, return_inverse=True)
    if len(a) <= 2 * (len(used_a) + len(used_b)):
        common = np.array([len(np.intersect1d(left[i], right[j], assume_unique=True)) for i, j in zip(a, b, strict=True)])
    else:
        common = _overlaps([left[i] for i in used_a], [right[j] for j in used_b])[at_a, at_b]
    sizes = np.array([len(left[i]) for i in used_a])[at_a] + np.array([len(right[j]) for j in used_b])[at_b]
    linked = common >= threshold * (sizes - common) - 1e-9
    return a[linked], b[linked]


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections: 0/1 matrices over the common vocabulary, a bounded number of columns at a time."""
    words = np.intersect1d(np.concatenate(left), np.concatenate(right))

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.searchsorted(words, flat)
        known = (at < len(words)) & (words[np.minimum(at, max(0, len(words) - 1))] == flat) if len(words) else np.zeros(0, bool)
        return (owner[known], at[known]) if len(words) else (owner[:0], at[:0])

    (own_l, at_l), (own_r, at_r) = places(left), places(right)
    total = np.zeros((len(left), len(right)), dtype=np.float64)
    for start in range(0, len(words), width):
        sides = []
        for own, at, n in ((own_l, at_l, len(left)), (own_r, at_r, len(right))):
            here = (at >= start) & (at < start + width)
            m = np.zeros((n, min(width, len(words) - start)), dtype=np.float32)
            m[own[here], at[here] - start] = 1
            sides.append(m)
        total += sides[0] @ sides[1].T
    return np.rint(total).astype(np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _signatures(docs: DataFrame, k: int, with_sets: bool) -> DataFrame:
    """``doc_id, text_key, n, sig`` and ``set_key`` or ``shingles``, without the documents that have no words."""
    third = "shingles" if with_sets else "set_key"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "text"):
                sets = shingle_sets(batch.column(1), k)
                full = np.array([len(s) > 0 for s in sets], dtype=bool)
                sets = [s for s in sets if len(s)]
                raw = [s.tobytes() if with_sets else xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).filter(pa.array(full)), batch.column(2).filter(pa.array(full)), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([minhash(s).tobytes() for s in sets], pa.binary()), pa.array(raw, pa.binary())],
                    names=["doc_id", "text_key", "n", "sig", third],
                )

    return docs.select("doc_id", "text", "text_key").mapInArrow(sign, f"doc_id long, text_key long, n long, sig binary, {third} binary")


def _dealt(rows: DataFrame, group: str, size: str, identity: str, per_block: int) -> DataFrame:
    """Deal each group's rows over blocks and copy every row to its block's pairs: columns ``unit, side``.

    A group within one block is one unit; rows of a larger one go to as many units as it has blocks.
    """
    blocks = F.ceil(F.col(size) / per_block).cast("int")
    block = F.pmod(F.xxhash64(identity, F.lit(7)), blocks).cast("int")
    partners = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda j: F.struct(F.least(block, j).alias("i"), F.greatest(block, j).alias("j"), (block > j).cast("int").alias("side")),
    )
    spread = rows.withColumn("__pair", F.explode(partners))
    unit = F.struct(F.col(group).alias("g"), F.col("__pair.i"), F.col("__pair.j"))
    return spread.withColumns({"unit": unit, "side": F.col("__pair.side")}).drop("__pair")


def _units(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Bring units together: partitions hold many units, each one's rows side by side."""
    narrow = rows.select(F.xxhash64("unit").alias("__deal"), "unit.g", "unit.i", "unit.j", "side", *columns)
    return narrow.repartition("__deal", "g", "i", "j").sortWithinPartitions("g", "i", "j", "side").drop("__deal")


def jaccard_links(
    docs: DataFrame, *, k: int = WORDS, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row of ``docs`` with an id: ``doc_id, class_id, n_links, component_id``.

    ``class_id`` is the smallest id with the same shingle set, ``n_links`` the number of other rows linked directly,
    ``component_id`` the smallest id reachable by links.
    """
    columns = "doc_id", "class_id", "n_links", "component_id"
    return _row_links(docs, k, threshold, tolerance, doc_id, text).select(*columns)


def _row_links(docs: DataFrame, k: int, threshold: float, tolerance: float, doc_id: str, text: str) -> DataFrame:
    """:func:`jaccard_links` with the ``text_key`` that tells rows of one id apart."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_key"))
    rows = rows.where("doc_id is not null")
    bounds = least_matches(threshold, tolerance)
    signed = materialize(_signatures(rows, k, False), "signatures")
    classes = signed.groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_key")).alias("least"), F.count("*").alias("copies"), F.first("n").alias("n"),
        F.first("sig").alias("sig"),
    )
    # An id may stand in several classes, so they are numbered by their digest.
    numbered = F.xxhash64("set_key").alias("rep"), F.col("least.doc_id").alias("class_id"), F.col("least.text_key").alias("text_key")
    classes = materialize(classes.select("set_key", *numbered, "copies", "n", "sig"), "classes")
    candidates = connected_components(_bucket_forest(classes, threshold, bounds))
    groups = candidates.groupBy("component").agg(F.count("*").alias("members")).where("members > 1")
    members = materialize(candidates.join(groups, "component"), "candidates")
    found = materialize(_verified(rows, classes, members, k, threshold, bounds), "links")

    links = found.where("b is null").groupBy("a").agg(F.sum("weight").alias("other"))
    parts = connected_components(found.where("b is not null").select("a", "b"))
    named = parts.join(classes.select(F.col("rep").alias("id"), "class_id"), "id")
    least = named.groupBy("component").agg(F.min("class_id").alias("component_id"))
    parts = parts.join(least, "component").select("id", "component_id")
    table = (
        classes.select("set_key", "rep", "class_id", "copies")
        .join(links, F.col("rep") == F.col("a"), "left")
        .join(parts, F.col("rep") == F.col("id"), "left")
        .select(
            "set_key", "class_id", F.coalesce("component_id", "class_id").alias("component_id"),
            (F.col("copies") - 1 + F.coalesce("other", F.lit(0))).alias("n_links"),
        )
    )
    columns = "doc_id", "text_key", "class_id", "n_links", "component_id"
    worded = signed.select("doc_id", "text_key", "set_key").join(table, "set_key").select(*columns)
    silent = rows.select("doc_id", "text_key").join(signed.select("doc_id", "text_key"), ["doc_id", "text_key"], "left_anti")
    alone = F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("component_id")
    return worded.unionByName(silent.select("doc_id", "text_key", *alone))


def _bucket_forest(classes: DataFrame, threshold: float, bounds: list[int]) -> DataFrame:
    """Edges ``a, b`` that connect, bucket by bucket, all pairs that survive pruning."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = [band_keys(np.frombuffer(s, dtype=np.uint32)) for s in batch.column(1).to_pylist()]
                reps = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(np.concatenate(made))], names=["rep", "key"])

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, unit in groupby(_rows(batches), key=lambda r: r[:3]):
            unit = list(unit)
            ids = np.array([r[4] for r in unit])
            sizes = np.array([r[5] for r in unit])
            sigs = np.frombuffer(b"".join(r[6] for r in unit), dtype=np.uint32).reshape(-1, _PERMUTATIONS)
            cut = sum(r[3] == 0 for r in unit)
            if unit[0][1] == unit[0][2]:
                a, b = likely_pairs(sigs, None, sizes, sizes, threshold, bounds)
            else:
                a, b = likely_pairs(sigs[:cut], sigs[cut:], sizes[:cut], sizes[cut:], threshold, bounds)
                b = b + cut
            if len(a):
                yield _forest(ids, a, b)

    banded = classes.select("rep", "sig").mapInArrow(keys, "rep long, key long")
    shared = banded.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    mine = banded.join(shared, "key").groupBy("rep").agg(F.collect_list(F.struct("key", "m")).alias("keys"))  # BANDS at most
    spread = mine.join(classes.select("rep", "n", "sig"), "rep").select("rep", "n", "sig", F.explode("keys").alias("k"))
    dealt = _dealt(spread.select("rep", "n", "sig", "k.key", "k.m"), "key", "m", "rep", BUCKET_BLOCK)
    return _units(dealt, ["rep", "n", "sig"]).mapInArrow(forest, "a long, b long, weight long").select("a", "b")


def _forest(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    root = local_components(len(ids), a, b)
    child = np.flatnonzero(root != np.arange(len(ids)))
    none = pa.nulls(len(child), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(ids[root[child]]), pa.array(ids[child]), none], names=["a", "b", "weight"])


def _verified(
    rows: DataFrame, classes: DataFrame, members: DataFrame, k: int, threshold: float, bounds: list[int]
) -> DataFrame:
    """Exact links inside candidate groups: counts as (a, null, weight), a forest as (a, b, null)."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, unit in groupby(_rows(batches), key=lambda r: r[:3]):
            unit = list(unit)
            ids, copies = np.array([r[4] for r in unit]), np.array([r[5] for r in unit])
            sigs = np.frombuffer(b"".join(r[6] for r in unit), dtype=np.uint32).reshape(-1, _PERMUTATIONS)
            sets = [np.frombuffer(r[7], dtype=np.uint64) for r in unit]
            sizes = np.array([len(s) for s in sets])
            cut = sum(r[3] == 0 for r in unit)
            if unit[0][1] == unit[0][2]:
                a, b = likely_pairs(sigs, None, sizes, sizes, threshold, bounds)
                a, b = exact_links(sets, sets, a, b, threshold)
            else:
                a, b = likely_pairs(sigs[:cut], sigs[cut:], sizes[:cut], sizes[cut:], threshold, bounds)
                a, b = exact_links(sets[:cut], sets[cut:], a, b, threshold)
                b = b + cut
            if len(a):
                weight = np.zeros(len(ids), dtype=np.int64)
                np.add.at(weight, a, copies[b])
                np.add.at(weight, b, copies[a])
                linked = np.flatnonzero(weight)
                none = pa.nulls(len(linked), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[linked]), none, pa.array(weight[linked])], names=["a", "b", "weight"]
                )
                yield _forest(ids, a, b)

    reps = members.join(classes.select("rep", "class_id", "text_key", "copies"), F.col("id") == F.col("rep"))
    reps = reps.select("rep", F.col("class_id").alias("doc_id"), "text_key", "copies", "component", "members")
    row = ["doc_id", "text_key"]
    sets = _signatures(rows.join(reps.select(*row), row, "left_semi"), k, True).dropDuplicates(row).select(*row, "sig", "shingles")
    dealt = _dealt(reps.join(sets, row), "component", "members", "rep", GROUP_BLOCK)
    return _units(dealt, ["rep", "copies", "sig", "shingles"]).mapInArrow(check, "a long, b long, weight long")


def keep_one_per_group(docs: DataFrame, **options) -> DataFrame:
    """The rows whose id is the smallest of their group; rows with a null id stay."""
    key, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    given = {"k": WORDS, "threshold": THRESHOLD, "tolerance": TOLERANCE, "doc_id": key, "text": text} | options
    gone = _row_links(docs, **given).where("doc_id <> component_id")
    gone = gone.select(F.col("doc_id").alias("__gone"), F.col("text_key").alias("__gone_text")).distinct()
    own = without(docs, "__gone", "__gone_text")
    same = (own[key].cast("long") == F.col("__gone")) & (F.xxhash64(own[text]) == F.col("__gone_text"))
    return own.join(gone, same, "left_anti")
