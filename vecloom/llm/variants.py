"""Spelling variants: words one edit apart, found by dense tiles of prefixes and suffixes.

Two different words, the longer of ``m`` code points, differ by one inserted, deleted or
replaced code point exactly if common prefix plus common suffix reach ``m - 1``.

The places of an edit are cut into ``TILES`` windows of ``s = ceil(m / TILES)`` code points.
A pair whose common prefix ends in the window ``[x, x + s)`` shares its first ``x`` and its
last ``m - x - s`` code points, so it lies in the tile of words with these ends and with
``m`` or ``m - 1`` code points.  A word takes part in the tiles of its own length and of
the next.  In a task a tile's words are rows of padded code-point matrices, one aligned
left, one aligned right; block by block, rows meet rows, and leading and trailing equal
columns are counted.  A pair counts only in the tile of the window in which its common
prefix ends, so it is found once, and nothing but sums and the best partner per word
leaves the task.

A tile of more than ``max_tile`` words is cut into the tiles of single places
(``s = 1``) of its window.  There all words agree but for one code point, so such a tile
has no more words than the alphabet has letters, plus one: no tile grows with the table.

The form of a word is its most frequent near word (ties: the smallest in code-point
order) if that is at least ``ratio`` times as frequent as the word.  Counts along forms
grow by ``ratio``, so a chain has at most log(largest count) steps and pointer doubling
follows it in a known number of joins.

Defined results: null words and null counts are left out; rows that repeat a word add up;
an empty table gives an empty one; words of any length are compared whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.sources.scratch import materialize, small_copy

MIN_CHARS, MIN_COUNT, RATIO = 7, 2, 10
TILES, MAX_TILE = 3, 1024
# Bytes of compared rows held at once in a task.
_BLOCK_BYTES = 16_000_000
_KEYS = ["m", "x", "s", "tile"]


def _window(m: Column, x: Column, s: Column, word: Column) -> Column:
    """One tile of a word: longer length, start and width of the window, digest of the shared ends."""
    tail = F.greatest(m - x - s, F.lit(0))
    start = (F.char_length(word) - tail + 1).cast("int")
    ends = F.xxhash64(F.substr(word, F.lit(1), x), F.lit("\n"), F.substr(word, start, tail))
    return F.struct(m.alias("m"), x.alias("x"), s.alias("s"), ends.alias("tile"))


def tiles_of(words: DataFrame, tiles: int = TILES) -> DataFrame:
    """One row per word and tile."""
    word = F.col("word")

    def of_length(m: Column) -> Column:
        s = F.ceil(m / tiles).cast("int")
        places = F.filter(F.transform(F.sequence(F.lit(0), F.lit(tiles - 1)), lambda t: t * s), lambda x: x < m)
        return F.transform(places, lambda x: _window(m, x, s, word))

    length = F.char_length(word).cast("int")
    both = F.concat(of_length(length), of_length(length + 1))
    return words.select("word", "n", F.explode(both).alias("w")).select("word", "n", *[f"w.{k}" for k in _KEYS])


def single_places(rows: DataFrame) -> DataFrame:
    """Cut tiles into those of every single place of their window."""
    last = F.least(F.col("x") + F.col("s"), F.col("m")) - 1
    places = F.transform(F.sequence(F.col("x"), last), lambda x: _window(F.col("m"), x, F.lit(1), F.col("word")))
    return rows.select("word", "n", F.explode(places).alias("w")).select("word", "n", *[f"w.{k}" for k in _KEYS])


def split_tiles(words: DataFrame, tiles: int = TILES, max_tile: int = MAX_TILE) -> DataFrame:
    """Tiles of bounded size."""
    rows = tiles_of(words, tiles)
    large = materialize(rows.groupBy(*_KEYS).count().where(F.col("count") > max_tile).drop("count"), "large-tiles")
    few = small_copy(large)
    large = large if few is None else few
    return rows.join(large, _KEYS, "left_anti").unionByName(single_places(rows.join(large, _KEYS, "left_semi")))


def code_points(words: list[str], m: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of ``m`` or ``m - 1`` code points as rows, aligned left and aligned right, padded with zeros."""
    left = np.array(words, dtype=f"U{m}").view(np.uint32).reshape(len(words), m)
    if left.max(initial=0) < 256:
        left = left.astype(np.uint8)
    short = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) < m
    right = left.copy()
    right[short, 1:], right[short, 0] = left[short, :-1], 0
    return left, right


def near_rows(words: list[str], m: int, x: np.ndarray, s: np.ndarray, until: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs one edit apart: row ``i`` meets the rows after it up to ``until[i]``, unless both are short.

    ``x`` and ``s`` are the window in which a pair's common prefix has to end.
    """
    left, right = code_points(words, m)
    full = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) == m
    partners = np.where(full, until - np.arange(len(words)) - 1, 0)  # full words come first in a tile
    total = np.concatenate([[0], np.cumsum(partners)])
    per_block, row = max(1, _BLOCK_BYTES // (4 * m * left.itemsize)), 0
    while row < len(words):
        stop = max(row + 1, int(np.searchsorted(total, total[row] + per_block, side="right")) - 1)
        counts = partners[row:stop]
        a = np.repeat(np.arange(row, stop), counts)
        b = np.arange(total[row], total[stop]) - np.repeat(total[row:stop], counts) + a + 1
        row = stop
        if not len(a):
            continue
        # A row that differs nowhere would have argmin 0; words are different, so each pair differs in some column.
        prefix = np.argmax(left[a] != left[b], axis=1)
        inside = (prefix >= x[a]) & (prefix < x[a] + s[a])
        a, b, prefix = a[inside], b[inside], prefix[inside]
        suffix = np.argmax((right[a] != right[b])[:, ::-1], axis=1)
        near = prefix + suffix >= m - 1
        yield a[near], b[near]


def _best(words: list[str], n: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
    """Per word its number of near words and the most frequent one."""
    own, other = np.concatenate([a, b]), np.concatenate([b, a])
    names = np.array(words, dtype=object)
    order = np.lexsort((names[other].astype("U") if len(other) else other, -n[other], own))
    own, other = own[order], other[order]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(own)))
    return pa.table({
        "word": pa.array(names[own[first]], pa.string()),
        "n_near": pa.array(counts.astype(np.int64)),
        "near_n": pa.array(n[other[first]].astype(np.int64)),
        "near_word": pa.array(names[other[first]], pa.string()),
    })


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the rows of every tile; rows arrive sorted by tile, and a tile may span batches."""
    held: pa.Table | None = None

    def done(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        columns = {k: rows.column(k).to_numpy() for k in [*_KEYS, "n"]}
        new = np.ones(rows.num_rows, dtype=bool)
        new[1:] = np.any([columns[k][1:] != columns[k][:-1] for k in _KEYS], axis=0)
        first = np.flatnonzero(new)
        until = np.repeat(np.append(first[1:], rows.num_rows), np.diff(np.append(first, rows.num_rows)))
        edges = np.flatnonzero(np.concatenate([[True], columns["m"][1:] != columns["m"][:-1]]))
        for start, stop in zip(edges, np.append(edges[1:], rows.num_rows), strict=True):
            words = rows.column("word").slice(start, stop - start).to_pylist()
            pairs = list(near_rows(words, int(columns["m"][start]), columns["x"][start:stop], columns["s"][start:stop],
                                   until[start:stop] - start))
            a, b = (np.concatenate([p[i] for p in pairs]) if pairs else np.zeros(0, np.int64) for i in (0, 1))
            if len(a):
                yield from _best(words, columns["n"][start:stop], a, b).to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        last = [pc.not_equal(rows.column(k), rows.column(k)[-1]).to_numpy() for k in _KEYS]
        other = np.flatnonzero(np.any(last, axis=0))
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield from done(rows.slice(0, cut))
        held = rows.slice(cut)
    if held is not None and held.num_rows:
        yield from done(held)


def near_words(words: DataFrame, *, tiles: int = TILES, max_tile: int = MAX_TILE) -> DataFrame:
    """Of distinct (word, n): word, n_near, near_n and near_word for every word that has a near word."""
    rows = split_tiles(words, tiles, max_tile).withColumn("short", F.char_length("word") < F.col("m"))
    placed = rows.repartition(*_KEYS).sortWithinPartitions(*_KEYS, "short").drop("short")
    found = placed.mapInArrow(_compare, "word string, n_near long, near_n long, near_word string")
    best = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near_word")).alias("best")
    )
    return best.select("word", "n_near", (-F.col("best.less")).alias("near_n"), "best.near_word")


def roots_of(forms: DataFrame, steps: int) -> DataFrame:
    """The last word of every chain of (word, form) that has at most ``steps`` steps: word, root."""
    up = materialize(forms.select("word", F.col("form").alias("root")), "variant-roots")
    for _ in range(max(0, steps - 1).bit_length()):
        after = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = materialize(up.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "variant-roots")
    return up


def group_variants(words: DataFrame, *, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO,
                   tiles: int = TILES, max_tile: int = MAX_TILE) -> DataFrame:
    """Of (word, n): word, form, root, n, n_near, form_n of all words that are long and frequent enough."""
    if ratio < 2 or min_chars < 2 or min_count < 1:
        raise ValueError("ratio and min_chars must be at least 2, min_count at least 1")
    counted = words.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum(F.col("n").cast("long")).alias("n"))
    counted = materialize(counted.where((F.col("n") >= min_count) & (F.char_length("word") >= min_chars)), "variant-words")
    near = near_words(counted, tiles=tiles, max_tile=max_tile)
    fits = F.col("near_n") >= ratio * F.col("n")
    linked = materialize(
        counted.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("near_word")).alias("form"), F.when(fits, F.col("near_n")).alias("form_n"),
        ),
        "variants",
    )
    most = linked.agg(F.max("n")).first()[0] or 1
    roots = roots_of(linked.where(F.col("form").isNotNull()), int(math.log(max(1, most / min_count), ratio)) + 1)
    return linked.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
