"""Periodic runs of words by maximal-pair enumeration over an LCP-interval tree.

A run is a stretch of consecutive words with smallest period ``q`` and at least
``max(min_words, min_repeats * q)`` words that no neighbouring word extends.

Two positions at distance ``q`` with ``l`` equal words from them on, different next words
and different words before them are a maximal pair.  Such a pair with ``l`` of at least
``max(min_words - q, (min_repeats - 1) * q)`` *is* the stretch of ``l + q`` words that
starts at the first position, so nothing is extended afterwards.  Multiples of a run's
period give the same stretch; the smallest period of a stretch is kept.

Per slice of texts:

1. Suffixes are sorted by prefix doubling in NumPy; a position whose next ``h`` words are
   unique in its text is settled and leaves.  The common prefixes of neighbours in that
   order follow from the ranks of all rounds.
2. A position with no equal start of ``least`` words within the distance that its longest
   repeat allows can not be in a pair and leaves, which removes ordinary text.
3. The LCP intervals of the others are visited bottom-up with a stack.  An interval keeps
   its positions in page order with their class, the word to their left.  Children are
   joined small into large, and pairs are taken between them, never inside one.
   Equal stretches of ``l`` words that start within ``l / 2`` words of each other start
   one period apart, and all but the first have the same word to their left.  So what is
   in reach of a position has two classes at most, the smaller of one position, and two
   binary searches find the pairs of different classes without looking at the others.

A word is ``[^\\x20\\x09-\\x0D]+``; equal words are equal bytes.  Texts are independent, so
nothing is shuffled.

Defined results: a null or empty text has no runs and collapses to the empty text.  Rows
that repeat are answered alike.  Columns of the input named like the results are replaced.
Two runs may start at the same word; they are listed by start, then period.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import fresh_name, text_slices, without

MIN_WORDS, MIN_REPEATS = 6, 4
_SLICE_BYTES = 2_000_000


def least_match(min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> int:
    """The shortest match that a pair of some distance needs."""
    return min(max(min_words - q, (min_repeats - 1) * q) for q in range(1, max(2, min_words)))


def _edges(values: np.ndarray) -> np.ndarray:
    """Where a new value starts in a sorted array."""
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return new


def suffix_order(ids: np.ndarray, text_of: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose repeat in their own text may reach ``least`` words, in suffix order, and common prefixes of neighbours.

    ``ids`` are the words of all texts in a row, ``text_of`` and ``ends`` say to which text a
    position belongs and where that text ends.
    """
    n = len(ids)
    rank = np.zeros(n, dtype=np.int64)
    key = text_of * (int(ids.max()) + 1) + ids
    active = np.argsort(key, kind="stable")
    key, h = key[active], 1
    rounds: list[tuple[int, np.ndarray, np.ndarray]] = []
    while True:
        old = rank[active]
        index = np.arange(len(active))
        group = np.maximum.accumulate(np.where(_edges(old), index, 0))
        first = np.flatnonzero(_edges(key))
        sizes = np.diff(np.append(first, len(active)))
        part = np.repeat(first, sizes)
        rank[active] = old + part - group
        active = active[np.repeat(sizes > 1, sizes)]
        if not len(active):
            break
        rounds.append((h, active, rank[active]))
        after = active + h
        following = np.where(after < ends[active], rank[np.minimum(after, n - 1)], -1)
        key = rank[active] * (n + 1) + following + 1
        order = np.argsort(key, kind="stable")
        active, key, h = active[order], key[order], 2 * h
    enough = [positions for size, positions, _ in rounds if size <= least]
    if not enough or 2 * rounds[len(enough) - 1][0] <= least:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = enough[-1][np.argsort(rank[enough[-1]])]
    shared = np.zeros(max(0, len(order) - 1), dtype=np.int64)
    for size, positions, ranks in reversed(rounds):
        at = np.full(n + 1, -1, dtype=np.int64)
        at[positions] = ranks
        one, other = at[np.minimum(order[:-1] + shared, n)], at[np.minimum(order[1:] + shared, n)]
        shared += np.where((one == other) & (one >= 0), size, 0)
    return order, shared


def near_repeats(order: np.ndarray, shared: np.ndarray, least: int, power: int) -> tuple[np.ndarray, np.ndarray]:
    """Only positions with an equal start near enough for their longest repeat, and the common prefixes between them."""
    if len(order) < 2:
        return order[:0], shared[:0]
    longest = np.maximum(np.append(shared, 0), np.append(0, shared))
    group = np.append(0, np.cumsum(shared < least))
    by_page = np.lexsort((order, group))
    gaps = np.where(np.diff(group[by_page]) == 0, np.diff(order[by_page]), np.iinfo(np.int64).max)
    nearest = np.empty(len(order), dtype=np.int64)
    nearest[by_page] = np.minimum(np.append(gaps, np.iinfo(np.int64).max), np.append(np.iinfo(np.int64).max, gaps))
    kept = np.flatnonzero((longest >= least) & (nearest <= longest // power))
    if len(kept) < 2:
        return order[:0], shared[:0]
    return order[kept], np.minimum.reduceat(np.append(shared, 0), kept)[:-1]


def maximal_pairs(order: list[int], shared: list[int], before: np.ndarray, least: int, power: int) -> list[tuple[int, int, int]]:
    """(first position, distance, match) of all maximal pairs whose match is at least ``power`` distances.

    ``before`` has the class of every position: the word to its left, or a value of its own.
    """
    pairs: list[tuple[int, int, int]] = []
    left = before.tolist() if len(order) * 4 > len(before) else {p: int(before[p]) for p in order}

    def join(one: list[int], other: list[int], match: int) -> list[int]:
        small, big = (one, other) if len(one) < len(other) else (other, one)
        reach = match // power
        for p in small:
            mine, k = left[p], bisect_right(big, p)
            for at in range(k, len(big)):
                if big[at] - p > reach or left[big[at]] == mine:
                    break
                pairs.append((p, big[at] - p, match))
            first = bisect_left(big, p - reach, 0, k)
            if first < k and left[big[first]] != mine:
                pairs.append((big[first], p - big[first], match))
        if len(small) * 8 < len(big):
            for p in small:
                insort(big, p)
        else:
            big += small
            big.sort()
        return big

    stack: list[tuple[int, list[int]]] = []
    for i, position in enumerate(order):
        held = [position]
        match = shared[i] if i < len(shared) else 0
        while stack and stack[-1][0] > match:
            depth, earlier = stack.pop()
            held = join(earlier, held, depth)
        if match < least:
            continue  # the stack is empty: what was open is complete
        if stack and stack[-1][0] == match:
            held = join(stack.pop()[1], held, match)
        stack.append((match, held))
    return pairs


def runs_of(ids: np.ndarray, sizes: np.ndarray, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, in that order but period before length, of texts that lie in a row."""
    if min_repeats < 3:
        raise ValueError("min_repeats must be at least 3")
    none = np.zeros((0, 4), dtype=np.int64)
    if not len(ids):
        return none
    firsts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    least, power = least_match(min_words, min_repeats), min_repeats - 1
    order, shared = suffix_order(ids, text_of, firsts[1:][text_of], least)
    order, shared = near_repeats(order, shared, least, power)
    if not len(order):
        return none
    before = np.concatenate([[-1], ids[:-1]])
    before[firsts[:-1][sizes > 0]] = -1  # no word: a class that no other position of the text has
    periods: dict[tuple[int, int], int] = {}
    for start, distance, match in maximal_pairs(order.tolist(), shared.tolist(), before, least, power):
        if match + distance >= min_words:
            stretch = (start, match + distance)
            periods[stretch] = min(distance, periods.get(stretch, distance))
    if not periods:
        return none
    start, length = np.array(list(periods), dtype=np.int64).T
    period = np.array(list(periods.values()), dtype=np.int64)
    found = np.stack([text_of[start], start - firsts[text_of[start]], length, period], axis=1)
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def _slice_results(texts: list[bytes | None], min_words: int, min_repeats: int) -> tuple[np.ndarray, list[bytes]]:
    """Runs of some texts, and every text without the repeats: words joined by one space."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    split = [t.split() if t else [] for t in texts]  # bytes.split() splits at exactly the six ASCII spaces
    sizes = np.array([len(words) for words in split], dtype=np.int64)
    ids = np.fromiter((number[word] for words in split for word in words), dtype=np.int64, count=int(sizes.sum()))
    runs = runs_of(ids, sizes, min_words, min_repeats)
    collapsed = []
    bounds = np.searchsorted(runs[:, 0], np.arange(len(split) + 1))
    for words, a, b in zip(split, bounds[:-1], bounds[1:], strict=True):
        if a < b:
            change = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(change, runs[a:b, 1] + runs[a:b, 3], 1)
            np.add.at(change, runs[a:b, 1] + runs[a:b, 2], -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
        collapsed.append(b" ".join(words))
    return runs, collapsed


def find_runs(docs: DataFrame, *, text: str = "text", min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """Add ``runs``, an array of (start, length, period) by start and period, and ``collapsed``.

    ``collapsed`` is the text without words that a run repeats: of every run the first
    period stays unless another run drops it.
    """
    fields = [pa.field(name, pa.int64()) for name in ("start", "length", "period")]

    @F.arrow_udf("struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>")
    def measure(texts: pa.Array) -> pa.Array:
        runs, sizes, collapsed = [np.zeros((0, 4), np.int64)], [], []
        for part in text_slices(pa.RecordBatch.from_arrays([texts], names=["t"]), "t", _SLICE_BYTES):
            column = part.column(0)
            kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
            found, short = _slice_results(column.cast(kind).to_pylist(), min_words, min_repeats)
            runs.append(found)
            sizes.append(np.bincount(found[:, 0], minlength=len(short)))
            collapsed += short
        table = np.concatenate(runs)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1)
        rows = pa.StructArray.from_arrays([pa.array(table[:, c].copy()) for c in (1, 2, 3)], fields=fields)
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), rows)
        return pa.StructArray.from_arrays(
            [lists, pa.array(collapsed, pa.binary()).cast(pa.string())], names=["runs", "collapsed"]
        )

    found = fresh_name(docs, "found")
    rows = without(docs, *({"runs", "collapsed"} - {text.lower()})).withColumn(found, measure(F.col(f"`{text}`")))
    if text.lower() in ("runs", "collapsed"):
        rows = without(rows, text)
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != found], f"{found}.runs", f"{found}.collapsed")
