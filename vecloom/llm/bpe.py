"""Byte-level BPE encoding and decoding by the ranks of a public vocabulary.

A text is split by the vocabulary's pattern and every word is encoded on its own: starting
from its single bytes, the adjacent pair with the lowest rank (the first of equal ones) is
merged until no pair has a rank.

:func:`fold_words` is that fold in Spark's higher-order functions, over the byte arrays of
distinct words, with the ranks of all pieces that occur in them as one literal map, cut into
small buckets because maps are searched from the front.  :func:`encode` uses it for the head of the vocabulary,
the ``head_words`` most frequent distinct words of the first ``sample_rows`` rows of every
partition, which cover most of any text; their table has a fixed bound and goes to every
task.  A batch's other distinct words are folded in the task by the same merges, together:
words are rows of a matrix, and a round merges one pair of every word.  The sample decides
only where a word is folded, never its ids.  Folding every distinct word of the corpus in
Spark and joining the results back to all texts is exact too, but took several times the
limits in processor time and disk; the README has the figures.

:func:`decode` concatenates the binary pieces of the ids.

Defined results: a null text is empty and has no ids; null ids decode to no bytes.  The
file of ranks is read on the driver.  Columns of the input named like the results are
replaced.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import text_slices, without

BUCKET_PIECES, HEAD_WORDS, SAMPLE_ROWS, MEMO_WORDS = 6, 4096, 20, 80_000
# Text and ids worked on at once in a task: index arrays take some twenty times as much.
_SLICE_BYTES = 1_000_000
_NO_RANK = 2**31 - 1
# Longer words are merged alone; parts of one matrix of words.
_WIDEST, _MATRIX_PARTS = 64, 100_000
_STATE: dict[str, _Coder] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    """Lines of a base64 piece and its rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in file if line.strip())}


@lru_cache
def compiled(pattern: str) -> regex.Pattern:
    """White space is Unicode's property; Python's own class also has four control characters."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def occurring(ranks: dict[bytes, int], words: list[str]) -> dict[bytes, int]:
    """The ranks that folding these words can look up: those of pieces that occur in one of them."""
    longest = max(map(len, ranks), default=0)
    found = {}
    for raw in map(str.encode, words):
        for i in range(len(raw)):
            for j in range(i + 1, min(len(raw), i + longest) + 1):
                piece = raw[i:j]
                if piece in ranks:
                    found[piece] = ranks[piece]
    return found


def rank_table(ranks: dict[bytes, int], count: int) -> Column:
    """Literal array of literal maps; a piece's bucket is its crc32."""
    buckets: list[list[str]] = [[] for _ in range(count)]
    for key, rank in ranks.items():
        buckets[zlib.crc32(key) % count].append(f"X'{key.hex()}', {rank}")
    maps = (f"map({', '.join(b)})" if b else "cast(map() as map<binary, int>)" for b in buckets)
    return F.expr(f"array({', '.join(maps)})")


def fold_words(word: Column, ranks: dict[bytes, int]) -> Column:
    """Ids of a string column that holds one non-empty word per row."""
    # The table is bound to a variable, so that the plan holds it once.
    count = max(1, len(ranks) // BUCKET_PIECES)
    return F.get(F.transform(F.array(rank_table(ranks, count)), lambda table: _folded(word, table, count)), 0)


def _folded(word: Column, table: Column, count: int) -> Column:
    raw, n = word.cast("binary"), F.octet_length(word)
    pieces = F.transform(F.sequence(F.lit(1), n), lambda i: raw.substr(i, F.lit(1)))

    def rank_of(piece: Column) -> Column:
        return F.coalesce(F.element_at(F.get(table, (F.crc32(piece) % count).cast("int")), piece), F.lit(_NO_RANK))

    def start(p: Column) -> Column:
        return F.struct(p.alias("p"), F.transform(F.slice(p, 2, n), lambda x, i: rank_of(F.concat(F.get(p, i), x))).alias("r"))

    def merge(state: Column, _: Column) -> Column:
        p, r = state["p"], state["r"]
        at = F.array_position(r, F.array_min(r)).cast("int")  # from 1: pieces at and at + 1 become one

        def replaced(piece: Column) -> Column:
            before = F.when(at > 1, F.array(rank_of(F.concat(F.get(p, at - 2), piece))))
            after = F.when(at < F.size(r), F.array(rank_of(F.concat(piece, F.get(p, at + 1)))))
            none = F.array().cast("array<int>")
            return F.struct(
                F.concat(F.slice(p, 1, at - 1), F.array(piece), F.slice(p, at + 2, F.size(p))).alias("p"),
                F.concat(
                    F.slice(r, 1, F.greatest(at - 2, F.lit(0))), F.coalesce(before, none), F.coalesce(after, none),
                    F.slice(r, at + 2, F.size(r) + 1),
                ).alias("r"),
            )

        open_ = (F.size(r) > 0) & (F.array_min(r) < _NO_RANK)
        joined = F.concat(F.get(p, at - 1), F.get(p, at))
        return F.when(open_, F.get(F.transform(F.array(joined), replaced), 0)).otherwise(state)

    first = F.get(F.transform(F.array(pieces), start), 0)
    steps = F.slice(F.sequence(F.lit(1), n), 2, n)
    return F.aggregate(steps, first, merge, lambda s: F.transform(s["p"], rank_of))


class PairRanks:
    """Rank of the piece that two neighbouring pieces make, for arrays of their ids.

    An id is a rank.  The table is open-addressed with linear probing, so that a lookup touches one place in most cases.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        found = [(ranks[piece[:i]] << 32 | ranks[piece[i:]], rank) for piece, rank in ranks.items()
                 for i in range(1, len(piece)) if piece[:i] in ranks and piece[i:] in ranks]
        pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, _NO_RANK, dtype=np.int32)
        step = 0
        while len(pairs):
            at = self._place(pairs[:, 0], step)
            free = self.keys[at] == -1
            self.keys[at[free]], self.values[at[free]] = pairs[free, 0], pairs[free, 1]
            pairs = pairs[self.keys[at] != pairs[:, 0]]
            step += 1

    def _place(self, keys: np.ndarray, step: int) -> np.ndarray:
        spread = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)
        return (spread.astype(np.int64) + step) & (len(self.keys) - 1)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks; no rank where there is none or a side is -1."""
        keys = left.astype(np.int64) << 32 | right
        out = np.full(len(keys), _NO_RANK, dtype=np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        step = 0
        while len(open_):
            at = self._place(keys[open_], step)
            held = self.keys[at]
            hit = held == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (held != -1)]
            step += 1
        return out


class _Coder:
    """Ids of words in one Python worker: the head table, a bounded memo, and the merges.

    All words' ids lie in one array; a word is known by its place in it.
    """

    def __init__(self, ranks: dict[bytes, int], pairs: PairRanks, head: dict[str, tuple[int, ...]]) -> None:
        self.ranks, self.pairs, self.head = ranks, pairs, list(head)
        self.bytes = np.array([ranks.get(bytes([i]), -1) for i in range(256)], dtype=np.int32)
        self.index = {word: i for i, word in enumerate(head)}
        self.sizes = np.fromiter(map(len, head.values()), dtype=np.int64, count=len(head))
        self.flat = np.fromiter(chain.from_iterable(head.values()), dtype=np.int32, count=int(self.sizes.sum()))
        self._start()

    def _start(self) -> None:
        self.starts = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.sizes)])[:-1]

    def places(self, words: list[str]) -> np.ndarray:
        """Where the ids of distinct words are; new words are merged together first."""
        index = self.index
        known = np.fromiter((index.get(word, -1) for word in words), dtype=np.int64, count=len(words))
        new = np.flatnonzero(known < 0)
        if len(new):
            fresh = [words[i] for i in new]
            flat, sizes = self.merged([word.encode() for word in fresh])
            known[new] = len(index) + np.arange(len(new))
            index.update(zip(fresh, known[new].tolist(), strict=True))
            self.flat, self.sizes = np.concatenate([self.flat, flat]), np.concatenate([self.sizes, sizes])
            self._start()
        return known

    def forget(self, words: list[str]) -> None:
        """Keep the head and these words, the latest, if there are too many."""
        if len(self.index) > MEMO_WORDS:
            kept = self.head + [w for w in words if len(w) < 64 and self.index[w] >= len(self.head)]
            at = np.fromiter((self.index[w] for w in kept), dtype=np.int64, count=len(kept))
            self.flat, self.sizes = _gathered(self.flat, self.starts, self.sizes, at), self.sizes[at]
            self.index = {word: i for i, word in enumerate(kept)}
            self._start()

    def encoded(self, texts: pa.Array, split: Callable[[str], list[str]]) -> pa.Array:
        """Ids of every text, some texts at a time."""
        parts: list[pa.Array] = []
        for part in text_slices(pa.RecordBatch.from_arrays([texts], names=["t"]), "t", _SLICE_BYTES):
            place: defaultdict[str, int] = defaultdict(count().__next__)
            picked = []
            for value in part.column(0):
                words = split(value.as_py())
                picked.append(np.fromiter(map(place.__getitem__, words), dtype=np.int32, count=len(words)))
            distinct = list(place)
            known = self.places(distinct)
            lengths = np.fromiter(map(len, picked), dtype=np.int64, count=len(picked))
            order = known[np.concatenate(picked)]
            total = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.sizes[order])])
            ends = total[np.concatenate([[0], np.cumsum(lengths)])].astype(np.int32)
            ids = _gathered(self.flat, self.starts, self.sizes, order)
            parts.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, type=pa.int32())))
            self.forget(distinct)
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has."""
        alone = [self.ranks.get(raw, -1) for raw in words]
        width = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        width[np.array(alone, dtype=np.int64) >= 0] = 0
        long = width > _WIDEST
        width[long] = 0
        singly = np.flatnonzero(width == 0)
        single = [self._merged_long(words[i]) if long[i] else (alone[i],) for i in singly]
        order, sizes = [singly], [np.fromiter(map(len, single), dtype=np.int64, count=len(single))]
        flat = [np.fromiter(chain.from_iterable(single), dtype=np.int32, count=int(sizes[0].sum()))]
        # Words of similar length share a matrix.
        group = (width + 3) // 4
        for g in np.unique(group[width > 0]):
            rows = np.flatnonzero(group == g)
            step = max(1, _MATRIX_PARTS // (4 * int(g)))
            for part in (rows[i:i + step] for i in range(0, len(rows), step)):
                done = self._merge_matrix([words[i] for i in part], 4 * int(g))
                order.append(part)
                sizes.append((done >= 0).sum(axis=1))
                flat.append(done[done >= 0])
        back, all_sizes = np.argsort(np.concatenate(order)), np.concatenate(sizes)
        starts = np.concatenate([np.zeros(1, np.int64), np.cumsum(all_sizes)])[:-1]
        return _gathered(np.concatenate(flat), starts, all_sizes, back), all_sizes[back]

    def _merge_matrix(self, words: list[bytes], width: int) -> np.ndarray:
        """One word per row, padded with -1; every round merges the best pair of each word that has one."""
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(len(words), width)
        inside = np.arange(width) < np.fromiter(map(len, words), dtype=np.int64, count=len(words))[:, None]
        parts = np.where(inside, self.bytes[raw], -1).astype(np.int32)
        done = np.full(parts.shape, -1, dtype=np.int32)
        rows = np.arange(len(words))
        pairs = self.pairs.of(parts[:, :-1].ravel(), parts[:, 1:].ravel()).reshape(len(words), width - 1)
        while len(rows):
            at = pairs.argmin(axis=1)  # the first of equal ones
            best = pairs[np.arange(len(rows)), at]
            more = best != _NO_RANK
            if not more.all():
                done[rows[~more], :parts.shape[1]] = parts[~more]
                rows, parts, pairs, at, best = rows[more], parts[more], pairs[more], at[more], best[more]
                if not len(rows):
                    break
            here, columns = np.arange(len(rows)), np.arange(parts.shape[1] - 1)
            parts = np.take_along_axis(parts, columns + (columns > at[:, None]), axis=1)
            parts[here, at] = best
            if parts.shape[1] < 2:
                done[rows, :1] = parts
                break
            columns = columns[:-1]
            pairs = np.take_along_axis(pairs, columns + (columns >= at[:, None]), axis=1)
            before, after = at > 0, at < parts.shape[1] - 1
            pairs[here[before], at[before] - 1] = self.pairs.of(parts[here[before], at[before] - 1], best[before])
            pairs[here[after], at[after]] = self.pairs.of(best[after], parts[here[after], at[after] + 1])
        return done

    def _merged_long(self, raw: bytes) -> tuple[int, ...]:
        """The same merges for one very long word, with a heap and linked neighbours instead of scans."""
        import heapq

        ranks, n = self.ranks, len(raw)
        end = list(range(1, n + 1))  # end of the part that starts here; 0 once it is merged away
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue  # one of the two parts has changed since
            end[i], end[middle] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(raw[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if before[i] >= 0 and (r := ranks.get(raw[before[i]:stop])) is not None:
                heapq.heappush(heap, (r, before[i], stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[raw[i:end[i]]])
            i = end[i]
        return tuple(out)


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """Concatenate the picked stretches of ``flat``."""
    n = sizes[picked]
    total = int(n.sum())
    shift = np.repeat(starts[picked] - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else n, n)
    return flat[np.arange(total) + shift]


def head_table(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str, head_words: int, sample_rows: int) -> dict:
    """Ids of the most frequent distinct words of each partition's first ``sample_rows`` rows, folded by Spark."""

    @F.arrow_udf("array<string>")
    def words(texts: pa.Array) -> pa.Array:
        return pa.array([compiled(pattern).findall(t) for t in texts.to_pylist()], type=pa.list_(pa.string()))

    # The low bits are the row's number in its partition.  Texts stay in their tasks; only counts move.
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"), number.alias("at"))
    counts = rows.where(F.col("at") < sample_rows).select(F.explode(words("t")).alias("word")).groupBy("word").count()
    top = [r["word"] for r in counts.orderBy(F.desc("count"), "word").limit(head_words).collect()]
    spark = docs.sparkSession
    words_df = spark.createDataFrame([(w,) for w in top], "word string").repartition(spark.sparkContext.defaultParallelism)
    found = words_df.select("word", fold_words(F.col("word"), occurring(ranks, top)).alias("ids"))
    return {r["word"]: tuple(r["ids"]) for r in found.collect()}  # at most head_words rows


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, text: str = "text", head_words: int = HEAD_WORDS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Add ``ids``, the token ids of each whole text, without special tokens."""
    head = head_table(docs, ranks, pattern, text, head_words, sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast((ranks, PairRanks(ranks), head))
    name = uuid.uuid4().hex

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        coder = _STATE.get(name)
        if coder is None:
            _STATE.clear()
            coder = _STATE[name] = _Coder(*shared.value)
        return coder.encoded(texts, compiled(pattern).findall)

    return without(docs, "ids").withColumn("ids", encoded(F.coalesce(docs[text], F.lit(""))))


def decode(rows: DataFrame, ranks: dict[bytes, int], *, ids: str = "ids", output: str = "decoded") -> DataFrame:
    """Add ``output``, the bytes that the ids stand for."""
    pieces = sorted(ranks.items(), key=lambda item: item[1])
    sizes = np.zeros(pieces[-1][1] + 1 if pieces else 0, dtype=np.int64)
    for piece, rank in pieces:
        sizes[rank] = len(piece)
    table = (np.frombuffer(b"".join(p for p, _ in pieces), dtype=np.uint8), np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    shared = rows.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("binary")
    def decoded(column: pa.Array) -> pa.Array:
        flat, starts, sizes = shared.value
        out: list[pa.Array] = []
        for tokens in _token_slices(column):
            values = tokens.flatten().to_numpy(zero_copy_only=False)
            lengths = np.diff(tokens.offsets.to_numpy())
            raw = _gathered(flat, starts, sizes, values)
            total = np.concatenate([[0], np.cumsum(sizes[values])])
            ends = total[np.concatenate([[0], np.cumsum(lengths)])].astype(np.int32)
            out.append(pa.Array.from_buffers(pa.binary(), len(tokens), [None, pa.py_buffer(ends), pa.py_buffer(raw)]))
        return pa.concat_arrays(out) if out else pa.array([], pa.binary())

    tokens = F.coalesce(F.col(f"`{ids}`").cast("array<int>"), F.array().cast("array<int>"))
    return without(rows, output).withColumn(output, decoded(tokens))


def _token_slices(column: pa.Array, limit: int = _SLICE_BYTES) -> Iterator[pa.Array]:
    if column.nbytes <= limit or len(column) <= 1:
        if len(column):
            yield column
        return
    yield from _token_slices(column[:len(column) // 2], limit)
    yield from _token_slices(column[len(column) // 2:], limit)
