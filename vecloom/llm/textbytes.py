"""Words, shingles and counts of whole text batches, in NumPy over their UTF-8 bytes.

A word is a maximal run of ASCII letters, digits, ``_`` and non-ASCII characters,
with A-Z lower-cased.  Everything works on one Arrow array at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BYTES = np.arange(256, dtype=np.uint8)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
LOWER = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)
WORD = (_BYTES >= 128) | _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | ((_BYTES >= 48) & (_BYTES <= 57)) | (_BYTES == 95)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all bits depend on all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow string array in a row, and where each text starts and ends.  Nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, dtype=width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def run_edges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; no run crosses from one text to the next."""
    n = len(inside)
    before = np.zeros(n + 1, dtype=bool)
    before[1:] = inside
    after = np.zeros(n + 1, dtype=bool)
    after[:n] = inside
    edges = offsets[(offsets > 0) & (offsets < n)]
    starts, ends = after & ~before, before & ~after
    starts[edges] |= after[edges]
    ends[edges] |= before[edges]
    return np.flatnonzero(starts), np.flatnonzero(ends)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and the number of words up to each text's start."""
    inside = WORD[data]
    starts, ends = run_edges(inside, offsets)
    firsts = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), firsts
    lengths = ends - starts
    powers = np.cumprod(np.full(int(lengths.max()), _BASE, dtype=np.uint64))
    runs = np.concatenate([[0], np.cumsum(lengths)])
    within = np.arange(runs[-1]) - np.repeat(runs[:-1], lengths)
    letters = LOWER[data[inside]].astype(np.uint64) + np.uint64(1)
    return mixed(np.add.reduceat(letters * powers[within], runs[:-1])), firsts


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``k`` words.

    A text of one to ``k - 1`` words has one shingle, all of it; one without words has none.
    """
    data, offsets = utf8(texts)
    words, firsts = word_hashes(data, offsets)
    keys = mixed(np.arange(1, k + 1, dtype=np.uint64) * _BASE) | np.uint64(1)
    n = len(words) - k + 1
    if n > 0:
        runs = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            runs += words[j:j + n] * keys[j]
        runs = mixed(runs)
    out = []
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(runs[a:b - k + 1]))
        elif b > a:
            out.append(mixed(np.sum(words[a:b] * keys[:b - a], keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
