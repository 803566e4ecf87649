"""Language identification with a string kernel, Nyström landmarks and kernel ridge regression.

A text's blended spectrum is the set of all its runs of one to ``SPECTRUM`` bytes, A-Z
lower-cased and every other ASCII character that is no letter read as a space.  Such a run
fits a 32-bit number and is kept as one of ``2 ** BUCKET_BITS`` buckets of it.  The kernel
counts presence, not frequency: the buckets two texts share over the geometric mean of how
many each has.

Landmarks are ``per_language`` texts of every language.  A text becomes its kernel values
with the landmarks (one matrix product per batch of texts); the landmarks' own kernel
matrix, inverted at the square root, makes Nyström features of them, and a ridge regression
per language learns +1 for its texts and -1 for all others, with every language weighing the
same.  The fit needs only sums of products: each task adds up its own matrix and the driver
gets one per task.

Learning reads at most about ``max_rows`` rows, an equal share of every language, chosen by
hash; a language with fewer gives all.  Predicting reads every whole text, in
pieces of bounded size, and shuffles nothing.

Defined results: ``und`` and score 0 for a null text, a text without a letter, and all
texts where nothing could be learned.  Rows with a null language or id teach nothing.  Rows
that repeat count as often as they appear.  Of equally good languages the first by name
wins.  Columns of the input named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecloom.llm.common import fresh_name, text_slices, without
from vecloom.llm.textbytes import LOWER, utf8
from vecloom.sources.scratch import materialize

SPECTRUM, BUCKET_BITS = 4, 15
MAX_ROWS, PER_LANGUAGE, RIDGE, SEED = 20_000, 40, 1e-3, 13
UNKNOWN = "und"
_ROWS, _PIECE_BYTES, _SLICE_BYTES, _FIT_TASKS = 256, 1 << 20, 4_000_000, 16
_LETTER = r"\p{L}"
_BYTES = np.arange(256)
_READ = np.where((_BYTES >= 128) | ((LOWER >= 97) & (LOWER <= 122)), LOWER, 32).astype(np.uint32)


def buckets(runs: np.ndarray) -> np.ndarray:
    """Bucket of runs of bytes, the first byte lowest."""
    return (runs * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)


def spectra(texts: pa.Array) -> np.ndarray:
    """Presence of every bucket in every text, as a matrix of bytes."""
    data, offsets = utf8(texts)
    held = np.zeros((len(texts), 1 << BUCKET_BITS), dtype=np.uint8)
    flat = held.reshape(-1)
    for start in range(0, len(data), _PIECE_BYTES):
        stop = min(len(data), start + _PIECE_BYTES)
        piece = _READ[data[start:min(len(data), stop + SPECTRUM - 1)]]
        size = stop - start
        row = np.searchsorted(offsets, np.arange(start, stop, dtype=np.int64), side="right") - 1 if len(texts) > 1 else 0
        base = row << BUCKET_BITS if len(texts) > 1 else np.zeros(size, np.int64)
        left = (offsets[1:][row] if len(texts) > 1 else offsets[-1]) - np.arange(start, stop, dtype=np.int64)
        runs = piece[:size].copy()
        for n in range(1, SPECTRUM + 1):
            if n > 1:
                more = piece[n - 1:n - 1 + size]
                # A run that would leave its text stays the shorter one, which is there already.
                fits = left[:len(more)] >= n
                runs[:len(more)] |= np.where(fits, more << np.uint32(8 * (n - 1)), np.uint32(0))
            flat[base + buckets(runs)] = 1
    return held


def kernel(held: np.ndarray, landmarks: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Kernel of texts with landmarks, whose rows are scaled by the root of their size and cut to the ``used`` buckets."""
    sizes = held.sum(axis=1, dtype=np.int64)
    shared = held[:, used].astype(np.float32) @ landmarks.T
    return shared.astype(np.float64) / np.sqrt(np.maximum(sizes, 1))[:, None]


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order, landmarks over the buckets they use, and weights of their kernel values and a constant."""

    languages: tuple[str, ...]
    landmarks: np.ndarray
    used: np.ndarray
    weights: np.ndarray

    def scores(self, texts: pa.Array) -> np.ndarray:
        values = kernel(spectra(texts), self.landmarks, self.used)
        return values @ self.weights[:-1] + self.weights[-1]


def _blocks(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Few enough rows for a presence matrix, and little enough text."""
    for start in range(0, batch.num_rows, _ROWS):
        yield from text_slices(batch.slice(start, _ROWS), text, _SLICE_BYTES)


def held_out(doc_id: str | Column = "doc_id", folds: int = 4, remainder: int = 2) -> Column:
    """Whether the crc32 of the id as text has this remainder; false for null."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds == remainder, F.lit(False))


def _sample(docs: DataFrame, doc_id: str, text: str, lang: str, max_rows: int, seed: int) -> tuple[DataFrame, dict[str, int]]:
    """About ``max_rows`` rows (lang, text, draw) to learn from, and how many there are of each language."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    rows = rows.where(F.col("id").isNotNull() & ~held_out("id") & F.col("lang").isNotNull() & F.col("text").rlike(_LETTER))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    quota = max(1, max_rows // max(1, len(counts)))
    share = F.lit(1.0)
    for name, n in counts.items():
        if n > quota:
            share = F.when(F.col("lang") == name, quota / n).otherwise(share)
    draw = F.xxhash64(F.col("id").cast("string"), F.lit(seed))
    rows = rows.select("lang", "text", draw.alias("draw")).where(F.pmod("draw", F.lit(1 << 30)) < share * (1 << 30))
    return materialize(rows.repartition(_FIT_TASKS, "draw"), "language-sample"), counts


def _landmarks(sample: DataFrame, per_language: int) -> np.ndarray:
    """Presence rows of the first texts of every language by their draw."""
    first = Window.partitionBy("lang").orderBy("draw", F.xxhash64("text"))
    chosen = sample.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= per_language)

    def spectrum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _blocks(batch, "text"):
                packed = np.packbits(spectra(part.column("text")), axis=1)
                yield pa.record_batch({"lang": part.column("lang"), "nth": part.column("nth"),
                                       "held": pa.array([row.tobytes() for row in packed], pa.binary())})

    rows = chosen.mapInArrow(spectrum, "lang string, nth int, held binary").toArrow()  # per_language rows of 4 KB each
    rows = rows.sort_by([("lang", "ascending"), ("nth", "ascending")])
    packed = np.array([np.frombuffer(b, dtype=np.uint8) for b in rows.column("held").to_pylist()])
    return np.unpackbits(packed, axis=1)


def _ridge(own: np.ndarray, products: np.ndarray, targets: np.ndarray, ridge: float) -> np.ndarray:
    """Weights of kernel values and constant, from the landmarks' kernel and the weighted sums of products."""
    values, vectors = np.linalg.eigh(own)
    kept = values > 1e-6 * values.max()
    m = len(own)
    change = np.zeros((m + 1, int(kept.sum()) + 1))  # kernel values to Nyström features; the constant stays
    change[:m, :-1], change[m, -1] = vectors[:, kept] / np.sqrt(values[kept]), 1.0
    gram = change.T @ products @ change + ridge * products[m, m] * np.eye(change.shape[1])
    return change @ np.linalg.solve(gram, change.T @ targets)


def fit_language(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", max_rows: int = MAX_ROWS,
                 per_language: int = PER_LANGUAGE, ridge: float = RIDGE, seed: int = SEED) -> LanguageModel:
    """Learn from rows outside the held-out quarter whose language is known."""
    sample, counts = _sample(docs, doc_id, text, lang, max_rows, seed)
    names = tuple(sorted(counts))
    if not names:
        return LanguageModel((), np.zeros((0, 0), np.float32), np.zeros(0, np.int64), np.zeros((1, 0)))
    held = _landmarks(sample, per_language)
    used = np.flatnonzero(held.any(axis=0))
    landmarks = (held[:, used] / np.sqrt(np.maximum(held.sum(axis=1), 1))[:, None]).astype(np.float32)
    quota = max(1, max_rows // len(names))
    weight = {name: 1.0 / min(quota, counts[name]) for name in names}
    shared = docs.sparkSession.sparkContext.broadcast((names, weight, landmarks, used))
    m = len(landmarks)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weight, landmarks, used = shared.value
        products, targets = np.zeros((m + 1, m + 1)), np.zeros((m + 1, len(names)))
        for batch in batches:
            for part in _blocks(batch, "text"):
                langs = part.column("lang").to_pylist()
                values = kernel(spectra(part.column("text")), landmarks, used)
                values = np.concatenate([values, np.ones((len(values), 1))], axis=1)
                scaled = values * np.array([weight[name] for name in langs])[:, None]
                products += scaled.T @ values
                targets += scaled.T @ np.where(np.array(langs, dtype=object)[:, None] == np.array(names, dtype=object), 1.0, -1.0)
        yield pa.record_batch({"products": [products.tobytes()], "targets": [targets.tobytes()]})

    sums = sample.select("lang", "text").mapInArrow(add_up, "products binary, targets binary").toArrow()  # a row per task
    products, targets = (
        sum((np.frombuffer(b) for b in sums.column(c).to_pylist()), np.zeros(size)).reshape(m + 1, -1)
        for c, size in (("products", (m + 1) ** 2), ("targets", (m + 1) * len(names)))
    )
    return LanguageModel(names, landmarks, used, _ridge(kernel(held, landmarks, used), products, targets, ridge))


def predict_language(docs: DataFrame, model: LanguageModel, *, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1: 0.5 where the best language is as likely as not) to every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def judge(texts: pa.Array) -> pa.Array:
        model = shared.value
        best, score = [np.zeros(0, np.int64)], [np.zeros(0)]
        for part in _blocks(pa.RecordBatch.from_arrays([texts], names=["t"]), "t"):
            values = model.scores(part.column(0))
            best.append(values.argmax(axis=1))
            score.append(np.clip((1 + values.max(axis=1)) / 2, 0.0, 1.0))
        names = pa.array(model.languages, pa.string()).take(pa.array(np.concatenate(best)))
        return pa.StructArray.from_arrays([names, pa.array(np.concatenate(score))], names=["lang_pred", "score"])

    judged, letters = fresh_name(docs, "judged"), F.coalesce(F.col(f"`{text}`").rlike(_LETTER), F.lit(False))
    rows = without(docs, *({"lang_pred", "score"} - {text.lower()}))
    others = [F.col(f"`{c}`") for c in rows.columns if c.lower() not in ("lang_pred", "score")]
    if not model.languages:
        return rows.select(*others, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    rows = rows.withColumn(judged, judge(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    return rows.select(
        *others,
        F.when(letters, F.col(f"{judged}.lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(letters, F.col(f"{judged}.score")).otherwise(0.0).alias("score"),
    )
