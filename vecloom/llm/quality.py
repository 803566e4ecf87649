"""Quality classifier: a sparse rule ensemble.

1. Statistics of every whole text, counted in NumPy over Arrow batches.
2. A small random forest on labelled rows; every path from a root to a node becomes
   a conjunctive rule over the statistics.
3. A lasso (L1) logistic regression over the rules' truth values; most weights
   become zero and their rules go.
4. The remaining rules are compiled into one Spark column expression.

Only labelled rows are used for fitting, at most ``max_rows`` of them, chosen by a hash
of their id; this bound concerns the fit alone.  Their statistics (``max_rows`` times
``len(STATS)`` numbers, 3 MB by default) are fitted in NumPy on the driver, which spares
hundreds of tiny jobs.  Scores use the text and nothing else.

Defined results: a null text scores like an empty one.  Rows with a null id or a null
label are not learned from.  If no labels of both kinds are left, every score is 0.5.
Columns of the input named like the results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import fresh_name, text_slices, without
from vecloom.llm.textbytes import WORD, run_edges, utf8, word_hashes

MAX_ROWS, TREES, DEPTH, LASSO, KEEP_SCORE, SEED = 20_000, 12, 3, 0.001, 0.3, 5

STATS = (
    "log_chars", "words", "word_length", "word_share", "upper_share", "digit_share", "symbol_share", "bars", "bangs", "stops",
    "line_length", "short_lines", "ended_lines", "repeated_lines", "upper_lines", "distinct_words", "doubled_words", "long_words",
)


def _mask(chars: str) -> np.ndarray:
    return np.isin(np.arange(256), [ord(c) for c in chars])


_CODE = (np.arange(256) & 0xC0) != 0x80  # bytes that start a code point
_SPACE, _STOP = _mask(" \t\n\v\f\r"), _mask(".!?")
_UPPER, _LOWER = _mask("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _mask("abcdefghijklmnopqrstuvwxyz")
_DIGIT, _SYMBOL = _mask("0123456789"), _mask("#$%&*+/<=>@[\\]^_`{|}~")


def text_stats(texts: pa.Array) -> np.ndarray:
    """One row of ``STATS`` per text."""
    data, offsets = utf8(texts)
    n = len(offsets) - 1

    def counts(flags: np.ndarray, bounds: np.ndarray = offsets) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (total[bounds[1:]] - total[bounds[:-1]]).astype(np.float64)

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return part / np.maximum(whole, 1.0)

    chars = counts(_CODE[data])
    space = _SPACE[data]
    starts, ends = run_edges(~space, offsets)
    at = np.searchsorted(starts, offsets)
    tokens = np.diff(at).astype(np.float64)
    upper, lower = counts(_UPPER[data]), counts(_LOWER[data])

    # Lines: each text has one more than it has line feeds.
    feeds = np.flatnonzero(data == 10)
    edges = np.sort(np.concatenate([offsets[:-1], feeds + 1])) if n else np.zeros(0, np.int64)
    # A feed that ends a text makes an empty line where the next text starts; owners are dealt by count, in order.
    owner = np.repeat(np.arange(n), (np.diff(np.searchsorted(feeds, offsets)) + 1))
    bounds = np.concatenate([edges, [len(data)]]).astype(np.int64)
    wide = counts(_CODE[data], bounds)
    inked = counts(~space, bounds) > 0
    shouting = share(counts(_UPPER[data], bounds), counts(_UPPER[data], bounds) + counts(_LOWER[data], bounds)) > 0.6
    closing = np.zeros(len(edges), dtype=bool)
    if len(data):
        last = np.maximum(bounds[1:] - 1, 0)
        closing = _STOP[data[np.where(data[last] == 10, np.maximum(last - 1, 0), last)]]

    def lines(flags: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=flags, minlength=n)[:n]

    full = lines(inked)
    words, firsts = word_hashes(data, offsets)
    distinct = np.array([len(np.unique(words[a:b])) for a, b in zip(firsts[:-1], firsts[1:], strict=True)], dtype=np.float64)
    # A line is known by its words.
    line_at = np.searchsorted(run_edges(WORD[data], offsets)[0], bounds)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * np.uint64(3), dtype=np.uint64)])
    content = sums[line_at[1:]] - sums[line_at[:-1]]
    pairs = np.stack([owner.astype(np.uint64), content], axis=1)[inked] if len(edges) else np.zeros((0, 2), np.uint64)
    kept = np.unique(pairs, axis=0) if len(pairs) else pairs
    unique_lines = np.bincount(kept[:, 0].astype(np.int64), minlength=n)[:n].astype(np.float64)
    n_words = np.diff(firsts).astype(np.float64)
    doubled = np.zeros(len(words), dtype=bool)
    doubled[1:] = words[1:] == words[:-1]
    doubled[firsts[:-1][firsts[:-1] < len(words)]] = False
    return np.stack([
        np.log1p(chars), np.log1p(tokens), share(counts(~space & _CODE[data]), tokens), share(n_words, tokens),
        share(upper, upper + lower), share(counts(_DIGIT[data]), chars), share(counts(_SYMBOL[data]), chars),
        share(counts(data == ord("|")), tokens), share(counts(data == ord("!")), tokens), share(counts(_STOP[data]), tokens),
        np.log1p(share(lines(wide), full)), share(lines(inked & (wide < 30)), full), share(lines(inked & closing), full),
        1 - share(unique_lines, full), share(lines(inked & shouting), full), share(distinct, n_words),
        share(counts(doubled, firsts), n_words), share(counts(ends - starts > 16, at), tokens),
    ], axis=1)


def with_stats(docs: DataFrame, text: str = "text", name: str = "__stats") -> DataFrame:
    """Add the statistics as a struct column."""
    fields = pa.struct([pa.field(s, pa.float64()) for s in STATS])

    @F.arrow_udf("struct<" + ",".join(f"{s}:double" for s in STATS) + ">")
    def measure(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        parts = [text_stats(b.column(0)) for b in text_slices(batch, "text")]
        table = np.concatenate(parts) if parts else np.zeros((0, len(STATS)))
        return pa.StructArray.from_arrays([pa.array(c) for c in table.T.copy()], fields=list(fields))

    return docs.withColumn(name, measure(F.coalesce(F.col(f"`{text}`"), F.lit(""))))


@dataclass(frozen=True)
class Rule:
    """All of ``(statistic, is_at_most, threshold)`` hold; worth ``weight`` in log-odds."""

    tests: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def column(self, stats: str = "__stats") -> Column:
        held = F.lit(True)
        for name, at_most, bound in self.tests:
            value = F.col(f"{stats}.{name}")
            held = held & ((value <= bound) if at_most else (value > bound))
        return held

    def truth(self, stats: np.ndarray) -> np.ndarray:
        held = np.ones(len(stats), dtype=bool)
        for name, at_most, bound in self.tests:
            value = stats[:, STATS.index(name)]
            held &= (value <= bound) if at_most else (value > bound)
        return held


@dataclass(frozen=True)
class RuleEnsemble:
    """Intercept and weighted rules."""

    intercept: float
    rules: tuple[Rule, ...]

    def score(self, stats: str = "__stats") -> Column:
        """Probability of a good label as one column expression, 0 to 1."""
        total = F.lit(self.intercept)
        for rule in self.rules:
            total = total + F.when(rule.column(stats), rule.weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _best_split(x: np.ndarray, y: np.ndarray, features: np.ndarray, bins: int = 48) -> tuple[int, float] | None:
    """The feature and threshold (one of its quantiles) that lower the Gini impurity most."""
    best, found = 1e-9, None
    n, good = len(y), y.sum()
    impurity = good * (n - good) / n
    for f in features:
        for bound in np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 2)[1:-1], method="lower")):
            left = x[:, f] <= bound
            m = int(left.sum())
            if 0 < m < n:
                g = y[left].sum()
                gain = impurity - g * (m - g) / m - (good - g) * (n - m - good + g) / (n - m)
                if gain > best:
                    best, found = gain, (int(f), float(bound))
    return found


def forest_rules(x: np.ndarray, y: np.ndarray, trees: int, depth: int, seed: int) -> list[Rule]:
    """Grow trees on bootstrap samples with half of the statistics per split; every path is a rule, once."""
    rng = np.random.default_rng(seed)
    found: dict[tuple, None] = {}

    def grow(rows: np.ndarray, path: dict[tuple[str, bool], float], left: int) -> None:
        if path:
            found[tuple(sorted((name, at_most, bound) for (name, at_most), bound in path.items()))] = None
        if not left or len(rows) < 20:
            return
        features = rng.choice(x.shape[1], size=(x.shape[1] + 1) // 2, replace=False)
        split = _best_split(x[rows], y[rows], features)
        if split is None:
            return
        f, bound = split
        below = x[rows, f] <= bound
        for at_most, part in ((True, rows[below]), (False, rows[~below])):
            key = (STATS[f], at_most)
            tight = min(path.get(key, bound), bound) if at_most else max(path.get(key, bound), bound)
            grow(part, path | {key: tight}, left - 1)

    for _ in range(trees):
        grow(rng.integers(0, len(y), len(y)), {}, depth)
    return [Rule(tests) for tests in found]


def lasso_weights(truths: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and L1-penalised logistic weights, by accelerated proximal gradient steps."""
    n, m = truths.shape
    design = np.concatenate([np.ones((n, 1)), truths], axis=1)
    vector = np.ones(m + 1)
    for _ in range(30):  # power iteration for the curvature bound
        vector = design.T @ (design @ vector)
        vector /= np.linalg.norm(vector)
    rate = 4.0 * n / float(vector @ (design.T @ (design @ vector)) * 1.01)
    weights, ahead, momentum = np.zeros(m + 1), np.zeros(m + 1), 1.0
    for _ in range(steps):
        slope = design.T @ (1 / (1 + np.exp(-np.clip(design @ ahead, -60, 60))) - y) / n
        moved = ahead - rate * slope
        moved[1:] = np.sign(moved[1:]) * np.maximum(np.abs(moved[1:]) - rate * penalty, 0.0)
        faster = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = moved + (momentum - 1) / faster * (moved - weights)
        weights, momentum = moved, faster
    return float(weights[0]), weights[1:]


def held_out(doc_id: str | Column = "doc_id", folds: int = 5) -> Column:
    """Whether the crc32 of the id as text is divisible by ``folds``; false for null."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit_rules(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
    max_rows: int = MAX_ROWS, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO, seed: int = SEED,
) -> RuleEnsemble:
    """Learn from labelled rows outside the held-out fifth."""
    usable = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("label"))
    usable = usable.where(~held_out("__id") & F.col("label").isin(0, 1) & F.col("__id").isNotNull())
    chosen = usable.orderBy(F.xxhash64("__id", F.lit(seed)), "__id").limit(max_rows)  # two narrow columns, bounded
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    sample = texts.join(F.broadcast(chosen), F.col("id") == F.col("__id")).select("id", "text", "label")
    held = with_stats(sample).select("id", "label", *[F.col(f"__stats.{s}").alias(s) for s in STATS]).toArrow()
    held = held.sort_by("id")  # at most max_rows rows of numbers
    y = held.column("label").to_numpy().astype(np.float64)
    if len(np.unique(y)) < 2:
        return RuleEnsemble(0.0, ())
    x = np.stack([held.column(s).to_numpy() for s in STATS], axis=1)
    rules = forest_rules(x, y, trees, depth, seed)
    truths = np.stack([r.truth(x) for r in rules], axis=1).astype(np.float64) if rules else np.zeros((len(y), 0))
    intercept, weights = lasso_weights(truths, y, lasso)
    return RuleEnsemble(intercept, tuple(Rule(r.tests, float(w)) for r, w in zip(rules, weights, strict=True) if w))


def score_quality(docs: DataFrame, model: RuleEnsemble, *, text: str = "text", keep_score: float = KEEP_SCORE) -> DataFrame:
    """Add ``score`` and ``predicted`` (1 from ``keep_score`` on) to every row."""
    own = without(docs, "score", "predicted")
    stats = fresh_name(own, "__stats")
    scored = with_stats(own, text, stats).withColumn("score", model.score(stats))
    return scored.withColumn("predicted", (F.col("score") >= keep_score).cast("int")).drop(stats)


def keep_good(docs: DataFrame, model: RuleEnsemble, *, text: str = "text", keep_score: float = KEEP_SCORE) -> DataFrame:
    """The documents that are not rejected, with the columns they had."""
    stats = fresh_name(docs, "__stats")
    return with_stats(docs, text, stats).where(model.score(stats) >= keep_score).select(*[F.col(f"`{c}`") for c in docs.columns])
