"""Filtered approximate search over cells that know their attributes.

An index of cells (see :mod:`vecloom.operators.ann`) is stored with a summary per cell: how many rows
it has, and of every attribute the smallest and largest value and, where there are few, how
often each value occurs.  A search with conditions on attributes first asks the summaries,
a table of one row per cell: cells that can not hold a match are skipped before their files
are read, as cells are partitions, and the conditions go to the scan of the others.

The summaries also say about how many matches a cell holds, exactly so for one condition on
counted values.  A query takes its nearest cells until they promise ``least_rows`` matches
and number at least ``probes``, so a rare value is searched in more cells than a common one.
What is found is scored exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecloom.functions import kernels
from vecloom.operators.ann import ZERO_CELL, build_ivf, load_ivf
from vecloom.operators.graph import usable
from vecloom.operators.knn import DEFAULT_LIMITS, KnnLimits, cell_topk
from vecloom.operators.search import guarded_vector, query_model

MAX_VALUES = 64


@dataclass(frozen=True)
class Condition:
    """``column`` is one of ``values``, or lies between ``low`` and ``high`` (either may be open, both are included)."""

    column: str
    values: tuple[Any, ...] | None = None
    low: Any = None
    high: Any = None

    def __post_init__(self) -> None:
        if (self.values is None) == (self.low is None and self.high is None):
            raise ValueError("give either values or bounds")

    def holds(self) -> Column:
        """The condition on a row."""
        column = F.col(self.column)
        if self.values is not None:
            return column.isin(*self.values) if self.values else F.lit(False)
        tests = [column >= self.low] * (self.low is not None) + [column <= self.high] * (self.high is not None)
        return reduce(lambda a, b: a & b, tests)

    def share(self, cell: dict[str, Any]) -> float:
        """About which share of a cell's rows fulfils it; 0 only if none can."""
        low, high, counts = cell["low"], cell["high"], cell["counts"]
        if low is None:
            return 0.0
        if counts is not None:
            return sum(n for value, n in counts.items() if self.fits(value)) / cell["rows"]
        if self.values is not None:
            inside = [v for v in self.values if v is not None and low <= v <= high]
            return min(1.0, len(inside) / MAX_VALUES)
        if (self.low is not None and self.low > high) or (self.high is not None and self.high < low):
            return 0.0
        try:
            start = low if self.low is None else max(low, self.low)
            end = high if self.high is None else min(high, self.high)
            return max(1e-3, float((end - start) / (high - low))) if high > low else 1.0
        except TypeError:
            return 0.5  # values without differences, such as texts

    def fits(self, value: Any) -> bool:
        if self.values is not None:
            return value in self.values
        return (self.low is None or value >= self.low) and (self.high is None or value <= self.high)


@dataclass(frozen=True)
class FilteredIndex:
    """Rows by cell, centroids, and per cell its number of rows and per attribute low, high and counts of values."""

    docs: DataFrame
    centroids: np.ndarray
    summaries: dict[int, dict[str, Any]]


def summarize(docs: DataFrame, attributes: Sequence[str], max_values: int = MAX_VALUES) -> DataFrame:
    """One row per cell: rows, and per attribute its low, high and (for at most ``max_values`` values) counts.

    Values are counted inside each task first; of a cell with too many only ``max_values + 1`` are kept, to know that.
    """
    bounds = [agg(a).alias(f"{a}_{name}") for a in attributes for agg, name in ((F.min, "low"), (F.max, "high"))]
    summary = docs.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), *bounds)
    for a in attributes:
        seen = docs.filter(F.col(a).isNotNull()).groupBy("cell", F.col(a).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        some = seen.withColumn("nth", F.row_number().over(Window.partitionBy("cell").orderBy("value")))
        some = some.filter(F.col("nth") <= max_values + 1)
        counts = F.map_from_entries(F.collect_list(F.struct("value", "n")))
        listed = some.groupBy("cell").agg(F.count(F.lit(1)).alias("kinds"), counts.alias("counts"))
        few = F.when(F.col("kinds") <= max_values, F.col("counts")).alias(f"{a}_counts")
        summary = summary.join(listed.select("cell", few), "cell", "left")
    return summary


def build_filtered(docs: DataFrame, path: str, attributes: Sequence[str], cells: int | None = None, *,
                   max_values: int = MAX_VALUES, **named) -> None:
    """Write rows by cell, centroids and summaries; further arguments are those of :func:`ann.build_ivf`."""
    build_ivf(docs, path, cells, **named)
    stored = docs.sparkSession.read.parquet(f"{path}/docs").select("cell", *attributes)
    summarize(stored, attributes, max_values).write.mode("overwrite").parquet(f"{path}/summaries")


def load_filtered(spark: SparkSession, path: str) -> FilteredIndex:
    docs, centroids = load_ivf(spark, path)
    summaries: dict[int, dict[str, Any]] = {}
    for row in spark.read.parquet(f"{path}/summaries").collect():  # one row per cell
        names = {c.rsplit("_", 1)[0] for c in row.asDict() if c.endswith("_low")}
        found = {a: {"rows": row["rows"], "low": row[f"{a}_low"], "high": row[f"{a}_high"], "counts": row[f"{a}_counts"]} for a in names}
        summaries[row["cell"]] = {"rows": row["rows"], "attributes": found}
    return FilteredIndex(docs, centroids, summaries)


def matches(index: FilteredIndex, where: Sequence[Condition]) -> dict[int, float]:
    """Cells that may hold a match, and about how many they hold."""
    found = {}
    for cell, summary in index.summaries.items():
        # An attribute without a summary rules nothing out.
        shares = [c.share(summary["attributes"][c.column]) for c in where if c.column in summary["attributes"]]
        if all(shares):
            found[cell] = float(summary["rows"] * np.prod(shares, initial=1.0))
    return found


def promising_cells(vec: str, centroids: np.ndarray, cells: list[int], expected: list[float], probes: int, least_rows: float) -> Column:
    """Per vector its nearest cells until they promise ``least_rows`` rows, ``probes`` at least."""
    unit = kernels.unit_rows(np.asarray(centroids, dtype=np.float64)[cells])
    shared = SparkSession.active().sparkContext.broadcast((unit, np.array(cells, dtype=np.int32), np.array(expected)))

    @F.arrow_udf("array<int>")
    def near(batch: pa.Array) -> pa.Array:
        unit, cells, expected = shared.value
        matrix, present, _ = kernels.pack(batch, unit.shape[1])
        order = np.argsort(-(kernels.unit_rows(matrix) @ unit.T), axis=1, kind="stable")
        promised = np.cumsum(expected[order], axis=1) - expected[order]  # before each cell
        taken = (promised < least_rows) | (np.arange(len(cells)) < probes)
        ends = np.concatenate([[0], np.cumsum(taken.sum(axis=1))]).astype(np.int32)
        rows = pa.ListArray.from_arrays(pa.array(ends), pa.array(cells[order][taken]))
        return pc.if_else(pa.array(present), rows, pa.scalar(None, rows.type))

    return near(F.col(vec))


def search_where(queries: DataFrame, index: FilteredIndex, where: Sequence[Condition], k: int, *, probes: int = 4,
                 least_rows: float | None = None, query_id: str = "q", doc_id: str = "id", vec_col: str = "embedding",
                 limits: KnnLimits = DEFAULT_LIMITS) -> DataFrame:
    """Top ``k`` rows that fulfil all conditions, among each query's promising cells: q, id, score, rank.

    ``least_rows`` is 20 times ``k`` unless given.  Zero queries have no near cells and are left out.
    """
    found = matches(index, where)
    kept = [F.col("cell").isin(sorted(found)), *[c.holds() for c in where]]
    docs = index.docs.filter(reduce(lambda a, b: a & b, kept))
    docs = docs.withColumn(vec_col, guarded_vector(docs, vec_col, query_model(queries, docs)))
    asked = queries.filter(usable(vec_col)).select(F.col(query_id).alias("q"), F.col(vec_col).alias("vec"))
    cells = sorted(c for c in found if c != ZERO_CELL)
    named = F.array().cast("array<int>")
    if cells:
        rows = 20 * k if least_rows is None else least_rows
        named = promising_cells("vec", index.centroids, cells, [found[c] for c in cells], probes, rows)
    if ZERO_CELL in found:
        named = F.concat(named, F.array(F.lit(ZERO_CELL)))
    d = docs.select("cell", F.col(doc_id).alias("id"), F.col(vec_col).alias("vec"))
    return cell_topk(asked.select("q", F.explode(named).alias("cell"), "vec"), d, k, limits)
