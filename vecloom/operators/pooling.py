"""Pooling: one vector per group from the vectors of its members."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SUM, _WEIGHT = "_pool_sum", "_pool_weight"


def _same_as_before(column: pa.Array) -> np.ndarray:
    """Whether each value of a sorted column, from the second on, equals the one before, as a grouping sees it."""
    one, other = column[1:], column[:-1]
    if pa.types.is_nested(column.type):
        values = column.to_pylist()
        return np.array([a == b for a, b in zip(values[1:], values[:-1])], dtype=bool)
    same = pc.or_(pc.fill_null(pc.equal(one, other), False), pc.and_(one.is_null(), other.is_null()))
    if pa.types.is_floating(column.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(one), pc.is_nan(other)), False))
    return same.to_numpy(zero_copy_only=False)


def _groups(rows: pa.Table, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of every row's group, and the first row of every group; rows are sorted by group."""
    new = np.ones(rows.num_rows, dtype=bool)
    if keys:
        new[1:] = ~np.all([_same_as_before(rows.column(k).combine_chunks()) for k in keys], axis=0)
    else:
        new[1:] = False
    return np.cumsum(new) - 1, np.flatnonzero(new)


def _added(group: np.ndarray, groups: int, lists: pa.Array, *weights: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Per group the longest list, and for each array of weights (one per element) its sums by group and position."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    longest = np.zeros(groups, dtype=np.int64)
    np.maximum.at(longest, group, sizes)
    # Sums of all groups lie in a row, each as long as its longest list.
    first = np.concatenate([[0], np.cumsum(longest)])
    start = np.repeat(np.concatenate([[0], np.cumsum(sizes)])[:-1], sizes)
    at = np.repeat(first[group], sizes) + np.arange(len(start)) - start
    return first, [np.bincount(at, weights=w, minlength=int(first[-1])) for w in weights]


def _lists(first: np.ndarray, values: np.ndarray, known: np.ndarray, kind: pa.DataType) -> pa.Array:
    rows = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values).cast(kind, safe=False))
    return pc.if_else(pa.array(known), rows, pa.scalar(None, rows.type))


def _known(group: np.ndarray, groups: int, lists: pa.Array) -> np.ndarray:
    return np.bincount(group, weights=lists.is_valid().to_numpy(zero_copy_only=False), minlength=groups) > 0


def _partial(keys: list[str], vec: str, weight: str):
    """Weighted sums of whole vectors per group of an Arrow batch."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            sortable = [(k, "ascending") for k in keys if not pa.types.is_nested(rows.schema.field(k).type)]
            if sortable:  # rows of a group side by side; those that are not are added after the shuffle
                rows = rows.take(pc.sort_indices(rows, sort_keys=sortable))
            group, first_rows = _groups(rows, keys)
            lists = rows.column(vec).combine_chunks()
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            shares = pc.fill_null(rows.column(weight), 0.0).to_numpy()
            per_element = np.repeat(shares, sizes)
            values = pc.fill_null(lists.flatten(), 0.0).to_numpy(zero_copy_only=False).astype(np.float64)
            first, (sums, weights) = _added(group, len(first_rows), lists, values * per_element, per_element)
            known = _known(group, len(first_rows), lists)
            out = rows.select(keys).take(pa.array(first_rows))
            out = out.append_column(_SUM, _lists(first, sums, known, pa.float64()))
            yield from out.append_column(_WEIGHT, _lists(first, weights, known, pa.float64())).to_batches()

    return add


def _total(keys: list[str], out_col: str):
    """Means of the groups; rows arrive sorted by group, and a group may span batches."""

    def merged(rows: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        group, first_rows = _groups(rows, keys)
        sums, weights = (rows.column(c).combine_chunks() for c in (_SUM, _WEIGHT))
        flat = (x.flatten().to_numpy(zero_copy_only=False) for x in (sums, weights))
        first, (total, weight) = _added(group, len(first_rows), sums, *flat)
        return rows.select(keys).take(pa.array(first_rows)), first, total, weight, _known(group, len(first_rows), sums)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def means(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            names, first, total, weight, known = merged(rows)
            mean = _lists(first, total / np.maximum(weight, 1e-9), known, pa.float32())
            yield from names.append_column(out_col, mean).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
            _, first_rows = _groups(rows, keys)
            if len(first_rows) > 1:
                yield from means(rows.slice(0, first_rows[-1]).combine_chunks())
            names, first, total, weight, known = merged(rows.slice(first_rows[-1]).combine_chunks())
            held = names.append_column(_SUM, _lists(first, total, known, pa.float64()))
            held = held.append_column(_WEIGHT, _lists(first, weight, known, pa.float64())).cast(rows.schema)
        if held is not None:
            yield from means(held.combine_chunks())

    return finish


def mean_pool(df: DataFrame, group, vec_col: str, mask=None, out_col: str = "embedding") -> DataFrame:
    """Masked mean vector per group: ``sum(mask*v) / max(sum(mask), 1e-9)``.

    Whole vectors are added up: every Arrow batch becomes one row per group, with
    sums and weights by position, and after the shuffle the rows of a group
    are added as they stream by, so that a group of any size costs a task two
    vectors.  Elements are never rows of a plan.  A NULL element adds nothing but counts in
    its position's weight; a NULL mask counts as 0.  A group without any vector gets NULL.
    """
    keys = [F.col(g) if isinstance(g, str) else g for g in ([group] if isinstance(group, (str, Column)) else group)]
    weight = F.lit(1.0) if mask is None else (mask if isinstance(mask, Column) else F.col(mask)).cast("double")
    rows = df.select(*keys, F.col(vec_col).alias("_pool_vec"), weight.alias("_pool_mask"))
    names = rows.columns[:-2]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-2])
    quoted = [f"`{n}`" for n in names]
    partial = rows.mapInArrow(_partial(names, "_pool_vec", "_pool_mask"), f"{fields}{_SUM} array<double>, {_WEIGHT} array<double>")
    dealt = partial.repartition(*[F.col(n) for n in quoted]).sortWithinPartitions(*quoted)
    return dealt.mapInArrow(_total(names, out_col), f"{fields}`{out_col}` array<float>")


def cls_pool(df: DataFrame, group, vec_col: str, position, out_col: str = "embedding") -> DataFrame:
    """First member's vector per group (lowest ``position``)."""
    group = [group] if isinstance(group, (str, Column)) else list(group)
    return df.groupBy(*group).agg(F.min_by(vec_col, position).alias(out_col))
