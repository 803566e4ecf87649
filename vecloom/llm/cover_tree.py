"""Exact cosine near-duplicates by dual traversal of cover trees.

On unit vectors, cosine >= t is chord distance <= sqrt(2 - 2t), so metric bounds
decide whole sets of pairs:

* The top of the tree is built on a bounded sample: nested levels of centres with
  halving radii, down to the last level with at most ``max_cells`` centres.  It
  only routes; every vector is put into its nearest cell, and covering radii are
  measured over all vectors.
* A cell is dealt in blocks of bounded size; each block is one task's own cover tree,
  built once, whose nodes store centre, true covering radius and their range of
  points in depth-first order.
* A pair of blocks is a unit of work.  A pair of nodes is dropped if its centres are
  farther apart than the threshold plus both radii, taken whole if nearer than the
  threshold minus both radii, and else split.  Pairs of points are decided by the
  cosine in double precision; products in single precision, with their rounding
  allowed for, only rule out what can not reach it.
* Blocks that few others meet are sent to them.  Where the bounds rule out little, as
  among uniformly random vectors, every block meets nearly every other: tasks then read
  two ranges of the stored blocks each, and no pair of blocks is ever shuffled.
* Vectors are shuffled twice, to collapse equal ones and to deal them in blocks; the way
  back from points to rows goes by digests, if they tell all points apart.

A unit returns, per vector, how many it links with, and a spanning forest of its
links; pairs are never rows.  Equal vectors are one point with a multiplicity, so a
crowd of copies costs one row.

Defined results: a vector that is null, zero, or holds a null or non-finite value
links with nothing, nor do vectors of different lengths.  Rows that repeat an id are
rows of their own.  Rows with a null id get no links and a null component.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import blocks_for
from vecloom.llm.components import connected_components, local_components
from vecloom.sources.scratch import materialize

THRESHOLD = 0.9
SAMPLE_ROWS, MAX_CELLS, BLOCK_ROWS, LEAF_ROWS = 8192, 1024, 2048, 48
# Chord distances of nearly equal vectors carry rounding of about 3e-8: smaller radii count as none, and pairs whose
# bounds come this close to the threshold are split down to points.
_SLACK = 1e-6
_BATCH_EDGES = 1_000_000
# A block holds at least ``block_rows`` vectors, and up to so many bytes of them where a cell has more than so many blocks.
_BLOCK_BYTES, _FEW_BLOCKS = 4 << 20, 8
_FILE_BYTES = 8 << 20  # of blocks that a task reads together, about
_TILE_ROWS, _TILE_COLUMNS = 256, 2048
# Costs, in pairs of points that a product of matrices compares meanwhile: a step of the traversal, a pair fetched alone.
_STEP, _FETCH = 25_000, 150


@dataclass
class Children:
    """The child nodes of each node, which have consecutive numbers."""

    first: np.ndarray
    last: np.ndarray

    def __len__(self) -> int:
        return len(self.first)

    def __getitem__(self, v: int) -> np.ndarray:
        return np.arange(self.first[v], self.last[v])


@dataclass
class Tree:
    """Cover tree over ``points`` (unit rows in depth-first order).

    Node ``v`` covers ``points[first[v]:last[v]]``, is centred at the first of them and reaches ``radius[v]``;
    ``children[v]`` are its child nodes, empty for a single point.
    """

    points: np.ndarray
    order: np.ndarray
    first: np.ndarray
    last: np.ndarray
    radius: np.ndarray
    children: Children


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def _tiles(a: np.ndarray, b: np.ndarray, least: float) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row and column of each tile of the products of single-precision rows, and where in it they reach ``least``."""
    # Hits are few: eight numbers are looked at together.
    hit = np.zeros(_TILE_ROWS * _TILE_COLUMNS + 8, dtype=bool)
    out = np.empty(_TILE_ROWS * _TILE_COLUMNS, dtype=np.float32)
    for y in range(0, len(b), _TILE_COLUMNS):
        right = b[y:y + _TILE_COLUMNS].T
        for x in range(0, len(a), _TILE_ROWS):
            left = a[x:x + _TILE_ROWS]
            n = len(left) * right.shape[1]
            tile = np.matmul(left, right, out=out[:n].reshape(len(left), -1))
            np.greater_equal(tile.ravel(), least, out=hit[:n])
            hit[n:n + 8] = False
            some = np.flatnonzero(hit[:-(-n // 8) * 8].view(np.uint64) != 0)
            if len(some):
                k, at = np.nonzero(hit.reshape(-1, 8)[some])
                i, j = np.divmod(some[k] * 8 + at, right.shape[1])
                yield x, y, i + x, j + y


def _margin(terms: int, size: float = 1.0) -> float:
    """What single precision may add to or take from a sum of products of rows of this size."""
    return size * (terms + 8) * 2.0 ** -23


def _cosines(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    step = max(1, (1 << 20) // max(1, a.shape[1]))
    parts = [np.einsum("ij,ij->i", a[i[s:s + step]], b[j[s:s + step]]) for s in range(0, len(i), step)]
    return np.concatenate(parts) if parts else np.zeros(0)


def _in_tile(a: np.ndarray, b: np.ndarray, x: int, y: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of pairs of the tile that begins at row ``x`` and column ``y``."""
    rows, columns = a[x:x + _TILE_ROWS], b[y:y + _TILE_COLUMNS]
    if len(i) * _FETCH > len(rows) * len(columns):
        return (rows @ columns.T)[i - x, j - y]
    return _cosines(a, b, i, j)


def cover(points: np.ndarray, radius: float, first: int = 0, most: float = math.inf) -> tuple[np.ndarray, np.ndarray]:
    """Centres that cover all points within ``radius``, from the nested centre ``first`` on, and each point's centre.

    More than ``most`` centres end it early, with points left that no centre covers.
    """
    away, single = distances(points, points[first:first + 1])[:, 0], points.astype(np.float32)
    centres, owner = [first], np.zeros(len(points), dtype=np.int64)
    open_ = np.flatnonzero(away > radius)
    while len(open_) and len(centres) <= most:
        # In order, each open point is a centre if none before it is near; many are tried at once.
        tried = open_[:_TILE_ROWS]
        near = distances(points[tried], points[tried]) <= radius
        free, chosen = np.ones(len(tried), dtype=bool), []
        for i in range(len(tried)):
            if free[i]:
                chosen.append(i)
                free &= ~near[i]
        made = tried[chosen]
        best = np.full(len(open_), len(made))
        rest, heads = points[open_], points[made]
        for x, y, i, j in _tiles(single[open_], single[made], 1 - radius * radius / 2 - _margin(points.shape[1])):
            near = np.sqrt(np.maximum(2.0 - 2.0 * _in_tile(rest, heads, x, y, i, j), 0.0)) <= radius
            np.minimum.at(best, i[near], j[near])
        best[np.searchsorted(open_, made)] = np.arange(len(made))
        owned = best < len(made)
        owner[open_[owned]] = len(centres) + best[owned]
        centres += made.tolist()
        open_ = open_[~owned]
    return np.array(centres), owner


def build_tree(points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> Tree:
    """Levels halve the radius; levels that would not split a node are skipped."""
    order = np.arange(len(points))
    first, last, radius, child, end = [], [], [], [], []

    def node(a: int, b: int, reach: float) -> int:
        first.append(a)
        last.append(b)
        radius.append(reach)
        child.append(0)
        end.append(0)
        return len(first) - 1

    todo = [node(0, len(points), float(distances(points[:1], points).max()) if len(points) else 0.0)]
    while todo:
        v = todo.pop()
        a, b = first[v], last[v]
        if b - a < 2:
            continue
        if b - a <= leaf_rows or radius[v] <= _SLACK:
            made = [node(i, i + 1, 0.0) for i in range(a, b)]
            child[v], end[v] = made[0], made[-1] + 1
            continue
        own, level = points[order[a:b]], 2.0 ** math.ceil(math.log2(radius[v]))
        while True:
            level /= 2  # the next level of the nested cover
            centres, owner = cover(own, level)
            if len(centres) > 1:
                break
        # Points go in order of their child, each child's centre first, so that every node is one range.
        rank = np.ones(b - a, dtype=np.int64)
        rank[centres] = 0
        order[a:b] = order[a:b][np.lexsort((rank, owner))]
        sizes = np.bincount(owner, minlength=len(centres))
        ends = a + np.cumsum(sizes)
        away = np.sqrt(np.maximum(2.0 - 2.0 * np.einsum("ij,ij->i", own, own[centres][owner]), 0.0))
        reach = np.zeros(len(centres))
        np.maximum.at(reach, owner, away)
        made = [node(int(e - n), int(e), float(r) if n > 1 else 0.0) for e, n, r in zip(ends, sizes, reach, strict=True)]
        child[v], end[v] = made[0], made[-1] + 1
        todo += made
    return Tree(points[order], order, np.array(first), np.array(last), np.array(radius), Children(np.array(child), np.array(end)))


def _heads(points: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` numbers of each row and the length of the rest: their product is no less than that of the rows."""
    if k >= points.shape[1]:
        return points.astype(np.float32)
    rest = points[:, k:]
    return np.column_stack([points[:, :k], np.sqrt(np.einsum("ij,ij->i", rest, rest))]).astype(np.float32)


def _head_length(a: np.ndarray, b: np.ndarray, threshold: float) -> int:
    """How many numbers to compare first, by the pairs of a few rows that are left for the others to decide."""
    dim = a.shape[1]
    if dim < 16 or len(a) * len(b) < 1 << 18:
        return dim
    a, b = a[::max(1, len(a) // 256)], b[::max(1, len(b) // 256)]
    costs = {dim: 1.0}
    for k in (dim // 4, 5 * dim // 16, 3 * dim // 8, dim // 2, 5 * dim // 8):
        open_ = _heads(a, k) @ _heads(b, k).T >= threshold - _margin(k)
        costs[k] = (k + 4) / dim + _FETCH * float(open_.mean())
    return min(costs, key=costs.get)


def close_points(a: np.ndarray, b: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit rows with a cosine of ``threshold`` or more, some at a time; the cosine is that of double precision."""
    k = _head_length(a, b, threshold)
    for x, y, i, j in _tiles(_heads(a, k), _heads(b, k), threshold - _margin(k)):
        good = _in_tile(a, b, x, y, i, j) >= threshold
        if good.any():
            yield i[good], j[good]


class Links:
    """Link counts and connectivity of the points of two trees (or one with itself), kept over ranges."""

    def __init__(self, left: Tree, right: Tree, left_weight: np.ndarray, right_weight: np.ndarray, same: bool) -> None:
        self.same, self.shift = same, 0 if same else len(left.points)
        self.weights = (left_weight, right_weight)
        self.sums = tuple(np.concatenate([[0], np.cumsum(w)]) for w in self.weights)
        self.steps = tuple(np.zeros(len(w) + 1, dtype=np.int64) for w in self.weights)
        self.chained = np.zeros(self.shift + len(right_weight) + 1, dtype=np.int64)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def _add(self, side: int, first: np.ndarray, last: np.ndarray, amount: np.ndarray) -> None:
        np.add.at(self.steps[side], first, amount)
        np.add.at(self.steps[side], last, -amount)

    def whole(self, a1, a2, b1, b2) -> None:
        """All points of [a1, a2) link with all of [b1, b2)."""
        self._add(0, a1, a2, self.sums[1][b2] - self.sums[1][b1])
        self._add(1, b1, b2, self.sums[0][a2] - self.sums[0][a1])
        for first, last in ((a1, a2), (b1 + self.shift, b2 + self.shift)):
            np.add.at(self.chained, first + 1, 1)  # each point of a range is joined to the one before it
            np.add.at(self.chained, last, -1)
        self._edges(a1, b1 + self.shift)

    def within(self, a1: int, a2: int) -> None:
        """All points of [a1, a2) of the one tree link with each other."""
        self._add(0, np.array([a1]), np.array([a2]), np.array([self.sums[0][a2] - self.sums[0][a1]]))
        np.add.at(self.steps[1], np.arange(a1, a2), -self.weights[0][a1:a2])  # a point is no link of its own
        np.add.at(self.steps[1], np.arange(a1 + 1, a2 + 1), self.weights[0][a1:a2])
        self.chained[a1 + 1] += 1
        self.chained[a2] -= 1

    def _edges(self, a: np.ndarray, b: np.ndarray) -> None:
        self.edges.append((a, b))
        self.held += len(a)
        if self.held > _BATCH_EDGES:
            self._reduce()

    def _reduce(self) -> np.ndarray:
        n = len(self.chained) - 1
        joined = np.flatnonzero(np.cumsum(self.chained[:n]) > 0)
        a = np.concatenate([joined, *(e[0] for e in self.edges)])
        b = np.concatenate([joined - 1, *(e[1] for e in self.edges)])
        root = local_components(n, a.astype(np.int64), b.astype(np.int64))
        child = np.flatnonzero(root != np.arange(n))
        self.edges, self.held = [(root[child], child)], 0
        return root

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        """Per point (left tree, then right if it is another): weight of what it links with, smallest connected index."""
        counts = [np.cumsum(s[:-1]) for s in self.steps]
        return counts[0] + counts[1] if self.same else np.concatenate(counts), self._reduce()


def dual_traversal(
    left: Tree, right: Tree, left_weight: np.ndarray, right_weight: np.ndarray, same: bool, threshold: float = THRESHOLD
) -> tuple[np.ndarray, np.ndarray]:
    """All links between two trees, or within one (``same``)."""
    links = Links(left, right, left_weight, right_weight, same)
    reach = math.sqrt(2.0 - 2.0 * threshold)
    if not len(left.points) or not len(right.points):
        return links.result()

    def parts(tree: Tree, v: int, split: bool) -> np.ndarray:
        own = tree.children[v] if split else ()
        return own if len(own) else np.array([v])

    def by_points(x1: int, x2: int, y1: int, y2: int, twin: bool) -> None:
        for i, j in close_points(left.points[x1:x2], right.points[y1:y2], threshold):
            if twin:
                i, j = i[i < j], j[i < j]
            links.whole(i + x1, i + x1 + 1, j + y1, j + y1 + 1)

    def by_nodes(av: np.ndarray, bv: np.ndarray, twin: bool, most: int) -> tuple[np.ndarray, ...] | None:
        """Pairs of nodes that are taken whole, and those to split; none if splitting them costs more than ``most``."""
        ra, rb = left.radius[av], right.radius[bv]
        a1, b1, na, nb = left.first[av], right.first[bv], left.last[av] - left.first[av], right.last[bv] - right.first[bv]
        # Centres are in reach if cosine >= 1 - (reach + ra + rb)^2 / 2, which is a product of longer rows.
        wide = ra + reach + _SLACK
        x = np.column_stack([left.points[a1], wide, np.ones(len(av)), wide * wide / 2 - 1]).astype(np.float32)
        y = np.column_stack([right.points[b1], rb, rb * rb / 2, np.ones(len(bv))]).astype(np.float32)
        found, cost = [], 0
        for _, _, i, j in _tiles(x, y, -_margin(x.shape[1], 16.0)):
            if twin:
                i, j = i[i < j], j[i < j]
            cost += _FETCH * len(i)
            if cost > most:
                return None
            cosine = _cosines(left.points, right.points, a1[i], b1[j])
            apart = np.sqrt(np.maximum(2.0 - 2.0 * cosine, 0.0))
            unsure = np.abs(apart - reach) <= ra[i] + rb[j] + _SLACK
            points = (na[i] == 1) & (nb[j] == 1)
            taken = np.where(unsure, points & (cosine >= threshold), apart < reach)
            split = unsure & ~points
            size = na[i[split]] * nb[j[split]]
            cost += int(np.minimum(size * _FETCH, size + _STEP).sum())
            if cost > most:
                return None
            found.append((i[taken], j[taken], i[split], j[split]))
        empty = np.zeros(0, np.int64)
        return tuple(np.concatenate([empty, *(f[k] for f in found)]) for k in range(4))

    def fetched(a1: np.ndarray, na: np.ndarray, b1: np.ndarray, nb: np.ndarray) -> None:
        """All points of small pairs of nodes, fetched together."""
        size = na * nb
        step = np.cumsum(size) // (1 << 18)
        for s in np.unique(step):
            some = np.flatnonzero(step == s)
            pair = np.repeat(some, size[some])
            at = np.arange(len(pair)) - np.repeat(np.cumsum(size[some]) - size[some], size[some])
            i, j = a1[pair] + at // nb[pair], b1[pair] + at % nb[pair]
            good = _cosines(left.points, right.points, i, j) >= threshold
            links.whole(i[good], i[good] + 1, j[good], j[good] + 1)

    todo = [(0, 0)]
    while todo:
        v, w = todo.pop()
        twin = same and v == w
        if twin and left.last[v] - left.first[v] < 2:
            continue
        if twin and 2 * left.radius[v] <= reach - _SLACK:
            links.within(int(left.first[v]), int(left.last[v]))
            continue
        x1, x2, y1, y2 = int(left.first[v]), int(left.last[v]), int(right.first[w]), int(right.last[w])
        if not twin:
            apart = float(distances(left.points[x1:x1 + 1], right.points[y1:y1 + 1])[0, 0])
            both = float(left.radius[v] + right.radius[w]) + _SLACK
            if apart > reach + both:
                continue
            if apart < reach - both:
                links.whole(*(np.array([n]) for n in (x1, x2, y1, y2)))
                continue
        # The wider node is split first; both are if they are alike.
        av = parts(left, v, twin or left.radius[v] >= 0.5 * right.radius[w])
        bv = parts(right, w, twin or right.radius[w] >= 0.5 * left.radius[v])
        pairs = (x2 - x1) * (y2 - y1)
        some = by_nodes(av, bv, twin, pairs) if 4 * len(av) * len(bv) < pairs else None
        if some is None:
            # Bounds no longer separate these nodes, or hardly join any points: their points are compared at once.
            by_points(x1, x2, y1, y2, twin)
            continue
        a1, a2, b1, b2 = left.first[av], left.last[av], right.first[bv], right.last[bv]
        i, j, k, m = some
        if len(i):
            links.whole(a1[i], a2[i], b1[j], b2[j])
        if twin:
            todo += [(int(x), int(x)) for x in av[(a2 - a1) > 1]]
        na, nb = a2 - a1, b2 - b1
        small = na[k] * nb[m] * (_FETCH - 1) <= _STEP
        if small.any():
            fetched(a1[k[small]], na[k[small]], b1[m[small]], nb[m[small]])
        todo += zip(av[k[~small]].tolist(), bv[m[~small]].tolist(), strict=True)
    return links.result()


def _usable(vector: str) -> Column:
    """Not null, not empty, every value finite, and not all of them zero."""
    column = F.col(vector)
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(column.isNotNull() & finite & F.exists(column, lambda x: x != 0), F.lit(False))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _binary(rows: np.ndarray) -> pa.Array:
    """The bytes of each row."""
    ends = np.arange(len(rows) + 1, dtype=np.int64) * rows.shape[1] * rows.itemsize
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))]
    ).cast(pa.binary())


def _packed(raw: np.ndarray, ids: np.ndarray, copies: np.ndarray) -> bytes:
    """A block with its tree; the points are kept as they were given, in depth-first order."""
    tree = build_tree(unit_rows(raw.astype(np.float64)))
    numbers = (tree.first, tree.last, tree.children.first, tree.children.last)
    kept = (raw[tree.order], tree.radius, *(n.astype(np.int32) for n in numbers), ids[tree.order], copies[tree.order])
    return pickle.dumps(kept, protocol=5)


def _unpacked(block: pa.Scalar) -> tuple[Tree, np.ndarray, np.ndarray]:
    raw, radius, first, last, child, end, ids, copies = pickle.loads(block.as_buffer())
    points = unit_rows(raw.astype(np.float64))
    first, last = first.astype(np.int64), last.astype(np.int64)
    return Tree(points, np.arange(len(points)), first, last, radius, Children(child, end)), ids, copies


def _keys(points: DataFrame, n: int) -> list[Column]:
    """Columns that tell all ``n`` different vectors ``v`` apart: two digests, or the vector if they do not."""
    digests = [F.xxhash64(F.lit(salt), "v").alias(f"key{salt}") for salt in (0, 1)]
    return digests if points.select(*digests).distinct().count() == n else [F.col("v").alias("key0")]


def top_cells(sample: list[tuple[int, list[float]]], max_cells: int) -> dict[int, np.ndarray]:
    """Per dimension the centres of the finest level that the bound allows."""
    by_size: dict[int, list[list[float]]] = {}
    for n, vector in sample:
        by_size.setdefault(n, []).append(vector)
    cells = {}
    for n, vectors in by_size.items():
        points = unit_rows(np.array(vectors, dtype=np.float64))
        level, kept = 2.0, np.array([0])
        while level > 1e-6:
            level /= 2
            centres, _ = cover(points, level, most=max_cells)
            if len(centres) > max_cells:
                break
            kept = centres
        cells[n] = points[kept]
    return cells


def cosine_links(
    vectors: DataFrame, *, threshold: float = THRESHOLD, vec_id: str = "vec_id", vector: str = "embedding",
    sample_rows: int = SAMPLE_ROWS, max_cells: int = MAX_CELLS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept``.  ``0 < threshold < 1``."""
    spark = vectors.sparkSession
    # Numbers of single precision stay so where they are stored and shuffled.
    kind = "float" if vectors.select(vector).dtypes[0][1] == "array<float>" else "double"
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast(f"array<{kind}>").alias("v"))
    usable = rows.where(_usable("v") & F.col("vec_id").isNotNull())
    points = usable.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    points = materialize(points.withColumn("dim", F.size("v")), "points")
    sample = points.orderBy(F.xxhash64("rep"), "rep").limit(sample_rows).select("dim", "v").collect()  # bounded
    cells = top_cells([(r["dim"], r["v"]) for r in sample], max_cells)

    def assign(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for n in np.unique(dims):
                mine = pa.array(np.flatnonzero(dims == n))
                raw = _matrix(batch.column(0).take(mine))
                cell, away = np.full(len(raw), -1, dtype=np.int32), np.full(len(raw), 2.0)
                if int(n) in cells:
                    unit = unit_rows(raw.astype(np.float64))
                    for i in range(0, len(raw), 4096):
                        part = distances(unit[i:i + 4096], cells[int(n)])
                        cell[i:i + 4096], away[i:i + 4096] = part.argmin(axis=1), part.min(axis=1)
                fields = [pa.array(np.full(len(raw), n, dtype=np.int32)), pa.array(cell)]
                if not whole:
                    yield pa.RecordBatch.from_arrays([*fields, pa.array(away)], names=["dim", "cell", "away"])
                    continue
                fields += [_binary(raw), *(batch.column(i).take(mine) for i in (2, 3))]
                yield pa.RecordBatch.from_arrays(fields, names=["dim", "cell", "raw", "rep", "copies"])

    # Computing the cells twice costs less than keeping every vector once more.
    near = points.select("v", "dim").mapInArrow(lambda b: assign(b, False), "dim int, cell int, away double")
    sizes = near.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("away").alias("radius"))
    # Cells are bounded by max_cells per dimension; their table stays small whatever the number of vectors.
    held = [(r["dim"], r["cell"], r["n"], r["radius"]) for r in sizes.collect()]
    keys = _keys(points, sum(n for _, _, n, _ in held))
    width = 4 if kind == "float" else 8
    blocks = []
    for d, _, n, _ in held:
        most = max(block_rows, _BLOCK_BYTES // (d * width))
        blocks.append(blocks_for(n, min(most, max(block_rows, math.ceil(n / _FEW_BLOCKS)))))
    met, sent = [[] for _ in held], 0
    reach = math.sqrt(2.0 - 2.0 * threshold)
    for p, (d, c, n, r) in enumerate(held):
        for p2, (d2, c2, n2, r2) in enumerate(held[p:], p):
            if d == d2:
                apart = 0.0 if -1 in (c, c2) else float(distances(cells[d][c:c + 1], cells[d][c2:c2 + 1])[0, 0])
                if apart <= reach + r + r2 + _SLACK:
                    met[p].append(p2)
                    sent += (n * blocks[p2] + n2 * blocks[p]) * d * width // (2 if p == p2 else 1)
    stored = sum(n * d * width for d, _, n, _ in held)
    places = spark.createDataFrame(
        [(d, c, p, blocks[p], met[p]) for p, (d, c, _, _) in enumerate(held)],
        "dim int, cell int, place int, blocks int, met array<int>",
    )
    routed = points.select("v", "dim", "rep", "copies").mapInArrow(
        lambda b: assign(b, True), "dim int, cell int, raw binary, rep long, copies long"
    )
    dealt = routed.join(F.broadcast(places.drop("met")), ["dim", "cell"]).select(
        "place", F.pmod(F.xxhash64("rep", F.lit(11)), F.col("blocks")).cast("int").alias("block"), "raw", "rep", "copies"
    )

    def pack(group):
        import pandas as pd

        raw = np.frombuffer(b"".join(group["raw"]), dtype=f"f{width}").reshape(len(group), -1)
        key = {c: [int(group[c].iloc[0])] for c in ("place", "block")}
        return pd.DataFrame(key | {"tree": [_packed(raw, group["rep"].to_numpy(), group["copies"].to_numpy())]})

    files = min(sum(blocks), max(4 * spark.sparkContext.defaultParallelism, stored // _FILE_BYTES))
    dealt = dealt.repartition(max(1, int(files)), "place", "block")
    packed = materialize(dealt.groupBy("place", "block").applyInPandas(pack, "place int, block int, tree binary"), "trees")
    routed = packed.join(F.broadcast(places.select("place", "met")), "place")
    one = routed.select("met", F.col("place").alias("c1"), F.col("block").alias("b1"), F.col("tree").alias("t1"))
    two = packed.select(F.col("place").alias("c2"), F.col("block").alias("b2"), F.col("tree").alias("t2"))
    if sent <= 2 * stored:
        units = places.select(
            F.col("place").alias("c1"), F.sequence(F.lit(0), F.col("blocks") - 1).alias("b1"), F.explode("met").alias("c2")
        ).withColumn("b1", F.explode("b1"))
        ends = places.select(F.col("place").alias("c2"), F.sequence(F.lit(0), F.col("blocks") - 1).alias("b2"))
        units = units.join(F.broadcast(ends), "c2").withColumn("b2", F.explode("b2")).where("c1 < c2 or b1 <= b2")
        work = units.join(one.drop("met"), ["c1", "b1"]).join(two, ["c2", "b2"])
    else:
        once = (F.col("c1") < F.col("c2")) | (F.col("b1") <= F.col("b2"))
        work = one.join(two.hint("shuffle_replicate_nl"), F.array_contains("met", F.col("c2")) & once)
    work = work.select("c1", "b1", "c2", "b2", "t1", "t2")

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                c1, b1, c2, b2 = (batch.column(i)[row].as_py() for i in range(4))
                if key != (c1, b1):
                    key, block = (c1, b1), _unpacked(batch.column(4)[row])
                same = key == (c2, b2)
                (left, ids, copies), (right, ids2, copies2) = block, block if same else _unpacked(batch.column(5)[row])
                counts, root = dual_traversal(left, right, copies, copies2, same, threshold)
                both = ids if same else np.concatenate([ids, ids2])
                linked, child = np.flatnonzero(counts), np.flatnonzero(root != np.arange(len(both)))
                ends = np.concatenate([both[linked], both[root[child]]])
                empty = np.arange(len(ends)) < len(linked)
                others = pa.array(np.concatenate([np.zeros(len(linked), np.int64), both[child]]), mask=empty)
                weight = pa.array(np.concatenate([counts[linked], np.zeros(len(child), np.int64)]), mask=~empty)
                yield pa.RecordBatch.from_arrays([pa.array(ends), others, weight], names=["a", "b", "weight"])

    found = materialize(work.mapInArrow(traverse, "a long, b long, weight long"), "vector-links")
    links = found.where("b is null").groupBy("a").agg(F.sum("weight").alias("other"))
    parts = connected_components(found.where("b is not null").select("a", "b"))
    narrow = points.select(*keys, "rep", "copies")
    table = narrow.join(links, F.col("rep") == F.col("a"), "left").join(parts, F.col("rep") == F.col("id"), "left").select(
        *(c for c in narrow.columns if c.startswith("key")),
        (F.col("copies") - 1 + F.coalesce("other", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("c"),
    )
    known = usable.select("vec_id", *keys).join(table, [c for c in table.columns if c.startswith("key")])
    known = known.select("vec_id", F.col("n").alias("n_links"), F.col("c").alias("component_id"))
    unknown = rows.where(~_usable("v") | F.col("vec_id").isNull())
    alone = unknown.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return known.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
