"""Approximate nearest neighbours by a graph of near neighbours, searched shard by shard.

**Build.**  Equal vectors become one node, with a table of the ids behind it.  Nodes are
dealt to cells of fitted centroids, and cells to shards of bounded size; the shards of a
cell lie together in groups of at most ``_GROUP`` numbers, or one shard.  The rows of a
cell and those for which it is the second nearest meet in one matrix product, which finds
first neighbours on both sides of a cell's border.  Where they are too many for one, finer
cells are fitted for this, in several of which every row takes part.  Then rounds of "neighbours of
neighbours" improve them over the whole table: the vectors of a node's best neighbours,
in both directions, meet at that node, are compared with each other, and every node keeps
its best ``degree`` of all it has met.  Rounds end when few links change.
All of it is joins and aggregations on node numbers; a popular node keeps its best
``sample`` askers only, which a window limit takes before the shuffle.

**Search.**  A query goes to the groups of its nearest cells.  There a beam walks the links:
it expands its best nodes, compares their unseen neighbours, keeps the best ``width``, and ends when
nothing in it is unexpanded; all queries of a block move at once.  A group of several shards is
walked by a beam that is wider by the root of their number.  Links that leave the
group, from nodes that are still in the beam at the end, continue as new starts in the
groups they lead to, ``hops`` times.  Scores are exact; which rows are compared is the
approximation.  A group and a block of queries meet once, so nothing is collected beyond
their bounded sizes, and a query travels once for a group instead of once for every shard.

Vectors that are NULL, hold a NULL or are all zero take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecloom.functions import kernels
from vecloom.operators.ann import fit_centroids, nearest_cells
from vecloom.operators.knn import vector_signature
from vecloom.sources.scratch import materialize, small_copy

# A node's number: its shard above, its place in the shard below.
_PLACE_BITS = 32
_MAX_CELLS = 1024
# Vectors gathered at once while a beam moves, in elements.
_GATHER = 2_000_000
# Vectors that meet in one product for their first neighbours, and nodes and queries of one task of a search, in elements.
_FIRST, _GROUP, _QUERIES = 4_194_304, 12_582_912, 4_194_304
# Finer cells of first neighbours that a row takes part in, and how many there are for the rows of each product.
_BESIDE, _FINER = 4, 6
# Tasks of a search round, as far as there are blocks of queries for them.
_TASKS = 32
# Flags of nodes seen, of the queries that walk at once.
_SEEN = 64_000_000


@dataclass(frozen=True)
class GraphSpec:
    """Rows per shard, links per node, and rounds of neighbours of neighbours over ``sample`` links each way.

    A node is linked to its ``degree`` neighbours and the best ``askers`` of those that have it as a neighbour; the
    latter make rows reachable that are nobody's first choice.
    """

    shard_rows: int = 8_192
    degree: int = 16
    askers: int = 32
    sample: int = 8
    rounds: int = 4
    min_change: float = 0.01
    fit_rows: int = 200_000
    seed: int = 42


@dataclass(frozen=True)
class GraphIndex:
    """Tables of a stored graph, and the centroids by which queries are routed."""

    nodes: DataFrame  # grp, shard, place, node, vec, links, start
    copies: DataFrame  # node, id
    shards: DataFrame  # cell, first, shards, first_group, groups
    centroids: np.ndarray


def usable(vec_col: str) -> Column:
    vec = F.col(vec_col)
    fine = vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull()) & F.exists(vec, lambda x: x != 0)
    return F.coalesce(fine, F.lit(False))


def _node(shard: str | Column, place: str | Column) -> Column:
    wide = (F.col(c).cast("long") if isinstance(c, str) else c.cast("long") for c in (shard, place))
    shard, place = wide
    return F.shiftleft(shard, _PLACE_BITS).bitwiseOR(place)


def _shards(placed: DataFrame, rows: int, together: int = 1) -> DataFrame:
    """Per cell its first shard and how many it has, and likewise groups of ``together`` shards; one row per cell."""
    counted = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("shards")).toPandas()
    counted = counted.sort_values("cell")
    counted["groups"] = -(-counted["shards"] // together)
    for name, of in (("first", "shards"), ("first_group", "groups")):
        counted[name] = counted[of].cumsum() - counted[of]
    names = ("cell", "first", "shards", "first_group", "groups")
    table = [tuple(int(x) for x in row) for row in zip(*(counted[n] for n in names))]
    return placed.sparkSession.createDataFrame(table, ", ".join(f"{n} int" for n in names))


def _group(shard: Column) -> Column:
    """The group of a shard, in rows that have its cell's shards and groups."""
    return (F.col("first_group") + F.floor((shard - F.col("first")) * F.col("groups") / F.col("shards"))).cast("int")


def _first_groups(nodes: DataFrame, count: int, dim: int, spec: GraphSpec) -> DataFrame:
    """Groups of bounded size (group, node, vec) in which nodes find their first neighbours."""
    most = max(_FIRST // dim, 2 * spec.shard_rows)
    beside = nodes.select("node", "vec", F.explode("cells").alias("cell"))
    groups = _shards(beside.select("cell"), most)
    if groups.filter(F.col("shards") > 1).head(1):
        finer = min(_MAX_CELLS, -(-_FINER * count // most))
        centroids = fit_centroids(nodes, finer, vec_col="vec", sample_rows=min(spec.fit_rows, count), seed=spec.seed)
        beside = nodes.select("node", "vec", F.explode(nearest_cells("vec", centroids, _BESIDE)).alias("cell"))
        beside = materialize(beside, "graph-beside")
        groups = _shards(beside.select("cell"), most)
    number = F.col("first") + F.pmod(F.xxhash64("node", F.lit(spec.seed)), F.col("shards"))
    return beside.join(F.broadcast(groups), "cell").withColumn("group", number).select("group", "node", "vec")


def _own_neighbours(degree: int):
    """Best neighbours inside one group."""

    def find(group: pa.Table) -> pa.Table:
        nodes = group.column("node").to_numpy()
        vectors = group.column("vec").combine_chunks()
        unit = kernels.unit_rows(kernels.pack(vectors, len(vectors[0]))[0])
        k = min(degree, len(nodes) - 1)
        if k < 1:
            return pa.table({"node": pa.array([], pa.int64()), "near": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        found, step = [], max(1, 4_000_000 // len(unit))
        for start in range(0, len(unit), step):
            scores = unit[start:start + step] @ unit.T
            here = np.arange(len(scores))
            scores[here, start + here] = -np.inf
            best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
            found.append((np.repeat(nodes[start:start + step], k), nodes[best].ravel(), np.take_along_axis(scores, best, 1).ravel()))
        return pa.table({name: np.concatenate(part) for name, part in zip(("node", "near", "score"), zip(*found))})

    return find


def _meetings(batches: Iterator[pa.RecordBatch], keep: int) -> Iterator[pa.RecordBatch]:
    """Rows (at, node, vec) sorted by ``at``: everyone who meets at one node, compared with each other."""
    held: pa.Table | None = None

    def compared(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        vectors = rows.column("vec").combine_chunks()
        unit = kernels.unit_rows(kernels.pack(vectors, len(vectors[0]))[0])
        nodes, at = rows.column("node").to_numpy(), rows.column("at").to_numpy()
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        sizes = np.diff(np.append(first, len(at)))
        out: list[tuple[np.ndarray, ...]] = []
        for size in np.unique(sizes[sizes > 1]):  # meetings of one size are one stacked product
            here = first[sizes == size]
            step = max(1, _GATHER // (int(size) * max(int(size), unit.shape[1])))
            for some in (here[i:i + step] for i in range(0, len(here), step)):
                rows_at = some[:, None] + np.arange(size)
                scores = unit[rows_at] @ unit[rows_at].transpose(0, 2, 1)
                scores[:, np.arange(size), np.arange(size)] = -np.inf
                k = min(keep, int(size) - 1)
                best = np.argpartition(-scores, k - 1, axis=2)[:, :, :k]
                names = nodes[rows_at]
                near = np.take_along_axis(np.broadcast_to(names[:, None, :], scores.shape), best, axis=2)
                out.append((np.repeat(names.ravel(), k), near.ravel(), np.take_along_axis(scores, best, axis=2).ravel()))
        if out:
            yield pa.record_batch({n: pa.array(np.concatenate(c)) for n, c in zip(("node", "near", "score"), zip(*out))})

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        at = rows.column("at").to_numpy()
        cut = int(np.searchsorted(at, at[-1]))
        if cut:
            yield from compared(rows.slice(0, cut).combine_chunks())
        held = rows.slice(cut)
    if held is not None:
        yield from compared(held.combine_chunks())


def _best(edges: DataFrame, count: int, key: str = "node", other: str = "near") -> DataFrame:
    """The best rows of every ``key``; the limit is taken before the shuffle too."""
    order = Window.partitionBy(key).orderBy(F.desc("score"), F.xxhash64(other), other)
    return edges.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= count).drop("nth")


def _reversed(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("near").alias("node"), F.col("node").alias("near"), "score")


def improve(nodes: DataFrame, edges: DataFrame, spec: GraphSpec) -> DataFrame:
    """One round: everyone's best neighbours meet, and each keeps the best of whom it knew and met."""
    around = _best(edges, spec.sample).unionByName(_best(_reversed(edges), spec.sample))
    around = around.select(F.col("node").alias("at"), F.col("near").alias("node")).distinct()
    seated = around.join(nodes.select("node", "vec"), "node").repartition("at").sortWithinPartitions("at")
    met = seated.select("at", "node", "vec").mapInArrow(lambda b: _meetings(b, spec.sample), "node long, near long, score double")
    known = edges.unionByName(met).groupBy("node", "near").agg(F.max("score").alias("score"))
    return _best(known, spec.degree)


def build_graph(docs: DataFrame, path: str, spec: GraphSpec = GraphSpec(), *, id_col: str = "id", vec_col: str = "embedding",
                cells: int | None = None) -> None:
    """Write the graph of all rows under ``path``: nodes with links, ids of equal vectors, shards and centroids."""
    spark = docs.sparkSession
    rows = docs.filter(usable(vec_col)).select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    rows = rows.withColumn("sig", vector_signature("vec"))
    distinct = materialize(rows.groupBy("sig").agg(F.any_value("vec").alias("vec")), "graph-vectors")
    count = distinct.count()
    cells = min(_MAX_CELLS, cells or -(-count // spec.shard_rows)) or 1
    if cells > 1:
        centroids = fit_centroids(distinct, cells, vec_col="vec", sample_rows=min(spec.fit_rows, count), seed=spec.seed)
    else:
        centroids = np.ones((1, len(distinct.first()["vec"]) if count else 1))
    near = distinct.withColumn("cells", nearest_cells("vec", centroids, 2))
    placed = materialize(near.withColumn("cell", F.get("cells", F.lit(0))), "graph-placed")
    dim = centroids.shape[1]
    shards = _shards(placed.select("cell"), spec.shard_rows, max(1, _GROUP // dim // spec.shard_rows))
    numbered = placed.join(F.broadcast(shards), "cell")
    numbered = numbered.withColumn("shard", F.col("first") + F.pmod(F.xxhash64("sig"), F.col("shards")).cast("int"))
    place = F.row_number().over(Window.partitionBy("shard").orderBy("sig")) - 1
    numbered = numbered.withColumn("grp", _group(F.col("shard")))
    nodes = numbered.select("grp", "shard", place.alias("place"), "sig", "cells", "vec").withColumn("node", _node("shard", "place"))
    nodes = materialize(nodes, "graph-nodes")
    rows.select("sig", "id").join(nodes.select("sig", "node"), "sig").select("node", "id").write.mode("overwrite").parquet(f"{path}/copies")

    # First neighbours: a cell's own rows and those next to it.
    met = _first_groups(nodes, count, dim, spec)
    found = met.groupBy("group").applyInArrow(_own_neighbours(spec.degree), "node long, near long, score double")
    edges = materialize(_best(found.distinct(), spec.degree), "graph-edges")
    if nodes.agg(F.max("shard")).first()[0]:  # one shard has compared all pairs already
        total = edges.count()
        for _ in range(spec.rounds):
            better = materialize(improve(nodes, edges, spec), "graph-edges")
            changed = better.join(edges.select("node", "near"), ["node", "near"], "left_anti").count()
            edges = better
            if changed <= spec.min_change * total:
                break
    both = edges.unionByName(_best(_reversed(edges), spec.askers))
    links = both.groupBy("node").agg(F.collect_set("near").alias("links"))
    linked = nodes.drop("sig", "cells").join(links, "node", "left")
    linked = linked.withColumn("links", F.coalesce("links", F.array().cast("array<bigint>")))
    vec_type = nodes.schema["vec"].dataType.simpleString()
    fields = f"grp int, shard int, place int, node long, vec {vec_type}, links array<bigint>, start boolean"
    started = linked.select("grp", "shard", "place", "node", "vec", "links").groupBy("grp").applyInArrow(_with_starts, fields)
    started.write.mode("overwrite").parquet(f"{path}/nodes")
    shards.write.mode("overwrite").parquet(f"{path}/shards")
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(centroids)]
    spark.createDataFrame(centers, "cell int, centroid array<double>").write.mode("overwrite").parquet(f"{path}/centroids")


def load_graph(spark: SparkSession, path: str) -> GraphIndex:
    rows = spark.read.parquet(f"{path}/centroids").orderBy("cell").collect()
    nodes, copies, shards = (spark.read.parquet(f"{path}/{name}") for name in ("nodes", "copies", "shards"))
    return GraphIndex(nodes, copies, shards, np.array([r["centroid"] for r in rows]))


def walk(queries: np.ndarray, vectors: np.ndarray, links: np.ndarray, starts: np.ndarray, width: int,
         expand: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Beams of all queries at once: places and scores of the best ``width`` nodes, best first, and nodes compared.

    ``links`` and ``starts`` (per query) are padded with -1, as the places are where fewer were found.
    """
    n, rows = len(queries), np.arange(len(queries))
    seen = np.zeros((n, len(vectors) + 1), dtype=bool)
    seen[:, -1] = True  # where -1 points
    places = np.full((n, width), -1)
    scores = np.full((n, width), -np.inf)
    fresh = np.zeros((n, width), dtype=bool)
    compared = np.zeros(n, dtype=np.int64)

    def meet(some: np.ndarray, offered: np.ndarray) -> None:
        row, col = np.nonzero(offered >= 0)
        place = offered[row, col]
        new = ~seen[some[row], place]
        both = np.sort(row[new] * seen.shape[1] + place[new])
        row, place = np.divmod(both[np.diff(both, prepend=-1) > 0], seen.shape[1])
        if not len(row):
            return
        at = some[row]
        seen[at, place] = True
        sizes = np.bincount(row, minlength=len(some))
        compared[some] += sizes
        row = (np.cumsum(sizes > 0) - 1)[row]  # those that met someone new
        some, sizes = some[sizes > 0], sizes[sizes > 0]
        got = np.empty(len(row))
        step = max(1, _GATHER // vectors.shape[1])
        for i in range(0, len(row), step):
            part = slice(i, i + step)
            got[part] = np.einsum("cd,cd->c", queries[at[part]], vectors[place[part]])
        col = width + np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        shape = (len(some), width + int(sizes.max()))
        all_scores, all_places, all_fresh = np.full(shape, -np.inf), np.full(shape, -1), np.zeros(shape, dtype=bool)
        all_scores[:, :width], all_places[:, :width], all_fresh[:, :width] = scores[some], places[some], fresh[some]
        all_scores[row, col], all_places[row, col], all_fresh[row, col] = got, place, True
        best = np.argsort(-all_scores, axis=1, kind="stable")[:, :width]
        scores[some] = np.take_along_axis(all_scores, best, 1)
        places[some] = np.take_along_axis(all_places, best, 1)
        fresh[some] = np.take_along_axis(all_fresh, best, 1)

    meet(rows, starts)
    while True:
        some = np.flatnonzero(fresh.any(axis=1))
        if not len(some):
            return places, scores, compared
        best = np.argsort(~fresh[some], axis=1, kind="stable")[:, :expand]  # beams are sorted by score
        open_ = np.take_along_axis(fresh[some], best, 1)
        chosen = np.where(open_, places[some[:, None], best], -1)
        fresh[some[:, None], best] = False
        offered = np.where(chosen[:, :, None] >= 0, links[chosen], -1).reshape(len(some), -1)
        meet(some, offered)


def parts_of(links: np.ndarray) -> np.ndarray:
    """Per node the first node of its connected part; ``links`` are places, padded with -1."""
    n = len(links)
    own, other = np.nonzero(links >= 0)[0], links[links >= 0]
    part = np.arange(n)
    while True:
        lower = part.copy()
        np.minimum.at(lower, own, part[other])
        np.minimum.at(lower, other, part[own])
        lower = lower[lower]
        if np.array_equal(lower, part):
            return part
        part = lower


def _with_starts(group: pa.Table) -> pa.Table:
    """Mark where queries from outside begin: evenly spaced nodes, and one of every part that links do not connect."""
    group = group.sort_by("node").combine_chunks()
    links = _inside(_padded(group.column("links").combine_chunks()), group.column("node").to_numpy())
    start = np.zeros(len(links), dtype=bool)
    start[::max(1, int(np.sqrt(len(links)) / 2))] = True
    start[np.unique(parts_of(links))] = True
    return group.append_column("start", pa.array(start))


def _inside(targets: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Positions of the targets among a group's sorted ``nodes``; -1 for those elsewhere."""
    at = np.minimum(np.searchsorted(nodes, targets), len(nodes) - 1)
    return np.where(nodes[at] == targets, at, -1)


def _padded(lists: pa.Array) -> np.ndarray:
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.full((len(sizes), max(1, int(sizes.max(initial=0)))), -1, dtype=np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


_FOUND = "q {q}, node long, score double, compared long, exits array<bigint>"


def _search_group(k: int, width: int, exits: int, query_block: int, q_type: pa.DataType):
    """Beams of a block of queries in one group: rows of the best nodes, the first of which carries the query's totals."""

    def search(asked: pa.Table, nodes: pa.Table) -> pa.Table:
        empty = pa.table({"q": pa.array([], q_type), "node": pa.array([], pa.int64()), "score": pa.array([], pa.float64()),
                          "compared": pa.array([], pa.int64()), "exits": pa.array([], pa.list_(pa.int64()))})
        if not asked.num_rows or not nodes.num_rows:
            return empty
        nodes, asked = nodes.sort_by("node").combine_chunks(), asked.combine_chunks()
        numbers, stored = nodes.column("node").to_numpy(), nodes.column("vec").combine_chunks()
        vectors = kernels.unit_rows(kernels.pack(stored, len(stored[0]))[0])
        targets = _padded(nodes.column("links").combine_chunks())
        links = _inside(targets, numbers)
        outside = np.where(links < 0, targets, -1)
        spread = np.flatnonzero(nodes.column("start").to_numpy())  # for queries that come from outside
        wider = int(np.ceil(np.sqrt(len(np.unique(numbers >> _PLACE_BITS)))))
        found, step = [empty], max(1, min(query_block, _SEEN // len(nodes)))
        for some in (asked.slice(i, step).combine_chunks() for i in range(0, asked.num_rows, step)):
            queries = kernels.unit_rows(kernels.pack(some.column("vec").combine_chunks(), vectors.shape[1])[0])
            starts = _inside(_padded(some.column("starts").combine_chunks()), numbers)
            wide = np.full((len(queries), max(starts.shape[1], len(spread))), -1)
            wide[:, :starts.shape[1]] = starts
            wide[(starts < 0).all(axis=1), :len(spread)] = spread
            places, scores, compared = walk(queries, vectors, links, wide, max(width * wider, k), 4 * wider)
            kept = np.zeros(places.shape, dtype=bool)
            kept[:, :k] = places[:, :k] >= 0
            kept[:, 0] |= True
            leaving: list[list[int]] = []
            for row in places if exits else ():
                out = outside[row[row >= 0]]
                leaving.append(list(dict.fromkeys(out[out >= 0].tolist()))[:exits])
            row, at = np.nonzero(kept)
            place = places[row, at]
            lead = at == 0
            lists = [leaving[r] if exits and first else [] for r, first in zip(row, lead)]
            found.append(pa.table({
                "q": some.column("q").combine_chunks().take(pa.array(row)),
                "node": pa.array(numbers[place], mask=place < 0),
                "score": pa.array(np.round(scores[row, at], kernels.SCORE_DIGITS), mask=place < 0),
                "compared": np.where(lead, compared[row], 0),
                "exits": pa.array(lists, pa.list_(pa.int64())),
            }))
        return pa.concat_tables(found)

    return search


def _walk_round(asked: DataFrame, nodes: DataFrame, k: int, width: int, exits: int, query_block: int, most: int) -> DataFrame:
    """Every (grp, q, vec, starts) meets its group, in no more blocks of queries than give enough tasks of bounded size."""
    q_type = asked.schema["q"].dataType.simpleString()
    counted = materialize(asked.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "graph-blocks")
    tasks = -(-_TASKS // max(1, counted.count()))
    spread = F.least(F.ceil(F.col("n") / query_block), F.lit(tasks))
    blocks = counted.select("grp", F.greatest(spread, F.ceil(F.col("n") / most)).cast("int").alias("blocks"))
    few = small_copy(blocks)
    blocks = blocks if few is None else few
    left = asked.join(blocks, "grp").withColumn("block", F.pmod(F.xxhash64("q"), F.col("blocks")).cast("int"))
    right = nodes.join(blocks, "grp").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    kind = asked.sparkSession.createDataFrame([], asked.select("q").schema).toArrow().schema.field("q").type
    keys = ["grp", "block"]
    return (
        left.select(*keys, "q", "vec", "starts").groupBy(*keys)
        .cogroup(right.select(*keys, "node", "vec", "links", "start").groupBy(*keys))
        .applyInArrow(_search_group(k, width, exits, query_block, kind), _FOUND.format(q=q_type))
    )


def graph_candidates(queries: DataFrame, index: GraphIndex, k: int, *, probes: int = 4, width: int = 64, hops: int = 1,
                     exits: int = 16, query_id: str = "q", vec_col: str = "embedding", query_block: int = 1_024) -> DataFrame:
    """Best nodes of every query per group visited: q, node, score, compared (sum it for the pairs compared)."""
    if k < 1 or width < 1 or probes < 1:
        raise ValueError("k, width and probes must be at least 1")
    asked = queries.filter(usable(vec_col)).select(F.col(query_id).alias("q"), F.col(vec_col).alias("vec"))
    none = F.array().cast("array<bigint>")
    cells = asked.withColumn("cell", F.explode(nearest_cells("vec", index.centroids, probes)))
    near = cells.join(F.broadcast(index.shards), "cell")  # one row per cell, at most _MAX_CELLS
    visit = F.explode(F.sequence(F.col("first_group"), F.col("first_group") + F.col("groups") - 1))
    asked_at = materialize(near.select("q", "vec", none.alias("starts"), visit.alias("grp")), "graph-asked")
    every = index.shards.withColumn("shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("shards") - 1)))
    group_of = F.broadcast(every.select("shard", _group(F.col("shard")).alias("grp")))
    visited = asked_at.select("q", "grp")
    most = max(query_block, _QUERIES // index.centroids.shape[1])
    found = []
    for hop in range(hops + 1):
        more = exits if hop < hops else 0
        found.append(materialize(_walk_round(asked_at, index.nodes, k, width, more, query_block, most), "graph-found"))
        if not more:
            break
        leaving = found[-1].select("q", F.explode("exits").alias("node"))
        leaving = leaving.withColumn("shard", F.shiftright("node", _PLACE_BITS).cast("int")).join(group_of, "shard")
        starts = leaving.groupBy("q", "grp").agg(F.collect_set("node").alias("starts")).join(visited, ["q", "grp"], "left_anti")
        asked_at = materialize(starts.join(asked, "q").select("q", "vec", "starts", "grp"), "graph-asked")
        visited = visited.unionByName(asked_at.select("q", "grp"))
    return reduce(DataFrame.unionByName, found).select("q", "node", "score", "compared")


def graph_search(queries: DataFrame, index: GraphIndex, k: int, *, probes: int = 4, width: int = 64, hops: int = 1,
                 exits: int = 16, query_id: str = "q", vec_col: str = "embedding", query_block: int = 1_024) -> DataFrame:
    """About the ``k`` most similar rows of every query: q, id, score, rank.  A query id names one vector."""
    found = graph_candidates(queries, index, k, probes=probes, width=width, hops=hops, exits=exits, query_id=query_id,
                             vec_col=vec_col, query_block=query_block)
    best = _best(found.filter(F.col("node").isNotNull()).groupBy("q", "node").agg(F.max("score").alias("score")), k, "q", "node")
    # Of equal vectors only the k lowest ids can be answers.
    lowest = F.row_number().over(Window.partitionBy("node").orderBy("id"))
    copies = index.copies.withColumn("nth", lowest).filter(F.col("nth") <= k).drop("nth")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    ranked = best.join(copies, "node").withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select("q", "id", "score", "rank")
