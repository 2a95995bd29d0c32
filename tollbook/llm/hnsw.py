"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Different directions are dealt to shards by hash. Each shard is a layered graph kept
as flat arrays: unit vectors, neighbour slots per layer (-1 where empty) and the entry
point. Points join in batches: a batch searches the graph as it stands, all its
points in step, then links both ways, each list thinned to neighbours that are not
nearer to one another; points that this leaves out of reach are linked in the end.
All is in double precision, as near copies differ by less than single precision holds.
A shard's graph goes to one task, past which the queries stream; all points that a
search finds are ranked by exact cosine and the shards' results are merged by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import saved

SHARD_ROWS = 8192
QUERY_BLOCK = 1024
LINKS, WIDTH, SEARCH_WIDTH = 16, 64, 160
LEVEL_SCALE = 1 / np.log(LINKS)
BATCH = 256


@dataclass
class Graph:
    """One shard. ``layers[l]`` holds the neighbour slots of the points of level ``l`` or more.

    Points are in order of falling level, so layer ``l`` has slots for the first
    ``len(layers[l])`` points, and point 0 is the entry.
    """

    vectors: np.ndarray
    layers: list[np.ndarray]

    def search(self, queries: np.ndarray, width: int, layer: int, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of one layer for many queries in step, among the first ``size`` points.

        Returns for each query up to ``width`` points, nearest first, and their
        cosines (-1 and -inf where there are fewer).
        """
        n, slots = len(queries), self.layers[layer]
        rows = np.arange(n)
        seen = np.zeros((n, size + 1), bool)  # the last column stands for empty slots
        found = np.full((n, width), -1)
        near = np.full((n, width), -np.inf)
        k = min(width, starts.shape[1])
        found[:, :k] = starts[:, :k]
        near[:, :k] = np.einsum("nd,nkd->nk", queries, self.vectors[found[:, :k]])
        near[:, :k][found[:, :k] < 0] = -np.inf
        seen[rows[:, None], found[:, :k]] = True
        seen[:, -1] = True
        order = np.argsort(-near, axis=1, kind="stable")
        found, near = np.take_along_axis(found, order, 1), np.take_along_axis(near, order, 1)
        opened = found < 0
        active = rows
        while len(active):
            # The nearest point of each query that is not yet opened.
            at = np.argmin(opened[active], axis=1)
            todo = ~opened[active, at]
            active, at = active[todo], at[todo]
            if not len(active):
                break
            opened[active, at] = True
            fresh = slots[found[active, at]]
            fresh = np.where(seen[active[:, None], fresh], -1, fresh)
            seen[active[:, None], fresh] = True
            score = np.einsum("nd,nkd->nk", queries[active], self.vectors[fresh])
            score[fresh < 0] = -np.inf
            ids = np.concatenate([found[active], fresh], 1)
            scores = np.concatenate([near[active], score], 1)
            closed = np.concatenate([opened[active], fresh < 0], 1)
            order = np.argsort(-scores, axis=1, kind="stable")[:, :width]
            found[active] = np.take_along_axis(ids, order, 1)
            near[active] = np.take_along_axis(scores, order, 1)
            opened[active] = np.take_along_axis(closed, order, 1)
        return found, near

    def descend(self, queries: np.ndarray, to: int, size: int) -> np.ndarray:
        """Entry points of each query for layer ``to``, walking down from the top."""
        starts = np.zeros((len(queries), 1), np.int64)
        for layer in range(len(self.layers) - 1, to, -1):
            if len(self.layers[layer]):
                starts = self.search(queries, 4, layer, starts, min(size, len(self.layers[layer])))[0]
        return starts

    def nearest(self, queries: np.ndarray, k: int, width: int = SEARCH_WIDTH) -> tuple[np.ndarray, np.ndarray]:
        """Up to ``k`` points of the shard nearest to each query, nearest first."""
        size = len(self.vectors)
        found, near = self.search(queries, max(width, k), 0, self.descend(queries, 0, size), size)
        return found[:, :k], near[:, :k]


def _thinned(vectors: np.ndarray, ids: np.ndarray, near: np.ndarray, links: int) -> np.ndarray:
    """The neighbours to keep of each row of candidates (nearest first, -1 empty).

    A candidate stays if it is nearer to the point than to any neighbour kept before
    it; free slots then go to the nearest left out.
    """
    n, width = ids.shape
    between = np.einsum("nkd,njd->nkj", vectors[ids], vectors[ids])
    kept = np.zeros((n, width), bool)
    for k in range(width):
        blocked = (kept[:, :k] & (between[:, k, :k] > near[:, k, None])).any(1) if k else np.zeros(n, bool)
        kept[:, k] = ~blocked & (ids[:, k] >= 0) & (kept[:, :k].sum(1) < links)
    rank = np.where(kept, np.arange(width), np.where(ids >= 0, width + np.arange(width), 3 * width))
    order = np.argsort(rank, axis=1, kind="stable")[:, :links]
    out = np.take_along_axis(ids, order, 1)
    return np.pad(out, ((0, 0), (0, links - out.shape[1])), constant_values=-1)


def build(vectors: np.ndarray, seed: int = 7) -> tuple[Graph, np.ndarray]:
    """The graph of unit vectors, and the order of the given rows in it."""
    n = len(vectors)
    level = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) * LEVEL_SCALE).astype(np.int64)
    order = np.argsort(-level, kind="stable")
    level = level[order]
    data = np.ascontiguousarray(vectors[order], np.float64)
    layers = [
        np.full((int((level >= layer).sum()), 2 * LINKS if layer == 0 else LINKS), -1, np.int64)
        for layer in range(int(level[0]) + 1)
    ]
    graph = Graph(data, layers)
    start = 1
    while start < n:
        # A batch is no larger than the graph that it searches.
        end = min(n, start + min(BATCH, start))
        points = np.arange(start, end)
        queries = data[points]
        starts = graph.descend(queries, int(level[start]), start) if len(layers) > 1 else np.zeros((len(points), 1), np.int64)
        for layer in range(int(level[start]), -1, -1):
            inside = level[points] >= layer
            size = min(start, len(layers[layer]))
            found, near = graph.search(queries, WIDTH, layer, starts, size)
            _link(graph, layer, points[inside], found[inside], near[inside])
            starts = found[:, :8]
        start = end
    _reach(graph)
    return graph, order


def _reached(slots: np.ndarray) -> np.ndarray:
    """Which points of a layer the entry leads to."""
    seen = np.zeros(len(slots) + 1, bool)  # the last stands for empty slots
    seen[[0, -1]] = True
    edge = np.array([0])
    while len(edge):
        ahead = np.unique(slots[edge])
        edge = ahead[~seen[ahead]]
        seen[edge] = True
    return seen[:-1]


def _reach(graph: Graph) -> None:
    """Links points of layer 0 that cannot be reached, each to a near point that can.

    That point takes it in a free slot; where no near one has any, a column is added.
    """
    while True:
        seen = _reached(graph.layers[0])
        if seen.all():
            return
        inside, outside = np.flatnonzero(seen), np.flatnonzero(~seen)
        for start in range(0, len(outside), BATCH):
            some = outside[start : start + BATCH]
            near = graph.vectors[some] @ graph.vectors[inside].T
            for point, order in zip(some, inside[np.argsort(-near, axis=1, kind="stable")[:, : 2 * LINKS]], strict=True):
                slots = graph.layers[0]
                free = (slots[order] < 0).any(1)
                host = order[free.argmax()]
                if not free.any():
                    graph.layers[0] = slots = np.pad(slots, ((0, 0), (0, 1)), constant_values=-1)
                slots[host, (slots[host] < 0).argmax()] = point


def _link(graph: Graph, layer: int, points: np.ndarray, found: np.ndarray, near: np.ndarray) -> None:
    """Links new points of a layer to those found, and to near points of their own batch."""
    slots, data = graph.layers[layer], graph.vectors
    if not len(points):
        return
    links = slots.shape[1]
    # Points of one batch did not see each other: they are candidates besides those found.
    own = data[points] @ data[points].T
    np.fill_diagonal(own, -np.inf)
    k = min(8, len(points) - 1)
    if k:
        mates = np.argsort(-own, axis=1, kind="stable")[:, :k]
        found = np.concatenate([found, points[mates]], 1)
        near = np.concatenate([near, np.take_along_axis(own, mates, 1)], 1)
        order = np.argsort(-near, axis=1, kind="stable")
        found, near = np.take_along_axis(found, order, 1), np.take_along_axis(near, order, 1)
    width = min(found.shape[1], 3 * LINKS)
    chosen = _thinned(data, found[:, :width], near[:, :width], LINKS)
    slots[points, :LINKS] = chosen
    # The other way: each chosen neighbour gets the new point, and thins its list if it is full.
    source = np.repeat(points, LINKS)
    target = chosen.reshape(-1)
    source, target = source[target >= 0], target[target >= 0]
    by = np.argsort(target, kind="stable")
    source, target = source[by], target[by]
    hit, first, counts = np.unique(target, return_index=True, return_counts=True)
    added = np.full((len(hit), int(counts.max())), -1)
    added[np.repeat(np.arange(len(hit)), counts), np.arange(len(target)) - np.repeat(first, counts)] = source
    every = np.concatenate([slots[hit], added], 1)
    # A point of the same batch may be there from both sides.
    every = np.sort(every, axis=1)
    every[:, 1:][every[:, 1:] == every[:, :-1]] = -1
    score = np.einsum("nd,nkd->nk", data[hit], data[every])
    score[every < 0] = -np.inf
    order = np.argsort(-score, axis=1, kind="stable")
    every, score = np.take_along_axis(every, order, 1), np.take_along_axis(score, order, 1)
    full = (every >= 0).sum(1) > links
    width = min(every.shape[1], links)
    slots[hit, :] = -1
    slots[hit, :width] = every[:, :width]
    if full.any():
        slots[hit[full]] = _thinned(data, every[full], score[full], links)


def usable(vector: Column) -> Column:
    """Whether a vector has numbers only, not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _with_directions(rows: DataFrame) -> DataFrame:
    """Adds a key that vectors of one direction share: unit components as whole numbers of 2^-40.

    Far above rounding and far below what a cosine in double precision can tell apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)
            sizes, values = np.diff(vectors.offsets.to_numpy()), vectors.flatten().to_numpy()
            starts = np.cumsum(sizes) - sizes
            keys: list[bytes] = [b""] * len(sizes)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                whole = np.rint(_unit(values[starts[at][:, None] + np.arange(size)]) * float(1 << 40)).astype("<i8")
                for row, key in zip(at, whole, strict=True):
                    keys[row] = key.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], ["vec_id", "v", "direction"])

    return rows.mapInArrow(run, "vec_id long, v array<double>, direction binary")


def index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The graphs of all shards, one row each, saved in the shared folder.

    ``vectors`` holds ``vec_id, embedding``. Vectors of one direction, copies and
    multiples, are one point: their cosines differ by rounding only, so all have that
    of the vector with the smallest id. The point carries its ``k + 1`` smallest ids:
    more of them can never be among the ``k`` nearest, so a direction that a third of
    all rows share is one point too. Vectors without an id, null, zero or
    with a component that is null or not finite take no part; an empty table has no
    graphs. Columns: ``shard, dim, points, layers, counts, ids`` with flat arrays as
    little-endian bytes.
    """
    rows = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    )
    nth = F.row_number().over(Window.partitionBy("direction").orderBy("vec_id"))
    points = _with_directions(rows).groupBy("vec_id", "direction").agg(F.min("v").alias("v"))
    points = points.withColumn("nth", nth).filter(F.col("nth") <= k + 1).groupBy("direction")
    points = saved(points.agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.min_by("v", "vec_id").alias("v")), "points")
    shards = max(1, -(-points.count() // shard_rows))
    dealt = points.select("ids", "v", F.pmod(F.xxhash64("direction"), F.lit(shards)).cast("int").alias("shard"))

    def built(table: pa.Table) -> pa.Table:
        # The order of rows in a group may differ when a lost task is repeated: sorting makes the graph the same.
        rows = sorted(zip(*(table.column(name).to_pylist() for name in ("ids", "v")), strict=True))
        out: dict[str, list] = {name: [] for name in _INDEX.names}
        for dim in sorted({len(v) for _, v in rows}):  # vectors of another length are a graph of their own
            some = [row for row in rows if len(row[1]) == dim]
            exact = np.array([v for _, v in some])
            graph, place = build(_unit(exact))
            ids = [some[at][0] for at in place]
            out["shard"].append(table.column("shard")[0].as_py())
            out["dim"].append(dim)
            out["points"].append(exact[place].astype("<f8").tobytes())
            out["layers"].append([layer.astype("<i4").tobytes() for layer in graph.layers])
            out["counts"].append(np.array([len(own) for own in ids], "<i4").tobytes())
            out["ids"].append(np.array([i for own in ids for i in own], "<i8").tobytes())
        return pa.table(out, schema=_INDEX)

    return saved(dealt.groupBy("shard").applyInArrow(built, _INDEX_SQL), "graphs")


_INDEX_SQL = "shard int, dim int, points binary, layers array<binary>, counts binary, ids binary"
_INDEX = pa.schema(
    [
        ("shard", pa.int32()),
        ("dim", pa.int32()),
        ("points", pa.binary()),
        ("layers", pa.list_(pa.binary())),
        ("counts", pa.binary()),
        ("ids", pa.binary()),
    ]
)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


@dataclass
class Shard:
    """A graph with its points' vectors and ids, those of point ``p`` from ``first[p]`` to ``first[p + 1]``."""

    graph: Graph
    vectors: np.ndarray
    first: np.ndarray
    ids: np.ndarray

    @staticmethod
    def opened(row: dict) -> Shard:
        vectors = np.frombuffer(row["points"], "<f8").reshape(-1, row["dim"])
        layers = [
            np.frombuffer(layer, "<i4").reshape(*((len(vectors), -1) if level == 0 else (-1, LINKS))).astype(np.int64)
            for level, layer in enumerate(row["layers"])
        ]
        first = np.concatenate([[0], np.cumsum(np.frombuffer(row["counts"], "<i4"))])
        return Shard(Graph(_unit(vectors), layers), vectors, first, np.frombuffer(row["ids"], "<i8"))

    def nearest(self, ids: np.ndarray, queries: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, id and cosine of the ``k`` nearest other vectors found for each query.

        Every point found is ranked with all it carries.
        """
        out = []
        points, _ = self.graph.nearest(_unit(queries), width, width)
        for own, query, found in zip(ids, queries, points, strict=True):
            found = found[found >= 0]
            vectors = self.vectors[found]
            cosine = (vectors @ query) / (np.linalg.norm(vectors, axis=1) * np.linalg.norm(query))
            theirs = np.concatenate([self.ids[self.first[p] : self.first[p + 1]] for p in found])
            cosine = np.repeat(cosine, self.first[found + 1] - self.first[found])
            theirs, cosine = theirs[theirs != own], cosine[theirs != own]
            best = np.lexsort((theirs, -cosine))[:k]
            out.append((np.full(len(best), own), theirs[best], cosine[best]))
        return tuple(np.concatenate(columns) for columns in zip(*out, strict=True))


_FOUND = "query_id long, vec_id long, score double"


def search(graphs: DataFrame, queries: DataFrame, k: int, width: int = SEARCH_WIDTH) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query, but never itself.

    ``graphs`` is an ``index`` made with the same ``k``. Every query goes to every
    shard, but a shard's graph is moved once, to the task in which its queries stream
    past it, and gives ``k`` rows per query; these are merged by the exact cosine in
    double precision, ties to the smaller id. Queries without an id or with an
    unusable vector take no part; of repeated ids the smallest vector is asked.
    Vectors of another length than the query's are no candidates. No graphs or no
    queries give no rows; other columns are not read.
    """
    shards = (graphs.agg(F.max("shard").alias("last")).first()["last"] or 0) + 1
    asked = queries.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    asked = saved(asked.groupBy("vec_id").agg(F.min(F.col("embedding").cast("array<double>")).alias("v")), "queries")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    # Graphs sort before the queries of their shard.
    together = graphs.withColumn("asks", F.lit(0)).unionByName(
        asked.select(every, "vec_id", "v", F.lit(1).alias("asks")), allowMissingColumns=True
    )
    ordered = together.repartition(shards, "shard").sortWithinPartitions("shard", "asks", "dim", "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, opened = None, {}
        for batch in batches:
            shard, asks = (batch.column(batch.schema.get_field_index(name)).to_numpy() for name in ("shard", "asks"))
            cuts = np.flatnonzero(np.diff(shard) | np.diff(asks)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(shard)], strict=True):
                rows = batch.slice(start, end - start)
                if shard[start] != at:
                    at, opened = shard[start], {}
                if not asks[start]:
                    opened |= {row["dim"]: Shard.opened(row) for row in rows.select(_INDEX.names).to_pylist()}
                    continue
                for block in range(0, rows.num_rows, QUERY_BLOCK):
                    some = rows.slice(block, QUERY_BLOCK).select(["vec_id", "v"]).to_pydict()
                    for dim, own in opened.items():
                        mine = [i for i, v in enumerate(some["v"]) if len(v) == dim]
                        if mine:
                            ids, vectors = np.array([some["vec_id"][i] for i in mine]), np.array([some["v"][i] for i in mine])
                            found = own.nearest(ids, vectors, k, width)
                            names = ("query_id", "vec_id", "score")
                            yield pa.RecordBatch.from_pydict({n: pa.array(c) for n, c in zip(names, found, strict=True)})

    found = ordered.mapInArrow(run, _FOUND)
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", nth).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
