"""Nearest neighbours by a hierarchical navigable small-world graph for each shard.

Equal vectors are one node, which keeps the least ids it needs. Nodes are dealt to shards
of bounded size by a hash. A task builds the graph of a shard and stores it as one row of
flat neighbour arrays: nodes are in order of falling level, so that the nodes of a layer
are the first ones of the shard and the links of a layer are one matrix of node numbers.
Queries visit every shard; the best of all shards are merged. Scores are computed in
double precision on the vectors themselves.

Nodes are put into a layer in batches that double: each batch searches the graph as it is,
side by side in numpy, meets its own members directly, and is then linked in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.store import drop_staged, grouped, stage
from tidemill.llm.vectors import finite, matrix


@dataclass(frozen=True)
class Settings:
    nearest: int = 5
    """Neighbours wanted of each query."""
    every: int = 50
    """Rows whose vec_id this divides are queries."""
    links: int = 16
    """Links of a node in upper layers; the ground layer has twice as many, and one node in
    so many reaches the next layer."""
    build_width: int = 64
    """Candidates kept while a node looks for its links."""
    search_width: int = 128
    """Candidates kept while a query is searched."""
    shard_nodes: int = 8192
    shard_bytes: int = 64 << 20
    """Most bytes of vectors in a shard; longer vectors mean fewer nodes."""
    slice_queries: int = 1 << 16
    """Queries that one task searches in a shard."""
    batch: int = 1024
    """Most nodes put in, or queries searched, side by side."""


INDEX = "shard int, nodes int, vectors binary, members array<array<long>>, layers array<binary>"
RESULT = "query_id long, twin long, vec_id long, score double"


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows brought to length one, in single precision."""
    scaled = in_range(vectors)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def in_range(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two, so that no square overflows or vanishes; angles stay exactly."""
    _, exponent = np.frexp(np.abs(vectors).max(1, keepdims=True))
    return np.ldexp(vectors, -exponent)


def cosine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosines of pairs of rows."""
    left, right = in_range(left), in_range(right)
    return (left * right).sum(1) / (np.sqrt((left * left).sum(1)) * np.sqrt((right * right).sum(1)))


def nearest_first(ids: np.ndarray, near: np.ndarray, *others: np.ndarray) -> list[np.ndarray]:
    """Candidates of each row in order of falling nearness."""
    order = np.argsort(-near, 1, kind="stable")
    return [np.take_along_axis(part, order, 1) for part in (ids, near, *others)]


def ragged(rows: np.ndarray, ids: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, candidate, nearness) as one padded line for each distinct row: rows, ids, nearness."""
    order = np.argsort(rows, kind="stable")
    rows, ids, near = rows[order], ids[order], near[order]
    known, first, count = np.unique(rows, return_index=True, return_counts=True)
    line = np.repeat(np.arange(len(known)), count)
    place = np.arange(len(rows)) - np.repeat(first, count)
    shape = len(known), int(count.max()) if len(known) else 0
    out, score = np.full(shape, -1, np.int32), np.full(shape, -np.inf, np.float32)
    out[line, place], score[line, place] = ids, near
    return known, out, score


def beam(
    vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int, known: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest nodes met by each query, nearest first; -1 where there are fewer.

    Every query keeps its best nodes and opens the nearest unopened one, until all it
    keeps are open. Only nodes below ``known`` are linked yet.
    """
    shape = len(queries), width
    ids, near, opened = np.full(shape, -1, np.int32), np.full(shape, -np.inf, np.float32), np.ones(shape, bool)
    seen = np.zeros((len(queries), known), bool)
    live = np.arange(len(queries))
    ids[:, 0], near[:, 0], opened[:, 0] = entry, np.einsum("ij,ij->i", vectors[entry], queries), False
    seen[live, entry] = True
    while len(live):
        best = np.where(opened[live], -np.inf, near[live]).argmax(1)
        opened[live, best] = True
        met = links[ids[live, best]]
        rows, met = np.repeat(live, met.shape[1]), met.ravel()
        fresh = met >= 0
        rows, met = rows[fresh], met[fresh]
        fresh = ~seen[rows, met]
        rows, met = rows[fresh], met[fresh]
        seen[rows, met] = True
        score = np.einsum("ij,ij->i", vectors[met], queries[rows])
        better = score > near[rows, -1]
        changed, new, score = ragged(rows[better], met[better], score[better])
        if len(changed):
            both = [
                np.concatenate(pair, 1)
                for pair in ((ids[changed], new), (near[changed], score), (opened[changed], new < 0))
            ]
            for kept, found in zip((ids, near, opened), nearest_first(*both)):
                kept[changed] = found[:, :width]
        live = live[~opened[live].all(1)]
    return ids, near


def diverse(vectors: np.ndarray, ids: np.ndarray, near: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row's candidates, nearest first, at most ``most``: those nearer to the row's own
    node than to any candidate taken before, then the nearest of the others."""
    rows, count = ids.shape
    own = vectors[np.maximum(ids, 0)]
    between = own @ own.transpose(0, 2, 1)
    taken = np.zeros((rows, count), bool)
    for place in range(count):
        hidden = (taken[:, :place] & (between[:, place, :place] > near[:, place : place + 1])).any(1)
        taken[:, place] = (ids[:, place] >= 0) & ~hidden & (taken[:, :place].sum(1) < most)
    order = np.argsort(np.where(taken, 0, np.where(ids >= 0, count, 2 * count)) + np.arange(count), 1)[:, :most]
    gap = ((0, 0), (0, max(0, most - count)))
    out = np.pad(np.take_along_axis(ids, order, 1), gap, constant_values=-1)
    return out, np.pad(np.take_along_axis(near, order, 1), gap, constant_values=-np.inf)


def without_doubles(ids: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each candidate of a row once, nearest first."""
    order = np.argsort(ids, 1, kind="stable")
    again = np.zeros(ids.shape, bool)
    in_order = np.take_along_axis(ids, order, 1)
    np.put_along_axis(again, order[:, 1:], in_order[:, 1:] == in_order[:, :-1], 1)
    return tuple(nearest_first(np.where(again, -1, ids), np.where(again, -np.inf, near)))


def layer(vectors: np.ndarray, most: int, descend: Callable[[np.ndarray, int], np.ndarray], settings: Settings) -> np.ndarray:
    """The links of one layer over all ``vectors``; ``descend`` finds entries in the layers above."""
    n, width = len(vectors), settings.build_width
    links, near = np.full((n, most), -1, np.int32), np.full((n, most), -np.inf, np.float32)
    first = 0
    while first < n:
        end = min(n, first + min(settings.batch, max(first, 4 * width)))
        fresh = vectors[first:end]
        inner = fresh @ fresh.T
        np.fill_diagonal(inner, -np.inf)
        ids = np.argsort(-inner, 1, kind="stable")[:, :width]
        score = np.take_along_axis(inner, ids, 1)
        ids = np.where(score > -np.inf, ids + first, -1).astype(np.int32)
        if first:
            found = beam(vectors, links, fresh, descend(fresh, first), width, first)
            ids, score = nearest_first(np.concatenate([ids, found[0]], 1), np.concatenate([score, found[1]], 1))
        links[first:end], near[first:end] = diverse(vectors, ids[:, :width], score[:, :width], most)
        # Whom a new node links to links back, if it has room or the new node is the better link.
        source, target = np.repeat(np.arange(first, end), most), links[first:end].ravel()
        order = np.argsort(-near[first:end].ravel(), kind="stable")
        order = order[target[order] >= 0]
        back, offered, score = ragged(target[order], source[order], near[first:end].ravel()[order])
        if len(back):
            ids = np.concatenate([links[back], offered[:, :most]], 1)
            score = np.concatenate([near[back], score[:, :most]], 1)
            links[back], near[back] = diverse(vectors, *without_doubles(ids, score), most)
        first = end
    return links


def build(vectors: np.ndarray, settings: Settings) -> list[np.ndarray]:
    """Layers of links, the ground layer first; a layer's nodes are the first ones."""
    sizes = [len(vectors)]
    while sizes[-1] > settings.links:
        sizes.append(max(1, sizes[-1] // settings.links))
    layers: list[np.ndarray] = []
    for size in reversed(sizes):
        above = list(layers)

        def descend(queries, known):
            # Nodes of the layer above are linked first; before that, all start at the first node.
            linked = above if above and len(above[-1]) <= known else []
            return entries(vectors, linked, queries)

        most = settings.links * (2 if size == len(vectors) else 1)
        layers.append(layer(vectors[:size], most, descend, settings))
    return layers[::-1]


def entries(vectors: np.ndarray, above: list[np.ndarray], queries: np.ndarray) -> np.ndarray:
    """Where each query enters the next layer: the nearest node met in the layers above, from the top."""
    at = np.zeros(len(queries), np.int64)
    for links in above:
        at = beam(vectors, links, queries, at, 1, len(links))[0][:, 0].astype(np.int64)
    return at


def search(vectors: np.ndarray, layers: list[np.ndarray], queries: np.ndarray, width: int) -> np.ndarray:
    """The nodes nearest to each query that the graph leads to, nearest first; -1 pads."""
    at = entries(vectors, layers[:0:-1], queries)
    return beam(vectors, layers[0], queries, at, width, len(vectors))[0]


def nodes(rows: DataFrame, settings: Settings) -> DataFrame:
    """(vector, members) of each distinct vector: the least ids, one more than are wanted."""
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    least = rows.dropDuplicates(["vec_id", "vector"]).withColumn("place", place)
    least = least.where(F.col("place") <= settings.nearest + 1)
    return least.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("members"))


def index(rows: DataFrame, length: int, settings: Settings = Settings()) -> tuple[DataFrame, int]:
    """The graphs of all shards, one row each, written; and the number of shards."""
    found = stage(nodes(rows, settings), "nodes")
    most = max(2, min(settings.shard_nodes, settings.shard_bytes // (8 * length)))
    shards = max(1, ceil(found.count() / most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["shard"]):
            vectors = matrix(group["vector"], length)
            layers = build(unit(vectors), settings)
            columns = [
                group["shard"][:1].combine_chunks().cast(pa.int32()),
                pa.array([len(vectors)], pa.int32()),
                pa.array([vectors.astype("<f8").tobytes()], pa.binary()),
                pa.array([group["members"].to_pylist()], pa.list_(pa.list_(pa.int64()))),
                pa.array([[links.astype("<i4").tobytes() for links in layers]], pa.list_(pa.binary())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "nodes", "vectors", "members", "layers"])

    # In order of a hash, so that the first nodes, which make the upper layers, are a fair sample.
    dealt = found.select(F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"), "vector", "members")
    dealt = dealt.withColumn("place", F.xxhash64("vector", F.lit(1)))
    placed = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "place", "vector")
    graphs = stage(placed.mapInArrow(run, INDEX), "graphs")
    drop_staged(found)
    return graphs, shards


class Graph:
    """A shard's row of the index, opened."""

    def __init__(self, row: dict, length: int, settings: Settings):
        self.settings = settings
        self.vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, length)
        self.units = unit(self.vectors)
        ground = [2 * settings.links] + [settings.links] * (len(row["layers"]) - 1)
        self.layers = [np.frombuffer(part, "<i4").reshape(-1, most) for part, most in zip(row["layers"], ground)]
        counts = np.array([len(ids) for ids in row["members"]])
        self.ids = np.array([i for ids in row["members"] for i in ids], np.int64)
        self.first, self.count = np.cumsum(counts) - counts, counts

    def nearest(self, query_id: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, vec_id, score) of each query's nearest rows but its own, best first."""
        s = self.settings
        width = max(s.search_width, 2 * (s.nearest + 1))
        met = search(self.units, self.layers, unit(vectors), width)[:, : 2 * (s.nearest + 1)]
        query, place = np.nonzero(met >= 0)
        node = met[query, place]
        score = cosine(vectors[query], self.vectors[node])
        count = self.count[node]
        query, score = np.repeat(query, count), np.repeat(score, count)
        ids = self.ids[np.repeat(self.first[node] - np.cumsum(count) + count, count) + np.arange(count.sum())]
        other = ids != query_id[query]
        query, ids, score = query[other], ids[other], score[other]
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        _, first, count = np.unique(query, return_index=True, return_counts=True)
        best = np.arange(len(query)) - np.repeat(first, count) < s.nearest
        return query[best], ids[best], score[best]


def searched(queries: DataFrame, graphs: DataFrame, shards: int, length: int, settings: Settings = Settings()) -> DataFrame:
    """(query_id, twin, vec_id, score): the nearest rows of each shard to each of (vec_id, vector).

    A task takes one graph and a slice of the queries, which stream past it.
    """
    slices = max(1, ceil(queries.count() / settings.slice_queries))
    each = lambda number: F.explode(F.sequence(F.lit(0), F.lit(number - 1)))
    dealt = queries.select(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(slices)).cast("int").alias("slice"), "vec_id", "vector")
    asked = dealt.select(each(shards).alias("shard"), "slice", "vec_id", F.xxhash64("vector").alias("twin"), "vector")
    copies = graphs.select(each(slices).alias("slice"), "*")
    rows = copies.unionByName(asked, allowMissingColumns=True)
    place = F.col("shard") * slices + F.col("slice")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A partition is one graph, first in order, and its queries.
        graph = None
        for batch in batches:
            asks = batch.filter(batch.column("layers").is_null())
            for row in batch.filter(batch.column("layers").is_valid()).to_pylist():
                graph = Graph(row, length, settings)
            for start in range(0, asks.num_rows if graph else 0, settings.batch):
                part = asks.slice(start, settings.batch)
                query_id, twin = part.column("vec_id").to_numpy(), part.column("twin").to_numpy()
                query, ids, score = graph.nearest(query_id, matrix(part.column("vector"), length))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_id[query]), pa.array(twin[query]), pa.array(ids), pa.array(score)],
                    ["query_id", "twin", "vec_id", "score"],
                )

    placed = rows.repartitionById(shards * slices, place).sortWithinPartitions(F.col("layers").isNull())
    return placed.mapInArrow(run, RESULT)


def nearest(table: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(query_id, rank, vec_id, score): the rows nearest by cosine to each row whose vec_id
    ``every`` divides, nearest first, ties to the smaller vec_id.

    Of ``table`` only vec_id and embedding are read. Rows take no part if they have no
    vec_id, if the vector is null, empty, all zeros, or holds a null, NaN or infinity, or if
    its length is not the commonest. Equal rows are one row. Rows that share a vec_id and
    differ in vector are queries of their own, and no neighbours of one another. A table
    without rows, or with one, gives none.
    """
    rows, length = finite(table)
    rows = rows.where(F.col("vec_id").isNotNull() & F.exists("vector", lambda c: c != 0))
    # One zero: as group keys, vectors that differ in the sign of a zero would be two.
    rows = rows.withColumn("vector", F.transform("vector", lambda c: c + F.lit(0.0)))
    graphs, shards = index(rows, max(1, length), settings)
    queries = rows.where(F.pmod("vec_id", F.lit(settings.every)) == 0).distinct()
    found = searched(queries, graphs, shards, max(1, length), settings)
    order = Window.partitionBy("query_id", "twin").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")

