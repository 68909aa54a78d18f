"""Minimum-cost-flow resharding: the fewest bytes move from old shards to new capacities.

Old shard sizes are supplies, new capacities are demands. A byte that stays costs
nothing, a byte that moves costs one, whatever the pair of shards; so a flow through one
hub states the problem with a number of edges linear in the shards, and the transfers
are paired off afterwards. They are the quotas that each old shard fills for each new one.
An old shard is laid out in a fixed order of blocks, hash ranges of bounded size, and its
quotas are cut from that order; a document goes where its middle byte falls. That misses a
cut by half a document, so long documents are dealt out first and shorter ones fill what is
then left of each quota. Files of shards that neither give nor take are left alone.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field
from itertools import accumulate
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.store import drop_staged, stage
from tidemill.session import scratch_path


@dataclass(frozen=True)
class Settings:
    old_shards: int = 32
    """Shards before; they keep their numbers."""
    new_shards: int = 40
    overhead: int = 16
    """Bytes that a document takes besides its text."""
    block_bytes: int = 64 << 20
    least_blocks: int = 64
    """Blocks of an old shard, at least; one block is ordered by one task."""
    classes: tuple[int, ...] = (8, 64)
    """Documents above such a part of a new shard's mean size are dealt out before the rest."""


def cheapest_flow(nodes: int, edges: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """The flow on each edge (from, to, capacity, cost >= 0) of a maximum flow of least cost.

    Shortest distances by Dijkstra's rule over costs less potentials; then as much flow as
    all shortest ways of that length hold together, before distances are looked at again.
    """
    graph: list[list[int]] = [[] for _ in range(nodes)]
    to, room, cost = [], [], []
    for a, b, capacity, price in edges:
        for tail, head, space, unit in ((a, b, capacity, price), (b, a, 0, -price)):
            graph[tail].append(len(to))
            to.append(head)
            room.append(space)
            cost.append(unit)
    potential = [0] * nodes

    def left(edge: int) -> int:
        return cost[edge] + potential[to[edge ^ 1]] - potential[to[edge]]

    def shortest() -> list[float]:
        distance: list[float] = [float("inf")] * nodes
        distance[source], queue = 0, [(0, source)]
        while queue:
            so_far, node = heapq.heappop(queue)
            if so_far > distance[node]:
                continue
            for edge in graph[node]:
                if room[edge] and so_far + left(edge) < distance[to[edge]]:
                    distance[to[edge]] = so_far + left(edge)
                    heapq.heappush(queue, (distance[to[edge]], to[edge]))
        return distance

    def levels() -> list[int]:
        level, reached = [-1] * nodes, [source]
        level[source] = 0
        for node in reached:
            for edge in graph[node]:
                if room[edge] and level[to[edge]] < 0 and not left(edge):
                    level[to[edge]] = level[node] + 1
                    reached.append(to[edge])
        return level

    def fill(level: list[int]) -> None:
        tried, path, node = [0] * nodes, [], source
        while True:
            if node == sink:
                step = min(room[edge] for edge in path)
                for edge in path:
                    room[edge] -= step
                    room[edge ^ 1] += step
                path, node = [], source
            ways = graph[node]
            while tried[node] < len(ways):
                edge = ways[tried[node]]
                if room[edge] and level[to[edge]] == level[node] + 1 and not left(edge):
                    break
                tried[node] += 1
            if tried[node] < len(ways):
                path.append(edge)
                node = to[edge]
            elif path:
                node = to[path.pop() ^ 1]
                tried[node] += 1
            else:
                return

    while True:
        distance = shortest()
        if distance[sink] == float("inf"):
            return [room[2 * k + 1] for k in range(len(edges))]
        potential = [p + (d if d < float("inf") else 0) for p, d in zip(potential, distance)]
        while (level := levels())[sink] >= 0:
            fill(level)


def transfers(sizes: list[int], capacities: list[int]) -> list[list[tuple[int, int]]]:
    """For each old shard, (new shard, bytes) in order, first what stays; sums are equal.

    Old shard k is new shard k, if there is one.
    """
    olds, news = len(sizes), len(capacities)
    source, sink, hub = olds + news, olds + news + 1, olds + news + 2
    total = sum(sizes)
    edges = [(source, k, size, 0) for k, size in enumerate(sizes)]
    edges += [(olds + k, sink, capacity, 0) for k, capacity in enumerate(capacities)]
    edges += [(k, olds + k, total, 0) for k in range(min(olds, news))]
    edges += [(k, hub, total, 1) for k in range(olds)] + [(hub, olds + k, total, 0) for k in range(news)]
    flow = cheapest_flow(olds + news + 3, edges, source, sink)
    shared = min(olds, news)
    base = olds + news
    plan = [[(k, flow[base + k])] if k < shared and flow[base + k] else [] for k in range(olds)]
    given = flow[base + shared : base + shared + olds]
    wanted = flow[base + shared + olds :]
    taker = 0
    for giver in range(olds):
        while given[giver]:
            while not wanted[taker]:
                taker += 1
            step = min(given[giver], wanted[taker])
            plan[giver].append((taker, step))
            given[giver] -= step
            wanted[taker] -= step
    return plan


def equal_parts(total: int, parts: int) -> list[int]:
    return [total * (k + 1) // parts - total * k // parts for k in range(parts)]


def hashed_shard(shards: int) -> Column:
    """The usual layout by a hash of doc_id; of the text, where there is none."""
    return F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(shards)).cast("int")


def sized(docs: DataFrame, settings: Settings, old: Column | None = None) -> DataFrame:
    """The rows of ``docs`` as a struct ``document``, their doc_id, and a struct ``layout`` of
    size, checksum, old shard and place in the old shard's order."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.struct(*docs.columns).alias("document"),
        "doc_id",
        F.struct(
            (F.octet_length(text) + settings.overhead).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
            (hashed_shard(settings.old_shards) if old is None else old.cast("int")).alias("old"),
            F.xxhash64(F.lit("place"), "doc_id", text).alias("place"),
        ).alias("layout"),
    )


UNIT = ["old", "klass", "block"]


@dataclass
class Plan:
    blocks: int
    bounds: list[float]
    """Sizes that divide the classes, descending."""
    quotas: list[list[tuple[int, int]]]
    """The flow: for each old shard, (new shard, bytes) in order, first what stays."""
    moves: list[list[list[tuple[int, int]]]] = field(default_factory=list)
    """The same for each class: its part of the quotas."""
    starts: DataFrame | None = None
    """(old, klass, block, offset): bytes of the class in the old shard before each block."""
    slots: DataFrame | None = None
    """(old, klass, block, shard, base, first): documents of the shard before this piece, and
    the rank of the piece's first document in its block."""

    @property
    def affected(self) -> set[int]:
        """Shards that give or take."""
        moved = [(old, new) for old, row in enumerate(self.quotas) for new, _ in row if old != new]
        return {old for old, _ in moved} | {new for _, new in moved}

    @property
    def moved_bytes(self) -> int:
        return sum(size for old, row in enumerate(self.quotas) for new, size in row if old != new)


def positions(rows: DataFrame, found: Plan, carried: list[str]) -> DataFrame:
    """Class, block and middle byte in the block of each row of ``sized``, in order of a hash."""
    klass = F.lit(len(found.bounds))
    for number, bound in reversed(list(enumerate(found.bounds))):
        klass = F.when(F.col("layout.size") > bound, number).otherwise(klass)
    block = F.pmod("layout.place", F.lit(found.blocks)).cast("int")
    flat = rows.select(*carried, "layout.*", klass.alias("klass"), block.alias("block"))
    order = Window.partitionBy(*UNIT).orderBy("place", "doc_id", "crc")
    until = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return flat.withColumns({"middle": until - F.floor(F.col("size") / 2), "rank": F.row_number().over(order)})


def _parts(left: list[int], quotas: list[int], later: int, supply: int) -> list[int]:
    """Bytes of one class for each quota of an old shard: what is left but for its part of later classes."""
    total = sum(quotas) or 1
    free = [max(0, room - later * quota // total) for room, quota in zip(left, quotas)]
    if not sum(free):
        free = quotas
    sums = [0, *accumulate(free)]
    return [supply * high // sums[-1] - supply * low // sums[-1] for low, high in zip(sums, sums[1:])]


def plan(docs: DataFrame, settings: Settings = Settings(), old: Column | None = None, capacities: list[int] | None = None) -> Plan:
    """Solve the transfers for (doc_id, text, ...); only sums by shard reach the driver.

    ``capacities`` are the bytes wanted in each new shard (by default equal parts of the
    total; else they must sum to it).
    """
    spark = docs.sparkSession
    rows = stage(sized(docs, settings, old).select("doc_id", "layout"), "layout")
    sums = rows.groupBy("layout.old").agg(F.sum("layout.size").alias("bytes"))
    most = {row["old"]: row["bytes"] for row in sums.toLocalIterator()}
    total = sum(most.values())
    wanted = capacities or equal_parts(total, settings.new_shards)
    if sum(wanted) != total:
        raise ValueError("capacities must sum to the size of all documents")
    bounds = [total / max(1, len(wanted)) / part for part in settings.classes]
    blocks = max(settings.least_blocks, ceil(max(most.values(), default=0) / settings.block_bytes))
    sizes = [most.get(old, 0) for old in range(max([settings.old_shards, *(k + 1 for k in most)]))]
    found = Plan(blocks, bounds, transfers(sizes, wanted))

    placed = stage(positions(rows, found, ["doc_id"]), "positions")
    drop_staged(rows)
    units = placed.groupBy(*UNIT).agg(F.sum("size").alias("bytes"))
    order = Window.partitionBy("old", "klass").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    found.starts = stage(units.select(*UNIT, F.coalesce(F.sum("bytes").over(order), F.lit(0)).alias("offset")), "starts")
    supplies = [[0] * len(sizes) for _ in range(len(bounds) + 1)]
    for row in placed.groupBy("klass", "old").agg(F.sum("size").alias("bytes")).toLocalIterator():
        supplies[row["klass"]][row["old"]] = row["bytes"]
    left = [dict(row) for row in found.quotas]
    for number, supply in enumerate(supplies):
        later = [sum(part[old] for part in supplies[number + 1 :]) for old in range(len(sizes))]
        moves = []
        for old, quotas in enumerate(found.quotas):
            parts = _parts(list(left[old].values()), [size for _, size in quotas], later[old], supply[old])
            moves.append([(new, part) for (new, _), part in zip(quotas, parts) if part])
        found.moves.append(moves)
        if sum(later) and sum(supply):
            dealt = _sharded(placed.where(F.col("klass") == number), found, spark).groupBy("old", "shard").agg(F.sum("size").alias("bytes"))
            for row in dealt.toLocalIterator():
                left[row["old"]][row["shard"]] -= row["bytes"]

    pieces = _sharded(placed, found, spark).groupBy(*UNIT, "shard").agg(F.count("*").alias("documents"), F.min("rank").alias("first"))
    order = Window.partitionBy("shard").orderBy(*UNIT).rowsBetween(Window.unboundedPreceding, -1)
    slots = pieces.withColumn("base", F.coalesce(F.sum("documents").over(order), F.lit(0))).drop("documents")
    found.slots = stage(slots, "slots")
    drop_staged(placed)
    return found


def _sharded(placed: DataFrame, found: Plan, spark: SparkSession) -> DataFrame:
    """``placed`` with the new shard of each row: the first cut at or after its middle byte."""
    cuts = []
    for klass, olds in enumerate(found.moves):
        for old, row in enumerate(olds):
            ends = [(end, new) for (new, _), end in zip(row, accumulate(size for _, size in row))]
            if ends:
                cuts.append((old, klass, ends))
    table = spark.createDataFrame(cuts, "old int, klass int, cuts array<struct<end:long,new:int>>")
    at = placed.join(found.starts, UNIT).withColumn("at", F.col("offset") + F.col("middle"))
    # One row a class and shard, and in a class as many cuts as there are old and new shards.
    met = at.join(F.broadcast(table), ["old", "klass"])
    return met.withColumn("shard", F.element_at(F.filter("cuts", lambda cut: F.col("at") <= cut["end"]), 1)["new"]).drop("cuts")


def rewrite(docs: DataFrame, found: Plan, folder: str, settings: Settings = Settings(), old: Column | None = None, only: set[int] | None = None) -> DataFrame:
    """Write documents into ``folder``/shard=k with slot and size, and read them back.

    With ``only`` (such as ``found.affected``), the other shards are neither read into the
    order nor written: their old files hold what they held. Columns of ``docs`` come back
    in a struct ``document``, so that no name can clash.
    """
    rows = sized(docs, settings, old)
    if only is not None:
        rows = rows.where(F.col("layout.old").isin(sorted(only))) if only else rows.where(F.lit(False))
    placed = _sharded(positions(rows, found, ["document", "doc_id"]), found, docs.sparkSession)
    slot = F.col("base") + F.col("rank") - F.col("first")
    slotted = placed.join(found.slots, [*UNIT, "shard"]).select(
        "document", "size", F.col("crc").alias("text_crc32"), slot.cast("long").alias("slot"), "shard"
    )
    slotted.write.option("compression", "zstd").partitionBy("shard").parquet(folder)
    return docs.sparkSession.read.schema(slotted.schema).parquet(folder)


def digest(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Reshard (doc_id, text, ...) from a hashed layout to more shards of equal bytes.

    Returns one row a document, from the files written: a null text has only the overhead
    and the checksum of no bytes; rows without doc_id are dealt by their text, and rows that
    repeat are told apart by nothing but their order.
    """
    folder = scratch_path(docs.sparkSession, "shards")
    rows = rewrite(docs.select("doc_id", "text"), plan(docs, settings), folder, settings)
    return rows.select(
        "document.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
