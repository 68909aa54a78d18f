"""URL filters: rules by host and path, and trust carried along the host graph.

What no rule decides, the graph does: trust flows from hosts with allowed pages along
links (who is linked from trusted hosts is trusted), distrust flows from hosts with
blocked pages against them (who links to blocked hosts is distrusted), both as
personalised PageRank. A host and its parent domain count as linked both ways.

The graph is cut into blocks of bounded size along domains, as most links stay within
one. A task walks through a block until its ranks have settled, given what flows in from
other blocks; Spark then carries ranks over the links between blocks, and blocks are walked
again, until what flows between them has settled too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.store import drop_staged, grouped, stage


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(verdict, host, slash + path)


RULES = tuple(
    rule(*r)
    for r in (
        ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
    )
)


@dataclass(frozen=True)
class Settings:
    rules: tuple[Rule, ...] = RULES
    damping: float = 0.85
    tolerance: float = 1e-12
    """A walk ends when its last step changes no host's rank by a larger part of it."""
    alike: float = 1e-9
    """Trust and distrust that differ by no larger part are equal."""
    rounds: int = 10_000
    """Exchanges between blocks after which ranks that have not settled are an error."""
    block_rows: int = 500_000
    """Hosts and links of a block, about."""
    ratio: float = 1.0
    """A host is blocked when its distrust exceeds this many times its trust."""


A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'<>\s]+)"""


def lowered(text: Column) -> Column:
    return F.translate(text, A_TO_Z, A_TO_Z.lower())


def located(pages: DataFrame) -> DataFrame:
    """page_id, html, host and path of each row; without ``://`` both are empty."""
    at = F.locate("://", F.col("url"))
    rest = F.when(at > 0, F.col("url").substr(at + 3, F.length("url"))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return pages.select(
        "page_id", "html",
        lowered(F.regexp_extract(rest, r"^[^/?#]*", 0)).alias("host"),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def decided(settings: Settings) -> tuple[Column, Column]:
    """The longest rule that fits host and path, and its verdict; null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for one in sorted(settings.rules, key=lambda r: (len(r.text), r.text)):
        host = F.col("host")
        fits = ((host == one.host) | host.endswith("." + one.host)) & F.col("path").startswith(one.path)
        text = F.when(fits, one.text).otherwise(text)
        verdict = F.when(fits, one.verdict).otherwise(verdict)
    return text, verdict


def edges(rows: DataFrame) -> DataFrame:
    """Distinct (src, dst) of hosts: links in the markup, and hosts with their parent domains.

    A parent drops the first label and keeps at least two, so that no top-level domain
    joins strangers.
    """
    found = F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))
    linked = rows.where("html is not null").select(F.col("host").alias("src"), F.explode(found).alias("dst"))
    linked = linked.select("src", lowered(F.col("dst")).alias("dst")).distinct()
    hosts = rows.select("host").unionByName(linked.select(F.col("dst").alias("host"))).distinct()
    labels = F.split("host", r"\.")
    parents = F.transform(
        F.sequence(F.lit(2), F.greatest(F.size(labels), F.lit(2))),
        lambda n: F.array_join(F.slice(labels, -n, n), "."),
    )
    chains = hosts.where(F.size(labels) > 2).select(parents.alias("chain"))
    steps = chains.select(F.explode(F.arrays_zip(F.slice("chain", 1, F.size("chain") - 1).alias("a"), F.slice("chain", 2, F.size("chain") - 1).alias("b"))).alias("s"))
    steps = steps.select("s.a", "s.b").distinct()
    both = steps.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(steps.select(F.col("b").alias("src"), F.col("a").alias("dst")))
    return linked.unionByName(both).where("src <> dst and src <> '' and dst <> ''").distinct()


BLOCK = "block int, hosts array<string>, seeds binary, ends binary, weights binary"
RANKS = "host string, trust double, distrust double"


def walks(links: DataFrame, damping: float) -> DataFrame:
    """(at, host, f, b): the part of its trust, and of its distrust, that ``at`` hands to ``host``.

    Trust goes from src to dst in equal parts, distrust from dst to src.
    """
    outward = links.groupBy("src").agg(F.count("*").alias("out"))
    inward = links.groupBy("dst").agg(F.count("*").alias("into"))
    weighed, none = links.join(outward, "src").join(inward, "dst"), F.lit(0.0)
    forward = weighed.select(F.col("src").alias("at"), F.col("dst").alias("host"), (damping / F.col("out")).alias("f"), none.alias("b"))
    return forward.unionByName(
        weighed.select(F.col("dst").alias("at"), F.col("src").alias("host"), none.alias("f"), (damping / F.col("into")).alias("b"))
    )


def placed(nodes: DataFrame, ways: DataFrame, settings: Settings) -> tuple[DataFrame, int]:
    """(host, block) and the number of blocks: domains stay whole unless they are large."""
    family = F.substring_index("host", ".", -2).alias("family")
    rows = nodes.select("host", family).unionByName(ways.select("host", family))
    sizes = rows.groupBy("family").agg(F.count("*").alias("size"))
    blocks = ceil((sizes.agg(F.sum("size")).first()[0] or 0) / settings.block_rows) or 1
    split = sizes.select("family", F.ceil(F.col("size") * 4 / settings.block_rows).alias("parts"))
    own = F.pmod(F.xxhash64("host"), "parts")
    block = F.pmod(F.xxhash64("family", own), F.lit(blocks)).cast("int").alias("block")
    return nodes.select("host", family).join(split, "family").select("host", block), blocks


def packed(nodes: DataFrame, inner: DataFrame, blocks: int) -> DataFrame:
    """A row for each block: its hosts, their seeds, and the walks between them as flat arrays."""
    seeds = nodes.select("block", "host", F.lit(None).cast("string").alias("at"), F.col("trust").alias("f"), F.col("distrust").alias("b"))
    rows = seeds.unionByName(inner.select("block", "host", "at", "f", "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["block"]):
            seeded = group["at"].is_null()
            own, ways = group.filter(seeded), group.filter(pa.compute.invert(seeded))
            hosts = own["host"].to_pylist()
            number = {host: at for at, host in enumerate(hosts)}
            ends = np.array([[number[h] for h in ways[side].to_pylist()] for side in ("at", "host")], "<i4")
            values = [np.array([part["f"].to_numpy(), part["b"].to_numpy()], "<f8").tobytes() for part in (own, ways)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([group["block"][0].as_py()], pa.int32()), pa.array([hosts], pa.list_(pa.string())), *[pa.array([v], pa.binary()) for v in (values[0], ends.tobytes(), values[1])]],
                ["block", "hosts", "seeds", "ends", "weights"],
            )

    dealt = rows.repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "host", "at")
    return dealt.mapInArrow(run, BLOCK)


def settled(seeds: np.ndarray, ends: np.ndarray, weights: np.ndarray, tolerance: float) -> np.ndarray:
    """Ranks (trust, distrust) of one block's hosts: steps from the seeds until none changes."""
    now = seeds
    while True:
        after = np.array([
            seed + np.bincount(ends[1], weight * rank[ends[0]], len(seed)) for seed, weight, rank in zip(seeds, weights, now)
        ])
        grown = np.divide(after - now, after, out=np.zeros_like(after), where=after > 0)
        now = after
        if grown.max(initial=0.0) <= tolerance:
            return now


def solved(graph: DataFrame, inflow: DataFrame | None, blocks: int, settings: Settings) -> DataFrame:
    """(host, trust, distrust) of all blocks, given what (block, host, trust, distrust) flows in."""
    rows = graph
    if inflow is not None:
        rows = graph.unionByName(inflow, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["block"]):
            row = group.slice(0, 1).to_pylist()[0]
            hosts, number = row["hosts"], len(row["hosts"])
            seeds = np.frombuffer(row["seeds"], "<f8").reshape(2, number).copy()
            ends = np.frombuffer(row["ends"], "<i4").reshape(2, -1)
            weights = np.frombuffer(row["weights"], "<f8").reshape(2, -1)
            if group.num_rows > 1:
                places = {host: at for at, host in enumerate(hosts)}
                given = group.slice(1)
                at = [places[host] for host in given["host"].to_pylist()]
                seeds[:, at] += np.array([given["trust"].to_numpy(), given["distrust"].to_numpy()])
            ranks = settled(seeds, ends, weights, settings.tolerance)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *map(pa.array, ranks)], ["host", "trust", "distrust"])

    # The block itself comes first, then what flows into it.
    dealt = rows.repartitionById(blocks, F.col("block")).sortWithinPartitions("block", F.col("hosts").isNull())
    return dealt.mapInArrow(run, RANKS)


def propagated(seeds: DataFrame, links: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(host, trust, distrust) from seeds of those columns over links (src, dst).

    A walk ends at a host without links in its direction. Ranks only grow: if nothing that
    flows between blocks has grown by a larger part than ``tolerance``, no rank has either.
    A host far from all seeds is reached before that, as its first flow grows from nothing.
    """
    left = 1 - settings.damping
    ways = stage(walks(links, settings.damping), "walks")
    none = F.lit(0.0)
    ends = ways.select("host", none.alias("trust"), none.alias("distrust"))
    summed = seeds.unionByName(ends).groupBy("host").agg((left * F.sum("trust")).alias("trust"), (left * F.sum("distrust")).alias("distrust"))
    nodes = stage(summed, "hosts")
    places, blocks = placed(nodes, ways, settings)
    places = stage(places, "places")
    located_ways = stage(
        ways.join(places, "host").join(places.select(F.col("host").alias("at"), F.col("block").alias("from_block")), "at"), "walks"
    )
    inner, outer = located_ways.where("block = from_block"), located_ways.where("block <> from_block")
    graph = stage(packed(nodes.join(places, "host"), inner, blocks), "blocks")
    ranks = stage(solved(graph, None, blocks, settings), "ranks")
    before = None
    try:
        if outer.isEmpty():
            return ranks
        for _ in range(settings.rounds):
            carried = outer.join(ranks.select(F.col("host").alias("at"), "trust", "distrust"), "at")
            flow = stage(
                carried.groupBy("block", "host").agg(
                    F.sum(F.col("trust") * F.col("f")).alias("trust"), F.sum(F.col("distrust") * F.col("b")).alias("distrust")
                ),
                "inflow",
            )
            change = _growth(flow, before)
            if before is not None:
                drop_staged(before)
            before = flow
            if change <= settings.tolerance:
                return ranks
            after = stage(solved(graph, flow, blocks, settings), "ranks")
            drop_staged(ranks)
            ranks = after
        raise ValueError(f"ranks still change by a part of {change} after {settings.rounds} exchanges")
    finally:
        for done in (ways, nodes, places, located_ways, graph, *([before] if before is not None else [])):
            drop_staged(done)


def _growth(flow: DataFrame, before: DataFrame | None) -> float:
    """The largest part by which a flow has grown."""
    both = flow.select("host", "trust", "distrust", F.lit(0.0).alias("t"), F.lit(0.0).alias("d"))
    if before is not None:
        both = both.unionByName(before.select("host", F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust"), F.col("trust").alias("t"), F.col("distrust").alias("d")))
    sums = both.groupBy("host").agg(*[F.sum(name).alias(name) for name in ("trust", "distrust", "t", "d")])
    grown = lambda new, old: F.when(F.col(new) > 0, (F.col(new) - F.col(old)) / F.col(new)).otherwise(0.0)
    return sums.agg(F.max(F.greatest(grown("trust", "t"), grown("distrust", "d")))).first()[0] or 0.0


def judged(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rule and verdict of each row of (page_id, url, html, ...).

    Returns page_id, host, path, rule (null if none fits), verdict (that of the rule, else of
    the host's trust and distrust; a host that neither reaches is allowed), trust and
    distrust in ten digits, as sums of doubles depend on their order in the last ones. A null url, or one without ``://``, has no host and is allowed; a null html has
    no links. Seeds are shares: the part of a host's pages that rules allow or block.
    """
    rows = located(pages)
    text, verdict = decided(settings)
    ruled = rows.withColumns({"rule": text, "ruled": verdict})
    seeds = ruled.where("host <> ''").groupBy("host").agg(
        F.avg((F.coalesce("ruled", F.lit("")) == "allow").cast("double")).alias("trust"),
        F.avg((F.coalesce("ruled", F.lit("")) == "block").cast("double")).alias("distrust"),
    )
    seeds, links = stage(seeds, "seeds"), stage(edges(rows), "links")
    found = propagated(seeds, links, settings)
    for done in (seeds, links):
        drop_staged(done)
    known = ruled.select("page_id", "host", "path", "rule", "ruled").join(found, "host", "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    method = F.when(distrust > settings.ratio * (1 + settings.alike) * trust, "block").otherwise("allow")
    ten = lambda rank: F.format_string("%.9e", rank).cast("double")
    return known.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), ten(trust).alias("trust"), ten(distrust).alias("distrust")
    )
