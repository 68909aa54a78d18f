"""MinHash near-duplicates with sequential Bayesian verification.

Documents whose shingle sets are equal form a class at once. Classes that agree on a
band of MinHash values are candidates. A candidate pair is read batch by batch of its
two signatures and dropped as soon as the posterior chance of a similarity at or above
the threshold falls below a share of ``miss``; what survives is confirmed on the full sets.

Candidates of one band value are taken in two steps. First, each class is compared with
the bucket's hub, the member that shares most buckets with others; confirmed links join
classes to components. Then members that are still apart meet in blocks of bounded size,
so that no pair is left out: a task first finds which of them have a plausible partner, a
second one brings the full sets of those to the block and confirms links until no two
members that are linked lie apart. What leaves a block is one link for each member at most,
never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import words as W
from tidemill.llm.store import drop_staged, freed, grouped, stage


@dataclass(frozen=True)
class Settings:
    size: int = 5
    """Words of a shingle."""
    percent: int = 85
    """Linked from 100 * intersection >= percent * union."""
    bands: int = 24
    """Bands of four values: at 85 percent, one in 50 million pairs shares none."""
    hashes: int = 256
    batches: tuple[int, ...] = (32, 64, 128, 256)
    """Numbers of values after which the posterior is looked at."""
    miss: float = 1e-4
    """Largest chance that a pair at the threshold is dropped, over all looks together."""
    block: int = 512
    """Classes of one bucket that meet as many others in one task at a time."""
    block_shingles: int = 1 << 20
    """Shingles of such classes; longer texts make smaller blocks."""


ROWS = 4
SKETCH = "doc_id long, n_shingles long, key_a long, key_b long, signature binary"
PAIR = "a long, b long"
BLOCK = ["bucket", "home", "visit"]


def least_matches(settings: Settings) -> list[tuple[int, int]]:
    """(values read, fewest matches to go on): under a uniform prior, the posterior of a
    similarity after m matches of n is Beta(m + 1, n - m + 1), and its chance of a link is
    below that of m or fewer matches at the threshold. Each look may lose an equal share of
    ``miss`` by the latter, so that all looks together lose no more than ``miss``."""
    t, share = settings.percent / 100, settings.miss / len(settings.batches)
    table = []
    for n in settings.batches:
        below, least = 0.0, 0
        for m in range(n + 1):
            below += comb(n, m) * t**m * (1 - t) ** (n - m)
            if below >= share:
                least = m
                break
        table.append((n, least))
    return table


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; of a shorter text, its one sequence."""
    for first, end, data, offsets in W.chunks(texts):
        found = W.words(data, offsets, W.SPACED, fold=True)
        at, hashes = W.windows(found, size)
        limits = np.searchsorted(found.text[at], np.arange(end - first + 1))
        for row in range(end - first):
            count = found.count[row]
            if 0 < count < size:
                yield W.sequence(found.hashes, found.first[row : row + 1], count)
            else:
                yield np.unique(hashes[limits[row] : limits[row + 1]])


def _multipliers(settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    high = lambda seed: (W.splitmix(seed, settings.hashes) >> np.uint64(32)).astype(np.uint32)
    return high(21) | np.uint32(1), high(22)


def signature(shingles: np.ndarray, factor: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """The least value of each hash function, its upper 16 bits mixed with the lower."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factor), 0xFFFFFFFF, np.uint32)
    for start in range(0, len(values), 256):
        np.minimum(least, (values[start : start + 256, None] * factor + shift).min(0), out=least)
    return (W.mix(least.astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)


def sketches(docs: DataFrame, settings: Settings) -> DataFrame:
    """Set size, set identity (two 64-bit sums over the set) and signature of each row."""

    def run(batches):
        factor, shift = _multipliers(settings)
        for batch in batches:
            sizes, keys_a, keys_b, signs = [], [], [], []
            for shingles in shingle_sets(batch.column(1), settings.size):
                sizes.append(len(shingles))
                keys_a.append(np.add.reduce(shingles).view(np.int64))
                keys_b.append(np.add.reduce(W.mix(shingles ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64))
                signs.append(signature(shingles, factor, shift).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys_a, pa.int64()), pa.array(keys_b, pa.int64()), pa.array(signs, pa.binary())],
                ["doc_id", "n_shingles", "key_a", "key_b", "signature"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(freed(run), SKETCH)


def band_rows(classes: DataFrame, settings: Settings) -> DataFrame:
    """One row for each class and band: four 16-bit values and the band make the bucket."""
    salts = W.splitmix(23, settings.bands)

    def run(batches):
        for batch in batches:
            signs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, settings.hashes)
            parts = np.ascontiguousarray(signs[:, : ROWS * settings.bands]).view(np.uint64)
            buckets = W.mix(parts ^ salts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column(0).to_numpy(), settings.bands)),
                    pa.array(np.tile(np.arange(settings.bands, dtype=np.int32), len(signs))),
                    pa.array(buckets.ravel().view(np.int64)),
                    pa.array(np.repeat(batch.column(2).to_numpy(), settings.bands)),
                ],
                ["rep", "band", "bucket", "n_shingles"],
            )

    return classes.select("rep", "signature", "n_shingles").mapInArrow(freed(run), "rep long, band int, bucket long, n_shingles long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node that each node of the edges (a, b) reaches.

    Alternates large and small stars, which takes about as many rounds as the logarithm
    of a component's size. A round's table is written before the next.
    """
    edges = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stage(rest.unionByName(low.withColumnRenamed("m", "v")).distinct(), "stars")
        drop_staged(edges)
        edges = after
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return found.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _settled(edges: DataFrame) -> bool:
    """Whether each component is a star around its least node."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("top")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("top"))
    )
    counts = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("top").alias("top"))
    return counts.where("below > 1 or (below > 0 and top > 0)").isEmpty()


def plausible(pairs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """Pairs whose signatures, read batch by batch, do not rule a link out."""
    table = least_matches(settings)

    def run(batches):
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, settings.hashes) for k in (2, 3))
            rows, read, matches = np.arange(batch.num_rows), 0, np.zeros(batch.num_rows, np.int64)
            for n, least in table:
                matches = matches + (left[rows, read:n] == right[rows, read:n]).sum(1)
                keep = matches >= least
                rows, matches, read = rows[keep], matches[keep], n
            yield batch.select([0, 1]).take(pa.array(rows))

    signs = classes.select("rep", "signature")
    joined = pairs.join(signs.toDF("a", "left"), "a").join(signs.toDF("b", "right"), "b")
    return joined.select("a", "b", "left", "right").mapInArrow(freed(run), PAIR)


def linked(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    if 100 * min(len(left), len(right)) < percent * max(len(left), len(right)):
        return False
    both = np.concatenate([left, right])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def confirmed(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold."""

    def run(batches):
        for batch in batches:
            sides = ((np.frombuffer(value.as_buffer(), np.uint64) for value in batch.column(k)) for k in (2, 3))
            keep = [linked(left, right, settings.percent) for left, right in zip(*sides)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b")
    return joined.select("a", "b", "left", "right").mapInArrow(freed(run), PAIR)


def hub_pairs(members: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's hub."""
    degree = members.groupBy("rep").agg(F.sum("n").alias("degree"))
    hubs = (
        members.join(degree, "rep").groupBy("bucket").agg(F.max(F.struct("degree", (-F.col("rep")).alias("negative"))).alias("top"))
        .select("bucket", (-F.col("top.negative")).alias("hub"))
    )
    pairs = members.join(hubs, "bucket").where("rep <> hub")
    return pairs.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()


def unsettled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with their own and the largest one (main)."""
    named = members.join(labels.toDF("rep", "label"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    counted = named.groupBy("bucket", "label").agg(F.count("*").alias("size"))
    spread = counted.groupBy("bucket").agg(F.max(F.struct("size", "label")).alias("top"), F.count("*").alias("labels"))
    return named.join(spread.where("labels > 1").select("bucket", F.col("top.label").alias("main")), "bucket")


def grid(open_members: DataFrame, settings: Settings) -> DataFrame:
    """The members dealt to the blocks (bucket, home, visit) in which they meet.

    All members have a home; those outside the main component also visit all homes of
    their bucket, so that each pair of components meets.
    """
    weight = F.greatest(F.lit(1.0 / settings.block), F.col("n_shingles") / settings.block_shingles)
    sizes = open_members.groupBy("bucket").agg(
        F.ceil(F.sum(weight)).cast("int").alias("homes"),
        F.ceil(F.sum(F.when(F.col("label") != F.col("main"), weight))).cast("int").alias("visits"),
    )
    cells = lambda number: F.explode(F.sequence(F.lit(0), F.col(number) - 1))
    rows = open_members.join(sizes, "bucket")
    columns = ["bucket", "band", "rep", "label", "main"]
    home = rows.select(
        *columns, F.lit(False).alias("visitor"), F.pmod(F.xxhash64("rep"), "homes").cast("int").alias("home"), cells("visits").alias("visit")
    )
    visitors = rows.where("label <> main").select(
        *columns, F.lit(True).alias("visitor"), cells("homes").alias("home"),
        F.pmod(F.xxhash64("rep", F.lit(1)), "visits").cast("int").alias("visit"),
    )
    return home.unionByName(visitors)


class Meeting:
    """A block: which of its members may be linked, by their signatures."""

    def __init__(self, group: pa.Table, settings: Settings):
        self.settings, self.table = settings, least_matches(settings)
        self.visitor = group["visitor"].to_numpy()
        self.rep, self.label, self.size = (group[c].to_numpy() for c in ("rep", "label", "n_shingles"))
        self.signs = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint16).reshape(-1, settings.hashes)
        self.parts = np.ascontiguousarray(self.signs[:, : ROWS * settings.bands]).view(np.uint64)
        self.band, self.main = group["band"][0].as_py(), group["main"][0].as_py()
        self.homes, self.guests = np.flatnonzero(~self.visitor), np.flatnonzero(self.visitor)

    def plausible(self, guest: int) -> np.ndarray:
        """The home members that a guest may be linked with, the most alike first. A pair of visitors
        meets twice, once in the home block of each; of the bands that a pair shares, the
        first one's bucket counts."""
        homes, rep, label, size, signs = self.homes, self.rep, self.label, self.size, self.signs
        rows = homes[(label[homes] != label[guest]) & ((label[homes] == self.main) | (rep[homes] > rep[guest]))]
        small, large = np.minimum(size[rows], size[guest]), np.maximum(size[rows], size[guest])
        rows = rows[100 * small >= self.settings.percent * large]
        matches, read = np.zeros(len(rows), np.int64), 0
        for n, least in self.table:
            matches = matches + (signs[rows, read:n] == signs[guest, read:n]).sum(1)
            keep = matches >= least
            rows, matches, read = rows[keep], matches[keep], n
            if not len(rows):
                return rows
        first = (self.parts[rows] == self.parts[guest]).argmax(1) == self.band
        return rows[first][np.argsort(-matches[first], kind="stable")]


def waiting(cells: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of the blocks with what ``Meeting`` reads."""
    return cells.join(classes.select("rep", "n_shingles", "signature"), "rep")


def partnered(cells: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """The rows of the blocks whose member has a plausible partner there in another component."""
    names = cells.columns

    def run(batches):
        for group in grouped(batches, BLOCK):
            meeting = Meeting(group, settings)
            some = np.zeros(group.num_rows, bool)
            for guest in meeting.guests:
                rows = meeting.plausible(guest)
                some[rows] = True
                some[guest] |= len(rows) > 0
            if some.any():
                yield from group.select(names).filter(pa.array(some)).to_batches()

    rows = waiting(cells, classes)
    return rows.repartition(*BLOCK).sortWithinPartitions(*BLOCK).select(
        *names, "n_shingles", "signature"
    ).mapInArrow(freed(run), cells.schema)


def forest(cells: DataFrame, classes: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Confirmed links of the blocks that join all components linked there: one less than
    there are components. Pairs that are joined by then are not compared."""

    def run(batches):
        for group in grouped(batches, BLOCK):
            meeting = Meeting(group, settings)
            held = [np.frombuffer(value.as_buffer(), np.uint64) for value in group["set"].combine_chunks()]
            parent = {label: label for label in meeting.label.tolist()}

            def top(label: int) -> int:
                while parent[label] != label:
                    parent[label] = label = parent[parent[label]]
                return label

            found = []
            for guest in meeting.guests:
                own = int(meeting.label[guest])
                for row in meeting.plausible(guest).tolist():
                    one, other = top(own), top(int(meeting.label[row]))
                    if one != other and linked(held[guest], held[row], settings.percent):
                        parent[one] = other
                        found.append(sorted((int(meeting.rep[guest]), int(meeting.rep[row]))))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(end, pa.int64()) for end in zip(*found)], ["a", "b"])

    rows = waiting(cells, classes).join(sets, "rep")
    return rows.repartition(*BLOCK).sortWithinPartitions(*BLOCK).select(
        *cells.columns, "n_shingles", "signature", "set"
    ).mapInArrow(freed(run), PAIR).distinct()


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Link rows of (doc_id, text, ...) and name each one's component.

    Returns doc_id, n_shingles, component_id (least doc_id that links reach) and kept
    (doc_id = component_id), one row for each row of ``docs``; other columns are not
    read. Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text with A-Z in lower case. A text
    with fewer words than a shingle is one shingle; a null text, or one without words,
    has none and is linked with nothing. ``doc_id`` names a document: rows that share one
    are one document and share a component. A row without doc_id takes the component of an
    equal shingle set that has one; without such, its component is null and it is kept.
    """
    sketch = stage(sketches(docs, settings), "sketches")
    classes = stage(
        sketch.where("n_shingles > 0").groupBy("key_a", "key_b", "n_shingles")
        .agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature")),
        "classes",
    )
    known = classes.where("rep is not null")
    banded = stage(band_rows(known, settings), "bands")
    buckets = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stage(banded.join(buckets, "bucket"), "members")
    drop_staged(banded)
    involved = members.select(F.col("rep").alias("doc_id")).distinct()
    sets = stage(_full_sets(docs, involved, settings), "sets")

    pairs = stage(plausible(hub_pairs(members), known, settings), "pairs")
    links = stage(confirmed(pairs, sets, settings), "links")
    labels = stage(components(links), "labels")
    apart = stage(unsettled(members, labels), "apart")
    cells = stage(partnered(grid(apart, settings), known, settings), "cells")
    more = stage(forest(cells, known, sets, settings), "links")
    labels = joined(labels, more)
    for done in (members, sets, pairs, links, apart, cells, more):
        drop_staged(done)

    named = classes.select("key_a", "key_b", "n_shingles", "rep").join(
        labels.toDF("rep", "label"), "rep", "left"
    ).withColumn("component_id", F.coalesce("label", "rep")).drop("label", "rep")
    empty = F.col("n_shingles") == 0
    found = stage(
        sketch.select("doc_id", "n_shingles", "key_a", "key_b")
        .join(named, ["key_a", "key_b", "n_shingles"], "left")
        .select(
            "doc_id", "n_shingles",
            F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())),
        "components",
    )
    for done in (sketch, classes, labels):
        drop_staged(done)
    return found


def joined(labels: DataFrame, more: DataFrame) -> DataFrame:
    """The components (node, label) after further links: only labels are linked anew."""
    if more.isEmpty():
        return labels
    ends = more.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    every = stage(labels.unionByName(ends.join(labels, "node", "left_anti").withColumn("label", F.col("node"))), "labels")
    of = lambda end: every.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}"))
    links = more.join(of("a"), "a").join(of("b"), "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    tops = components(links.where("a <> b")).toDF("label", "top")
    after = stage(every.join(tops, "label", "left").select("node", F.coalesce("top", "label").alias("label")), "labels")
    for done in (labels, every):
        drop_staged(done)
    return after


def _full_sets(docs: DataFrame, involved: DataFrame, settings: Settings) -> DataFrame:
    """(rep, set) of the documents named; the texts are probed, not sorted."""

    def run(batches):
        for batch in batches:
            found = [s.tobytes() for s in shingle_sets(batch.column(1), settings.size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["rep", "set"])

    texts = docs.select(F.col("doc_id").cast("long"), "text")
    return texts.join(involved.hint("shuffle_hash"), "doc_id", "left_semi").mapInArrow(freed(run), "rep long, set binary")


UNNAMED = 1 << 62
"""Ids from here on, by a hash of the text, stand for missing ones while copies are removed."""


def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the least doc_id stays.

    Columns are those of ``docs``. Rows that repeat a doc_id are one document, and stay or
    go together. Rows without doc_id are known by a hash of their text: of copies among them
    one stays, and none if a document with an id is a copy too. Texts without words are linked
    with nothing and stay.
    """
    inner = F.shiftrightunsigned(F.xxhash64("text"), 3) + F.lit(UNNAMED)
    known = docs.select(F.coalesce(F.col("doc_id").cast("long"), inner).alias("doc_id"), "text")
    found = near_duplicates(known, settings)
    gone = found.where("not kept").select(F.col("doc_id").alias("__gone")).distinct().hint("shuffle_hash")
    nameless = docs.where(F.col("doc_id").isNull())
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.where(F.col("doc_id").isNotNull()).unionByName(nameless.where(worded).dropDuplicates(["text"]))
    kept = rows.unionByName(nameless.where(~worded)).join(
        gone, F.coalesce(F.col("doc_id").cast("long"), inner) == F.col("__gone"), "left_anti"
    )
    return kept.select(docs.columns)
