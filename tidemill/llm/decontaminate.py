"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned and verified.

Every run of ``size`` words of a benchmark item is a window; an item with fewer words is
one window. The hashes of all windows are broadcast, documents are scanned whole, and a
hash that is found counts only when the words are the same. The set is broadcast in
blocks of at most ``block_bytes``, one after the other, each scanned against all documents,
so that a large benchmark needs more scans and no larger memory.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm import words as W
from tidemill.llm.store import drop_staged, stage


@dataclass(frozen=True)
class Settings:
    size: int = 10
    """Words of a window."""
    block_bytes: int = 64 << 20
    """Words of the windows that are broadcast at a time."""


WINDOW = "item_id string, size int, hash long, words binary"
SPAN = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType())])
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(SPAN)),
        T.StructField("items", T.ArrayType(T.StringType())), T.StructField("cut", T.StringType()),
    ]
)


def windows(benchmark: DataFrame, settings: Settings) -> DataFrame:
    """The distinct windows of (item_id, text), with the items that hold them.

    A null text or one without words has none. Rows that repeat an item_id are one item; a
    window whose item has no id is still found, and counts for no item.
    """

    def run(batches):
        for batch in batches:
            rows = []
            names = batch.column(0).to_pylist()
            for first, end, data, offsets in W.chunks(batch.column(1)):
                found = W.words(data, offsets, W.ALNUM, fold=True)
                for row in range(end - first):
                    count = int(found.count[row])
                    size = min(count, settings.size)
                    if not size:
                        continue
                    at = found.first[row] + np.arange(count - size + 1)
                    for word, hashed in zip(at.tolist(), W.sequence(found.hashes, at, size).view(np.int64).tolist()):
                        rows.append((names[first + row], size, hashed, _words(data, found, word, size)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows) if rows else [[]] * 4, (pa.string(), pa.int32(), pa.int64(), pa.binary()))],
                ["item_id", "size", "hash", "words"],
            )

    rows = benchmark.select(F.col("item_id").cast("string"), "text").mapInArrow(run, WINDOW)
    return rows.groupBy("size", "hash", "words").agg(F.collect_set("item_id").alias("items"))


def _words(data: np.ndarray, found: W.Words, first: int, size: int) -> bytes:
    ends = zip(found.start[first : first + size].tolist(), found.end[first : first + size].tolist())
    return b" ".join(data[a:b].tobytes().lower() for a, b in ends)


class Lookup:
    """Windows of one block as flat arrays, by size: sorted hashes, words end to end, items.

    It is broadcast as it is; a worker adds a table of hash prefixes to each size.
    """

    MOST_BITS = 22

    def __init__(self, block: pa.Table):
        every = block["size"].to_numpy()
        self.names = sorted({name for items in block["items"].to_pylist() for name in items})
        number = {name: at for at, name in enumerate(self.names)}
        self.sizes = {}
        for size in np.unique(every).tolist():
            part = block.filter(pa.array(every == size))
            hashes = part["hash"].to_numpy().view(np.uint64)
            order = np.argsort(hashes, kind="stable")
            part = part.take(pa.array(order)).combine_chunks()
            text, items = part["words"].combine_chunks().cast(pa.large_binary()), part["items"].combine_chunks()
            lengths = np.array([len(word) for word in items.to_pylist()], np.int64)
            self.sizes[size] = (
                hashes[order],
                np.frombuffer(text.buffers()[1], np.int64)[: len(text) + 1].copy(), text.buffers()[2].to_pybytes() if len(text) else b"",
                np.concatenate([[0], np.cumsum(lengths)]), np.array([number[name] for name in items.flatten().to_pylist()], np.int32),
            )
        self.prefixes = {}

    def __getstate__(self):
        return {**self.__dict__, "prefixes": {}}

    def _likely(self, size: int, hashes: np.ndarray) -> np.ndarray:
        """Positions whose hash may be one of this size's."""
        known = self.sizes[size][0]
        if size not in self.prefixes:
            bits = min(self.MOST_BITS, max(8, len(known).bit_length() + 3))
            table = np.zeros(1 << bits, bool)
            table[(known >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.prefixes[size] = np.uint64(64 - bits), table
        shift, table = self.prefixes[size]
        return np.flatnonzero(table[(hashes >> shift).astype(np.int64)])

    def hits(self, data: np.ndarray, found: W.Words):
        """(first word, size, items) of each verified occurrence."""
        for size, (known, starts, text, firsts, items) in self.sizes.items():
            at, hashes = W.windows(found, size)
            likely = self._likely(size, hashes)
            low = np.searchsorted(known, hashes[likely], "left")
            high = np.searchsorted(known, hashes[likely], "right")
            for place in np.flatnonzero(high > low).tolist():
                first = int(at[likely[place]])
                said = _words(data, found, first, size)
                for row in range(low[place], high[place]):
                    if text[starts[row] : starts[row + 1]] == said:
                        yield first, size, [self.names[item] for item in items[firsts[row] : firsts[row + 1]]]


def plain(docs: DataFrame) -> DataFrame:
    """``docs`` with neutral names for all columns but ``text``, so that none can clash."""
    return docs.toDF(*[name if name == "text" else f"x{i}" for i, name in enumerate(docs.columns)])


def scan(docs: DataFrame, lookup: Broadcast, cut: bool = False) -> DataFrame:
    """``docs`` with what the windows of a block hit in a last column ``found``: number of words,
    merged spans of words, items and, with ``cut``, the text without the spans (each from the
    first byte of its first word to the last byte of its last). Spans that a column
    ``earlier`` holds are merged with them."""
    spans_type = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
    types = [pa.int64(), spans_type, pa.list_(pa.string()), pa.string()]

    def run(batches):
        table = lookup.value
        for batch in batches:
            out = {"n_words": [], "spans": [], "items": [], "cut": []}
            place = batch.schema.get_field_index("earlier")
            earlier = batch.column(place).to_pylist() if place >= 0 else [[]] * batch.num_rows
            for first, end, data, offsets in W.chunks(batch.column(batch.schema.get_field_index("text"))):
                found = W.words(data, offsets, W.ALNUM, fold=True)
                spans, items = defaultdict(list), defaultdict(set)
                for word, size, names in table.hits(data, found):
                    row = int(found.text[word])
                    items[row].update(names)
                    spans[row].append((word, word + size))
                for row in range(end - first):
                    base = int(found.first[row])
                    merged = joined(spans[row] + [(base + s["first"], base + s["end"]) for s in earlier[first + row]])
                    out["n_words"].append(int(found.count[row]))
                    out["spans"].append([{"first": a - base, "end": b - base} for a, b in merged])
                    out["items"].append(sorted(items[row]))
                    out["cut"].append(_without(data, offsets[row], offsets[row + 1], found, merged) if cut and merged else None)
            found = pa.StructArray.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "found"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("found", FOUND)]))


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch as one."""
    found: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if found and first <= found[-1][1]:
            found[-1] = found[-1][0], max(found[-1][1], end)
        else:
            found.append((first, end))
    return found


def _without(data: np.ndarray, first: int, end: int, found: W.Words, spans: list) -> str:
    kept, at = [], int(first)
    for a, b in spans:
        kept.append(data[at : int(found.start[a])].tobytes())
        at = int(found.end[b - 1])
    kept.append(data[at : int(end)].tobytes())
    return b"".join(kept).decode()


def blocks(benchmark: DataFrame, settings: Settings) -> list[DataFrame]:
    """The windows in parts of at most about ``block_bytes``, by hash."""
    known = stage(windows(benchmark, settings), "windows")
    size = known.agg(F.sum(F.length("words") + 64 + 16 * F.size("items"))).first()[0] or 0
    parts = max(1, ceil(size / settings.block_bytes))
    return [known.where(F.pmod(F.xxhash64("hash"), F.lit(parts)) == part) for part in range(parts)]


def in_turn(rows: DataFrame, benchmark: DataFrame, settings: Settings, step, carried: bool) -> DataFrame | list[DataFrame]:
    """``step(rows, lookup, last)`` for one block after the other.

    At most one block is broadcast: what a step makes is written, and its block released,
    before the next block is fetched. With ``carried`` each step takes the rows of the one
    before and the last one's rows are returned, else those of all steps. One block alone
    is not written.
    """
    context = rows.sparkSession.sparkContext
    parts, found = blocks(benchmark, settings), []
    for number, block in enumerate(parts):
        # At most block_bytes of windows, as measured; no rows, no hits.
        lookup = context.broadcast(Lookup(block.toArrow()))
        after = step(rows, lookup, number == len(parts) - 1)
        if len(parts) > 1:
            after = stage(after, "scanned")
            lookup.destroy()
        if carried:
            if number:
                drop_staged(rows)
            rows = after
        found.append(after)
    return rows if carried else found


def contamination(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, text_key, n_words, spans, items) of each row of (doc_id, text, ...).

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the whole text with A-Z in lower case. A null
    text has none, and no benchmark rows means no hits. Rows may repeat; each has its own
    result. ``spans`` are ranges of word numbers, apart and in order if the benchmark is one
    block; over several blocks they are gathered and may touch.
    """
    rows = docs.select("doc_id", "text")

    def step(rows: DataFrame, lookup: Broadcast, last: bool) -> DataFrame:
        return scan(rows, lookup).select("doc_id", F.xxhash64("text").alias("text_key"), "found.n_words", "found.spans", "found.items")

    parts = in_turn(rows, benchmark, settings, step, carried=False)
    if len(parts) == 1:
        return parts[0]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    found = every.groupBy("doc_id", "text_key").agg(
        F.first("n_words").alias("n_words"),
        F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )
    rows = rows.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("k"))
    return rows.join(found, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("k") == F.col("text_key"))).drop("d", "k")


def digest(found: DataFrame) -> DataFrame:
    """The figures of each document: words, hit words, items and a checksum of their ids."""
    places = F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["end"] - 1)))
    named = F.array_join(F.array_sort("items"), ",")
    return found.select(
        "doc_id", "n_words",
        F.size(F.array_distinct(places)).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(named, 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that no benchmark window occurs in, with the columns of ``docs``."""

    def step(rows: DataFrame, lookup: Broadcast, last: bool) -> DataFrame:
        return scan(rows, lookup).where(F.size("found.spans") == 0).drop("found")

    return in_turn(plain(docs), benchmark, settings, step, carried=True).toDF(*docs.columns)


def cut_spans(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with every hit span removed from ``text``; other columns as they were.

    Spans of all blocks are gathered and merged, and the text is cut once, after the last.
    """

    def step(rows: DataFrame, lookup: Broadcast, last: bool) -> DataFrame:
        done = scan(rows, lookup, cut=last)
        if not last:
            return done.withColumn("earlier", F.col("found.spans")).drop("found")
        return done.withColumn("text", F.coalesce("found.cut", "text")).drop("found", "earlier")

    none = F.array().cast(T.ArrayType(SPAN))
    return in_turn(plain(docs).withColumn("earlier", none), benchmark, settings, step, carried=True).toDF(*docs.columns)
