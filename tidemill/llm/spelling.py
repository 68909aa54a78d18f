"""Spelling variants: a trie of letter-group counts, searched with a budget of one edit.

Letters are dealt to groups. A word's counts, group after group, are its way down a trie.
One inserted, deleted or replaced letter raises one count by one at most and lowers one by
one at most, so the words near a word lie where a depth-first search that spends a surplus
of one and a deficit of one leads; the words of the leaves are compared letter by letter.

The first groups' counts are also the key by which Spark deals words out: a task holds
the trie of one key, in blocks of bounded size, and a word visits the keys within the
budget. Pairs of near words never leave a task; each word takes away how many it has and
the best of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import words as W
from tidemill.llm.store import drop_staged, stage


@dataclass(frozen=True)
class Settings:
    every: int = 97
    """Runs whose checksum this divides lose a letter."""
    letters: int = 5
    """Fewest code points of a word."""
    least: int = 3
    """Fewest occurrences of a word."""
    ratio: int = 2
    """A form is at least so many times as frequent as the word."""
    known: int = 300_000
    """Words that a task counts before it passes them on."""
    block: int = 50_000
    """Words of one trie."""
    queries: int = 50_000
    """Words that go down a trie together."""
    leaf: int = 24
    """Words that are compared rather than divided further."""
    keys: int = 3
    """Groups that make the key of a trie, at least: each fourfold number of words beyond
    ``key_words`` takes one more, so that the words of one key stay few."""
    key_words: int = 2_000_000


# Letters of A-Z in lower case and of U+00C0 to U+00FF by groups, the most telling ones first.
GROUPS = (
    "e", "a", "i", "n", "o", "t", "r", "s", "hl", "cd", "um", "pgb", "fywv", "kxjqz",
    "".join(map(chr, range(0xDF, 0x100))), "".join(map(chr, range(0xC0, 0xDF))),
)
WIDTH = 48
"""Letters that are compared side by side; longer words are compared one by one."""

LETTER = W.byte_set((0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xC3))
COUNTED = "word string, n long"
MET = "word string, n_near long, best_n long, best string"

_GROUP = np.zeros(256, np.int64)
for _number, _letters in enumerate(GROUPS):
    _GROUP[[ord(letter) for letter in _letters]] = _number


def _crc_steps() -> np.ndarray:
    """CRC-32 of each byte, by the rule of its polynomial."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(0xEDB88320), steps >> 1)
    return steps


_STEPS = _crc_steps()


def checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each byte range, carried on from the one of what comes ``before`` it."""
    length = end - start
    found = before ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(-length, kind="stable")
    order = order[np.searchsorted(-length[order], -WIDTH) :]
    lengths = length[order]
    for place in range(int(lengths[0]) if len(lengths) else 0):
        order = order[: np.searchsorted(-lengths, -place, "left")]
        lengths = lengths[: len(order)]
        state = found[order]
        found[order] = _STEPS[(state ^ data[start[order] + place]) & 0xFF] ^ (state >> np.uint32(8))
    found ^= np.uint32(0xFFFFFFFF)
    for index in np.flatnonzero(length > WIDTH).tolist():
        found[index] = zlib.crc32(data[start[index] : end[index]].tobytes(), int(before[index]))
    return found


def counted(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, n) of all rows (doc_id, text, ...): long and frequent enough words.

    Runs are ``[A-Za-z\\u00C0-\\u00FF]+`` of the whole text with A-Z in lower case. A null text
    has none; a null doc_id is written as nothing before the colon. In UTF-8, such letters
    beyond ASCII are just the characters that begin with byte C3.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[bytes, int] = {}
        for batch in batches:
            names = [b"%d:" % i if i is not None else b":" for i in batch.column(0).to_pylist()]
            for first, end, data, offsets in W.chunks(batch.column(1)):
                _count(data, offsets, names[first:end], totals, settings)
                if len(totals) > settings.known:
                    yield _rows(totals)
                    totals.clear()
        yield _rows(totals)

    parts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, COUNTED)
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= settings.least)


def _rows(totals: dict[bytes, int]) -> pa.RecordBatch:
    words = pa.array(list(totals), pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(list(totals.values()), pa.int64())], ["word", "n"])


def _count(data: np.ndarray, offsets: np.ndarray, names: list[bytes], totals: dict[bytes, int], settings: Settings) -> None:
    lower = W.FOLDED[data].astype(np.uint8)
    inside = LETTER[data]
    two = data == 0xC3
    inside[1:] |= two[:-1]
    runs = W.marked(lower, offsets, inside, fold=False)
    pairs = np.concatenate([[0], np.cumsum(two)])
    letters = runs.end - runs.start - (pairs[runs.end] - pairs[runs.start])
    before = np.array([zlib.crc32(name) for name in names], np.uint32)[runs.text]
    sums = checksums(lower, runs.start, runs.end, before).astype(np.int64)
    cut = sums % settings.every == 0
    for index in np.flatnonzero(cut & (letters > settings.letters)).tolist():
        word = lower[runs.start[index] : runs.end[index]].tobytes().decode()
        place = int(sums[index]) % len(word)
        short = (word[:place] + word[place + 1 :]).encode()
        totals[short] = totals.get(short, 0) + 1
    whole = np.flatnonzero(~cut & (letters >= settings.letters))
    _, at, count = np.unique(runs.hashes[whole], return_index=True, return_counts=True)
    text = lower.tobytes()
    for start, end, n in zip(runs.start[whole[at]].tolist(), runs.end[whole[at]].tolist(), count.tolist()):
        word = text[start:end]
        totals[word] = totals.get(word, 0) + n


class Spelled:
    """Words as numbers: letters side by side, counts of letter groups."""

    def __init__(self, words: list[str], keys: int):
        self.text = [word.encode("latin-1") for word in words]
        self.length = np.array([len(word) for word in self.text], np.int64)
        every = np.frombuffer(b"".join(self.text), np.uint8)
        row = np.repeat(np.arange(len(words)), self.length)
        shape = len(words), len(GROUPS)
        counts = np.bincount(row * shape[1] + _GROUP[every], minlength=shape[0] * shape[1]).reshape(shape)
        self.counts = counts[:, keys:].astype(np.int32)
        place = np.arange(len(every)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        # One column more than letters, so that every line ends in a blank.
        self.codes = np.zeros((len(words), WIDTH + 1), np.uint8)
        short = place < WIDTH
        self.codes[row[short], place[short]] = every[short]

    def take(self, rows: np.ndarray) -> None:
        self.text = [self.text[row] for row in rows.tolist()]
        self.length, self.counts, self.codes = self.length[rows], self.counts[rows], self.codes[rows]


class Trie:
    """The words of one key and block, in order of their counts: a node is a run of words whose
    counts agree as far as it is deep."""

    def __init__(self, words: list[str], n: np.ndarray, keys: int, settings: Settings):
        self.settings = settings
        self.spelled = Spelled(words, keys)
        order = np.lexsort(self.spelled.counts.T[::-1])
        self.spelled.take(order)
        self.n = n[order]
        self.rank = np.empty(len(words), np.int64)
        self.rank[np.argsort(np.array(self.spelled.text, object), kind="stable")] = np.arange(len(words))

    def near(self, asked: Spelled, surplus: np.ndarray, deficit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(asked, own) word numbers of all near pairs. The flags tell what of each word's
        budget the way to this key has spent."""
        counts, depth = self.spelled.counts, self.spelled.counts.shape[1]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        open_nodes = [(0, len(counts), 0, np.arange(len(asked.length)), surplus, deficit)]
        while open_nodes:
            low, high, level, words, over, under = open_nodes.pop()
            if high - low <= self.settings.leaf or level == depth:
                found.extend(self._compared(asked, low, high, level, words, over, under))
                continue
            own = counts[low:high, level]
            borders = np.flatnonzero(own[1:] != own[:-1]) + 1 + low
            given = asked.counts[words, level]
            for first, end in zip([low, *borders.tolist()], [*borders.tolist(), high]):
                more = counts[first, level] - given
                go = np.flatnonzero((more == 0) | ((more == 1) & ~over) | ((more == -1) & ~under))
                if len(go):
                    step = more[go]
                    open_nodes.append((first, end, level + 1, words[go], over[go] | (step == 1), under[go] | (step == -1)))
        return tuple(np.concatenate(part) for part in zip(*found))

    def _compared(self, asked, low, high, level, words, over, under):
        size = max(1, (1 << 18) // (high - low))
        for start in range(0, len(words), size):
            part = words[start : start + size]
            more = self.spelled.counts[None, low:high, level:] - asked.counts[part, None, level:]
            fits = (np.maximum(more, 0).sum(2) + over[start : start + size, None] <= 1) & (
                np.maximum(-more, 0).sum(2) + under[start : start + size, None] <= 1
            )
            left, right = np.nonzero(fits)
            left, right = part[left], right + low
            near = one_edit(asked, left, self.spelled, right)
            yield left[near], right[near]


def one_edit(left: Spelled, a: np.ndarray, right: Spelled, b: np.ndarray) -> np.ndarray:
    """Whether the words of each pair differ by one letter inserted, deleted or replaced."""
    found = np.zeros(len(a), bool)
    long = np.maximum(left.length[a], right.length[b]) > WIDTH
    for index in np.flatnonzero(long).tolist():
        found[index] = _one_edit(left.text[a[index]], right.text[b[index]])
    change = right.length[b] - left.length[a]
    for by, first, second, one, other in ((0, left, right, a, b), (1, left, right, a, b), (-1, right, left, b, a)):
        rows = np.flatnonzero(~long & (change == by))
        short, grown = first.codes[one[rows]], second.codes[other[rows]]
        same = short == grown
        if by == 0:
            found[rows] = (~same).sum(1) == 1
        else:
            common = same.argmin(1)[:, None]
            found[rows] = ((short[:, :-1] == grown[:, 1:]) | (np.arange(WIDTH) < common)).all(1)
    return found


def _one_edit(a: bytes, b: bytes) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    short, grown = sorted((a, b), key=len)
    low, high = 0, len(short)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if short[:middle] == grown[:middle] else (low, middle - 1)
    return short[low + (len(a) == len(b)) :] == grown[low + 1 :]


def key_groups(words: int, settings: Settings) -> int:
    """How many groups make a key."""
    more = ceil(log(max(1.0, words / settings.key_words), 4) - 1e-9)
    return min(len(GROUPS) - 1, settings.keys + more)


def dealt(vocabulary: DataFrame, groups: int, settings: Settings) -> DataFrame:
    """The words as members of the tries of their keys, and as visitors of all within the budget."""
    count = lambda letters: F.length("word") - F.length(F.translate("word", letters, ""))
    names = [f"k{i}" for i in range(groups)]
    words = vocabulary.select("word", "n", *[count(GROUPS[i]).alias(name) for i, name in enumerate(names)])
    size = words.groupBy(*names).agg(F.ceil(F.count("*") / settings.block).cast("int").alias("blocks"))
    members = words.join(size, names).select(
        *names, F.pmod(F.xxhash64("word"), "blocks").cast("int").alias("block"), F.lit(True).alias("member"), "word", "n",
        F.lit(False).alias("surplus"), F.lit(False).alias("deficit"),
    )
    steps = [(0,) * groups]
    for up in range(-1, groups):
        for down in range(-1, groups):
            if up != down:
                steps.append(tuple((i == up) - (i == down) for i in range(groups)))
    ways = F.array(*[
        F.struct(*[(F.col(name) + by).alias(name) for name, by in zip(names, step)], F.lit(1 in step).alias("surplus"), F.lit(-1 in step).alias("deficit"))
        for step in sorted(set(steps))
    ])
    visits = words.select("word", F.explode(ways).alias("way")).select("word", "way.*").join(size, names)
    visitors = visits.select(
        *names, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(False).alias("member"), "word",
        F.lit(None).cast("long").alias("n"), "surplus", "deficit",
    )
    return members.unionByName(visitors)


def met(vocabulary: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, n_near, best_n, best) of each word and trie in which it has near words."""
    groups = key_groups(vocabulary.count(), settings)
    keys = [*[f"k{i}" for i in range(groups)], "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, trie, members, visitors = None, None, [], []

        def answer() -> pa.RecordBatch:
            rows = pa.Table.from_batches(visitors)
            visitors.clear()
            words = rows["word"].to_pylist()
            asked = Spelled(words, groups)
            one, other = trie.near(asked, rows["surplus"].to_numpy(), rows["deficit"].to_numpy())
            order = np.lexsort((trie.rank[other], -trie.n[other], one))
            one, other = one[order], other[order]
            known, first, count = np.unique(one, return_index=True, return_counts=True)
            best = other[first]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([words[i] for i in known.tolist()], pa.string()), pa.array(count, pa.int64()), pa.array(trie.n[best], pa.int64()),
                    pa.array([trie.spelled.text[i].decode("latin-1") for i in best.tolist()], pa.string()),
                ],
                ["word", "n_near", "best_n", "best"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(key).to_numpy(zero_copy_only=False) for key in [*keys, "member"]]
            change = np.zeros(batch.num_rows - 1, bool)
            for column in columns:
                change |= column[1:] != column[:-1]
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for first, end in zip(cuts[:-1], cuts[1:]):
                here, part = tuple(int(column[first]) for column in columns[:-1]), batch.slice(first, end - first)
                if here != place:
                    if visitors:
                        yield answer()
                    place, trie, members = here, None, []
                if columns[-1][first]:
                    members.append(part)
                    continue
                if trie is None:
                    rows = pa.Table.from_batches(members)
                    trie = Trie(rows["word"].to_pylist(), rows["n"].to_numpy(), groups, settings)
                visitors.append(part)
                if sum(part.num_rows for part in visitors) >= settings.queries:
                    yield answer()
        if visitors:
            yield answer()

    rows = dealt(vocabulary, groups, settings).repartition(*keys).sortWithinPartitions(*keys, F.desc("member"))
    return rows.mapInArrow(run, MET)


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms (word, form) lead in the end. Forms grow in frequency, so
    that no way is a circle; each round doubles the steps taken."""
    now = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while not now.join(now.select(F.col("word").alias("root")), "root", "left_semi").isEmpty():
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stage(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        drop_staged(now)
        now = after
    return now


def variants(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (doc_id, text, ...).

    ``form`` is the near word of the largest n, of equal ones the first by code points, if its
    n is ``ratio`` times the word's; ``root`` is where forms lead, the word itself if it has
    none. Only doc_id and text are read. Rows that repeat count as often as they are there;
    null texts have no words; without words there are no rows.
    """
    vocabulary = stage(counted(docs, settings), "words")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    near = met(vocabulary, settings).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    fits = -F.col("best.less") >= F.col("n") * settings.ratio
    known = stage(
        vocabulary.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(fits, F.col("best.word")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"),
        ),
        "variants",
    )
    drop_staged(vocabulary)
    roots = rooted(known.where(F.col("form").isNotNull()))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
