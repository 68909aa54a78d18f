"""Token counts by rank-synchronous merging of byte-pair symbols in ragged numpy arrays.

The symbols of many pre-tokens stand in one flat array. In each round every pre-token
applies its own lowest-ranked pair, all at once, until none has a pair left; what
survives is counted. Words that a worker has met before are looked up.

The vocabulary is a ``tokenizers`` JSON file of a BPE model with word ends, lower case
and dropped white space; of that library only the Unicode composition runs here.
"""

from __future__ import annotations

import json
import unicodedata
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers.normalizers import NFC

NONE = np.iinfo(np.int64).max
KNOWN_WORDS = 300_000
"""Words that a worker remembers before it starts afresh."""
BATCH_CHARS = 1 << 20
FAR = regex.compile("[^\\x00-\\u02FF]")
"""Beyond Latin, composing follows the Unicode edition of the library, not Python's."""


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable in Latin-1, else
    the next free code point from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Merger:
    """Counts symbols after all merges of a vocabulary."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        model = spec["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([ids.get(letter, -1) for letter in letters], np.int64)
        self.last = np.array([ids.get(letter + end, -1) for letter in letters], np.int64)
        self.width = max(ids.values()) + 1
        pairs = [(ids[a] * self.width + ids[b], rank, ids[a + b]) for rank, (a, b) in enumerate(model["merges"])]
        order = np.array(sorted(pairs), np.int64).reshape(-1, 3)
        self.keys, self.ranks, self.merged = (np.ascontiguousarray(order[:, k]) for k in range(3))
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.pieces = regex.compile(split + "|\n")
        self.compose = NFC()
        self.known: dict[str, int] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (NONE if it never merges) and the symbol it becomes."""
        key = left * self.width + right
        place = np.searchsorted(self.keys, key)
        place[place == len(self.keys)] = 0
        found = (self.keys[place] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.ranks[place], NONE), self.merged[place]

    def merge(self, pieces: list[str]) -> np.ndarray:
        """The number of symbols that each pre-token ends with."""
        encoded = [piece.encode() for piece in pieces]
        lengths = np.array([len(e) for e in encoded], np.int64)
        data = np.frombuffer(b"".join(encoded), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(lengths)[lengths > 0] - 1
        symbols[ends] = self.last[data[ends]]
        piece = np.repeat(np.arange(len(pieces)), lengths)
        present = symbols >= 0  # bytes that the vocabulary lacks make no token
        symbols, piece = symbols[present], piece[present]
        counts = np.zeros(len(pieces), np.int64)
        ranks, becomes = self._pairs(symbols, piece, np.arange(len(symbols)))
        while len(symbols):
            first = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
            least = np.minimum.reduceat(ranks, first)
            sizes = np.diff(np.r_[first, len(symbols)])
            done = least == NONE
            counts[piece[first[done]]] = sizes[done]
            hit = (ranks != NONE) & (ranks == np.repeat(least, sizes))
            # Of a pair that overlaps itself, every other occurrence from the left merges.
            if (hit[1:] & hit[:-1]).any():
                index = np.arange(len(hit))
                start = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], index, 0))
                hit &= (index - start) % 2 == 0
            symbols = np.where(hit, becomes, symbols)
            stay = ~np.r_[False, hit[:-1]] & ~np.repeat(done, sizes)
            place = np.cumsum(stay) - 1
            changed = place[hit & stay]
            symbols, piece, ranks, becomes = symbols[stay], piece[stay], ranks[stay], becomes[stay]
            touched = np.union1d(changed, changed[changed > 0] - 1)
            ranks[touched], becomes[touched] = self._pairs(symbols, piece, touched)
        return counts

    def _pairs(self, symbols: np.ndarray, piece: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        after = np.minimum(at + 1, max(len(symbols) - 1, 0))
        ranks, becomes = self._rank(symbols[at], symbols[after])
        ranks[(after == at) | (piece[after] != piece[at])] = NONE
        return ranks, becomes

    def learn(self, words: list[str]) -> None:
        """Remember the token counts of words, which hold no line feed, tab or space."""
        special = np.zeros(len(words), np.int64)
        plain = []
        for index, word in enumerate(words):
            if "<" in word:
                word, special[index] = self.special.subn(" ", word)
            plain.append(word)
        composed = [self.compose.normalize_str(w) if FAR.search(w) else unicodedata.normalize("NFC", w) for w in plain]
        text = "\n".join(composed).replace("Σ", "σ").lower()
        found = self.pieces.findall(text)
        distinct = {piece: k for k, piece in enumerate(dict.fromkeys(found))}
        counts = self.merge(["" if piece == "\n" else piece for piece in distinct])
        which = np.fromiter((distinct[piece] for piece in found), np.int64, len(found))
        word = np.cumsum(which == distinct.get("\n", -1)) if found else which
        totals = special + np.bincount(word, counts[which], len(words)).astype(np.int64)
        self.known.update(zip(words, totals.tolist()))

    def count(self, texts: list[str]) -> list[int]:
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        split = [text.replace("\n", " ").replace("\t", " ").split(" ") for text in texts]
        self.learn(list({word for words in split for word in words if word not in self.known}))
        return [sum(map(self.known.__getitem__, words)) for words in split]


def token_counts(docs: DataFrame, vocabulary: str, most: int = 2048) -> DataFrame:
    """Bytes and tokens of each row of (doc_id, text, ...), and whether they exceed ``most``.

    ``vocabulary`` is the path of the JSON file, read once and sent to the workers; its
    size is fixed. Strings of added tokens in a text count as one token each. No begin or end
    token is added, nothing is cut. A null text is empty and has no tokens.
    """
    spec = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text())

    def run(batches):
        merger = Merger(spec.value)
        for batch in batches:
            texts = batch.column(1).fill_null("").to_pylist()
            counts: list[int] = []
            first = 0
            while first < len(texts):
                end, size = first, 0
                while end < len(texts) and (end == first or size + len(texts[end]) <= BATCH_CHARS):
                    size += len(texts[end])
                    end += 1
                counts += merger.count(texts[first:end])
                first = end
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    rows = docs.select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    )
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long"
    return rows.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > most)
