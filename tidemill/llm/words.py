"""Words, windows and lines of Arrow text columns as flat numpy arrays.

A batch of texts is one byte array with offsets. Words are runs of word bytes that
do not cross a text's border; each gets a 64-bit hash from prefix sums over bytes,
so that no Python object is made per word. UTF-8 keeps ASCII separators apart from
the bytes of other characters, so byte runs are character runs.

Texts are taken whole. ``chunks`` bounds the bytes worked on at a time; a longer
text is a chunk by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 1 << 20
MASK = (1 << 64) - 1


def splitmix(seed: int, count: int) -> np.ndarray:
    """``count`` well-mixed 64-bit numbers that depend on ``seed`` only."""
    with np.errstate(over="ignore"):
        state = U64(seed & MASK) + np.arange(1, count + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)
        return mix(state)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        out = values ^ (values >> U64(30))
        out *= U64(0xBF58476D1CE4E5B9)
        out ^= out >> U64(27)
        out *= U64(0x94D049BB133111EB)
        out ^= out >> U64(31)
    return out


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, true within the inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


SPACED = ~byte_set((0x20, 0x20), (0x09, 0x0D))
ALNUM = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LINE = ~byte_set((0x0A, 0x0A))

FOLDED = np.arange(256)
FOLDED[0x41:0x5B] += 0x20

_BYTE_CODES = splitmix(11, 256) | U64(1)
_CODES = {False: _BYTE_CODES, True: _BYTE_CODES[FOLDED]}
_PLACES = splitmix(12, 64) | U64(1)
_LENGTHS = splitmix(13, 64)
_BASE = 0xD1342543DE82EF95
_powers: dict[int, np.ndarray] = {}


def _power(base: int, length: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < length:
        steps = np.full(max(length, CHUNK_BYTES + 1), base, U64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps, dtype=U64)
    return known[:length]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive texts; a null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data_buffer or b"", np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), len(texts))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


@dataclass
class Words:
    """Words of a chunk, in order: byte range, text they belong to, hash."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hashes: np.ndarray
    count: np.ndarray
    """Words of each text."""
    first: np.ndarray
    """Index of each text's first word."""


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, fold: bool) -> Words:
    """Runs of bytes of ``kind``; with ``fold``, A-Z hash as a-z."""
    return marked(data, offsets, kind[data], fold)


def marked(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, fold: bool) -> Words:
    """Runs of the bytes flagged in ``inside``."""
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    after = np.zeros(len(data) + 1, bool)
    after[1:] = inside
    start = np.flatnonzero(inside & (~after[:-1] | border[:-1]))
    before = np.zeros(len(data) + 1, bool)
    before[:-1] = inside
    end = np.flatnonzero(inside & (~before[1:] | border[1:])) + 1
    text = np.searchsorted(offsets, start, "right") - 1
    count = np.bincount(text, minlength=len(offsets) - 1)
    return Words(start, end, text, spans(data, start, end, fold), count, np.cumsum(count) - count)


def spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = False) -> np.ndarray:
    """Hashes of byte ranges; equal bytes (but for the case of A-Z with ``fold``) hash alike."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(_CODES[fold][data] * _power(_BASE, len(data)), out=sums[1:])
        found = (sums[end] - sums[start]) * _power(pow(_BASE, -1, 1 << 64), len(data) + 1)[start]
    return mix(found)


def windows(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of ``size`` words within one text."""
    last = len(found.text) - size + 1
    if last <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    at = np.flatnonzero(found.text[:last] == found.text[size - 1 :])
    return at, sequence(found.hashes, at, size)


def sequence(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` words from each position of ``at``."""
    total = np.full(len(at), _LENGTHS[size % 64], U64)
    with np.errstate(over="ignore"):
        for place in range(size):
            total += hashes[at + place] * _PLACES[place % 64]
    return mix(total)


def covered(at: np.ndarray, size: np.ndarray | int, total: int) -> np.ndarray:
    """Flags of the positions that ranges of ``size`` from ``at`` cover."""
    change = np.bincount(at, minlength=total + 1) - np.bincount(at + size, minlength=total + 1)
    return np.cumsum(change[:total]) > 0
