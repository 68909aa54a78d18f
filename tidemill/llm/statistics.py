"""Counts over the whole text of each document, made in one pass over its bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm import words as W
from tidemill.llm.store import freed

WINDOW = 8

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words",
    "n_upper", "n_letters", "n_digits", "n_shouts", "n_stops", "n_bars", "n_same_words", "n_chars",
)
"""What ``counted`` gives: words; code points in words; characters of ``[#*$%&|<>]``; lines with a
word that equal an earlier line; words in 8-word windows found twice or more; lines with a
word; distinct words; ASCII capitals; ASCII letters and non-ASCII characters; digits; ``!``;
``.,;:?``; ``|``; words that equal the word before; code points."""

STATISTICS = T.StructType([T.StructField(name, T.LongType()) for name in COUNTS])

_LEADS = ~W.byte_set((0x80, 0xBF))
_CLASSES = {
    "n_symbols": b"#*$%&|<>",
    "n_digits": b"0123456789",
    "n_shouts": b"!",
    "n_stops": b".,;:?",
    "n_bars": b"|",
    "n_upper": bytes(range(0x41, 0x5B)),
}
_TABLES = {name: np.isin(np.arange(256), list(chars)) for name, chars in _CLASSES.items()}
_LETTERS = W.byte_set((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xFF))


def count(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text of a chunk."""
    texts = len(offsets) - 1
    out: dict[str, np.ndarray] = {}

    def within(flags: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    leads = _LEADS[data]
    out["n_chars"] = within(leads)
    out["word_chars"] = within(leads & W.SPACED[data])
    out["n_letters"] = within(_LETTERS[data])
    for name, table in _TABLES.items():
        out[name] = within(table[data])

    found = W.words(data, offsets, W.SPACED, fold=False)
    out["n_words"] = found.count
    out["n_distinct_words"] = _distinct(found.hashes, found.text, texts)
    same = np.flatnonzero((found.hashes[1:] == found.hashes[:-1]) & (found.text[1:] == found.text[:-1]))
    out["n_same_words"] = np.bincount(found.text[same], minlength=texts)

    at, hashes = W.windows(found, WINDOW)
    _, inverse, often = np.unique(_keyed(hashes, found.text[at]), return_inverse=True, return_counts=True)
    repeated = W.covered(at[often[inverse] > 1], WINDOW, len(found.text))
    out["n_repeat_words"] = np.bincount(found.text[repeated], minlength=texts)

    lines = W.words(data, offsets, W.LINE, fold=False)
    inside = np.zeros(len(data) + 1, np.int64)
    np.cumsum(W.SPACED[data], out=inside[1:])
    worded = inside[lines.end] > inside[lines.start]
    out["n_lines"] = np.bincount(lines.text[worded], minlength=texts)
    out["n_dup_lines"] = out["n_lines"] - _distinct(lines.hashes[worded], lines.text[worded], texts)
    return out


def _keyed(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes told apart by text."""
    return W.mix(hashes ^ W.mix(text.astype(np.uint64) + np.uint64(1)))


def _distinct(hashes: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    _, first = np.unique(_keyed(hashes, text), return_index=True)
    return np.bincount(text[first], minlength=texts)


def counted(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with a struct ``statistics`` as its last column; a null text counts as empty."""
    place = docs.columns.index(column)
    plain = docs.toDF(*[f"x{i}" for i in range(len(docs.columns))])

    def run(batches):
        for batch in batches:
            parts = [count(data, offsets) for _, _, data, offsets in W.chunks(batch.column(place))]
            columns = [pa.array(np.concatenate([part[name] for part in parts]) if parts else [], pa.int64()) for name in COUNTS]
            struct = pa.StructArray.from_arrays(columns, list(COUNTS))
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], [*batch.schema.names, "statistics"])

    schema = T.StructType([*plain.schema.fields, T.StructField("statistics", STATISTICS)])
    return plain.mapInArrow(freed(run), schema).toDF(*docs.columns, "statistics")


def ratios(struct: str = "statistics") -> dict[str, F.Column]:
    """Sizes and shares that do not depend on the language, each a double."""
    part = lambda name: F.col(f"{struct}.{name}").cast("double")
    share = lambda above, below: F.coalesce(part(above) / F.nullif(part(below), F.lit(0.0)), F.lit(0.0))
    return {
        "words": part("n_words"),
        "word_length": share("word_chars", "n_words"),
        "symbols": share("n_symbols", "n_words"),
        "repeated_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "distinct_words": share("n_distinct_words", "n_words"),
        "same_words": share("n_same_words", "n_words"),
        "capitals": share("n_upper", "n_letters"),
        "digits": share("n_digits", "n_chars"),
        "shouts": share("n_shouts", "n_words"),
        "stops": share("n_stops", "n_words"),
        "bars": share("n_bars", "n_words"),
        "letters": share("n_letters", "n_chars"),
        "line_words": share("n_words", "n_lines"),
    }
