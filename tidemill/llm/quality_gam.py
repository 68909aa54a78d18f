"""Quality score by a generalised additive model with pairwise interactions.

Each statistic of a text is cut into bins and has a lookup table of log odds; chosen
pairs of statistics have a table over both. Boosting goes round the statistics in turn: a
shallow tree over a statistic's bins fits the residuals and a small part of it is added
to that statistic's table; then the same over pairs. A score is a sum of table entries.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import statistics as S
from tidemill.llm import words as W
from tidemill.llm.store import bounded


@dataclass(frozen=True)
class Settings:
    sample_rows: int = 50_000
    """Most labelled rows that are learned from, the least by a hash of doc_id; they are
    broadcast as ids and reach the driver as counts."""
    bins: int = 48
    pair_bins: int = 8
    pairs: int = 6
    rounds: int = 80
    rate: float = 0.15
    leaves: int = 4
    least_rows: int = 8
    """Rows of a leaf."""
    smoothing: float = 1.0
    threshold: float = 0.3


FEATURES = (
    "words", "word_length", "symbols", "repeated_lines", "repeated_words", "distinct_words", "same_words",
    "capitals", "digits", "shouts", "stops", "bars", "letters", "line_words",
)


def features(counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The shares of ``statistics.ratios``, from arrays of counts."""
    part = {name: np.asarray(values, float) for name, values in counts.items()}

    def share(above: str, below: str) -> np.ndarray:
        return np.divide(part[above], part[below], out=np.zeros(len(part[above])), where=part[below] > 0)

    pairs = {
        "word_length": ("word_chars", "n_words"), "symbols": ("n_symbols", "n_words"), "repeated_lines": ("n_dup_lines", "n_lines"),
        "repeated_words": ("n_repeat_words", "n_words"), "distinct_words": ("n_distinct_words", "n_words"),
        "same_words": ("n_same_words", "n_words"), "capitals": ("n_upper", "n_letters"), "digits": ("n_digits", "n_chars"),
        "shouts": ("n_shouts", "n_words"), "stops": ("n_stops", "n_words"), "bars": ("n_bars", "n_words"),
        "letters": ("n_letters", "n_chars"), "line_words": ("n_words", "n_lines"),
    }
    return {"words": part["n_words"]} | {name: share(*pair) for name, pair in pairs.items()}


@dataclass
class Model:
    base: float = 0.0
    cuts: dict[str, np.ndarray] = field(default_factory=dict)
    tables: dict[str, np.ndarray] = field(default_factory=dict)
    pair_cuts: dict[str, np.ndarray] = field(default_factory=dict)
    pair_tables: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def score(self, values: dict[str, np.ndarray]) -> np.ndarray:
        """The chance of label 1 for each row."""
        total = np.full(len(next(iter(values.values()))), self.base)
        for name, table in self.tables.items():
            total += table[np.searchsorted(self.cuts[name], values[name])]
        for (a, b), table in self.pair_tables.items():
            total += table[np.searchsorted(self.pair_cuts[a], values[a]), np.searchsorted(self.pair_cuts[b], values[b])]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray, settings: Settings) -> np.ndarray:
    """The step of each bin: a tree of few leaves over ordered bins, from their sums."""
    sums = [np.concatenate([[0.0], np.cumsum(v)]) for v in (gradient, weight, rows)]

    def part(first: int, end: int) -> tuple[float, float, float]:
        return tuple(s[end] - s[first] for s in sums)

    def worth(first: int, end: int) -> float:
        g, h, _ = part(first, end)
        return g * g / (h + settings.smoothing)

    def split(first: int, end: int):
        inner = np.arange(first + 1, end)
        if not len(inner):
            return (0.0, None)
        g, h, n = (s[inner] - s[first] for s in sums)
        G, H, N = part(first, end)
        gain = g * g / (h + settings.smoothing) + (G - g) ** 2 / (H - h + settings.smoothing) - worth(first, end)
        gain = np.where((n >= settings.least_rows) & (N - n >= settings.least_rows), gain, -1.0)
        best = int(gain.argmax())
        return (float(gain[best]), int(inner[best])) if gain[best] > 0 else (0.0, None)

    leaves = {(0, len(gradient)): split(0, len(gradient))}
    while len(leaves) < settings.leaves:
        leaf = max(leaves, key=lambda k: leaves[k][0])
        gain, at = leaves[leaf]
        if at is None:
            break
        del leaves[leaf]
        for piece in ((leaf[0], at), (at, leaf[1])):
            leaves[piece] = split(*piece)
    out = np.zeros(len(gradient))
    for first, end in leaves:
        g, h, _ = part(first, end)
        out[first:end] = g / (h + settings.smoothing)
    return out


def _quadrants(gradient: np.ndarray, weight: np.ndarray, settings: Settings) -> tuple[float, np.ndarray]:
    """The best cut of a grid into four quarters, and the step of each cell."""
    def below(v):
        return np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0)))

    G, H = below(gradient), below(weight)
    rows, columns = gradient.shape
    if rows < 2 or columns < 2:
        return 0.0, np.zeros_like(gradient)
    i, j = np.meshgrid(np.arange(1, rows), np.arange(1, columns), indexing="ij")

    def four(T):
        a, b, c = T[i, j], T[i, columns] - T[i, j], T[rows, j] - T[i, j]
        return np.stack([a, b, c, T[rows, columns] - a - b - c])

    g, h = four(G), four(H)
    gain = (g * g / (h + settings.smoothing)).sum(0) - G[-1, -1] ** 2 / (H[-1, -1] + settings.smoothing)
    best = np.unravel_index(int(gain.argmax()), gain.shape)
    steps = (g / (h + settings.smoothing))[:, best[0], best[1]]
    out = np.empty_like(gradient)
    a, b = best[0] + 1, best[1] + 1
    out[:a, :b], out[:a, b:], out[a:, :b], out[a:, b:] = steps
    return float(gain[best]), out


def learn(values: dict[str, np.ndarray], label: np.ndarray, settings: Settings = Settings()) -> Model:
    """Boost the tables on labelled rows; without both labels, the score is the mean."""
    model = Model()
    rate = (label.sum() + 0.5) / (len(label) + 1)
    model.base = float(np.log(rate / (1 - rate)))
    if len(label) == 0 or label.min() == label.max():
        return model
    total = np.full(len(label), model.base)

    def residuals():
        chance = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return label - chance, chance * (1 - chance)

    model.cuts = {name: _cuts(v, settings.bins) for name, v in values.items()}
    bins = {name: np.searchsorted(model.cuts[name], v) for name, v in values.items()}
    model.tables = {name: np.zeros(len(cuts) + 1) for name, cuts in model.cuts.items()}
    rows = {name: np.bincount(b, minlength=len(model.tables[name])) for name, b in bins.items()}
    for _ in range(settings.rounds):
        for name, at in bins.items():
            gradient, weight = residuals()
            size = len(model.tables[name])
            step = settings.rate * _tree(np.bincount(at, gradient, size), np.bincount(at, weight, size), rows[name], settings)
            model.tables[name] += step
            total += step[at]

    model.pair_cuts = {name: _cuts(v, settings.pair_bins) for name, v in values.items()}
    coarse = {name: np.searchsorted(model.pair_cuts[name], v) for name, v in values.items()}

    def grid(a: str, b: str):
        shape = (len(model.pair_cuts[a]) + 1, len(model.pair_cuts[b]) + 1)
        cell = coarse[a] * shape[1] + coarse[b]
        gradient, weight = residuals()
        return cell, [np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (gradient, weight)]

    names = list(values)
    worth = {(a, b): _quadrants(*grid(a, b)[1], settings)[0] for k, a in enumerate(names) for b in names[k + 1 :]}
    chosen = [pair for pair in sorted(worth, key=lambda p: (-worth[p], p))[: settings.pairs] if worth[pair] > 1e-6]
    model.pair_tables = {pair: np.zeros((len(model.pair_cuts[pair[0]]) + 1, len(model.pair_cuts[pair[1]]) + 1)) for pair in chosen}
    for _ in range(settings.rounds):
        for pair in chosen:
            cell, sums = grid(*pair)
            step = settings.rate * _quadrants(*sums, settings)[1]
            model.pair_tables[pair] += step
            total += step.ravel()[cell]
    return model


def held_out() -> Column:
    """Rows that are never learned from: crc32 of doc_id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """A model of ``quality`` (0 or 1) from the rows of (doc_id, text, ...) that are not held out.

    Labels without doc_id or quality teach nothing; of a repeated label the greatest
    counts, and each row with a labelled doc_id is a row to learn from, up to the limit.
    """
    marks = labels.where("doc_id is not null and quality is not null").where(~held_out())
    marks = marks.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    place = F.xxhash64(F.col("doc_id").cast("long"))
    sample = bounded(marks, settings.sample_rows)
    known = S.counted(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"))
    rows = known.select("doc_id", "quality", "statistics.*").orderBy(place, *S.COUNTS).limit(settings.sample_rows).toPandas()
    return learn(features({name: rows[name].to_numpy() for name in S.COUNTS}), rows["quality"].to_numpy(float), settings)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of each row of (doc_id, text, ...); a null text scores as an empty one."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            parts = [sent.value.score(features(S.count(data, offsets))) for _, _, data, offsets in W.chunks(batch.column(1))]
            scores = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def digest(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Score of every document, learned from the labelled ones that are not held out."""
    found = scored(docs, fit(docs, labels, settings))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= settings.threshold).cast("int").alias("predicted"))
