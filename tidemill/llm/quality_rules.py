"""Learned decision lists over text statistics, as ordered Spark conditions.

Sequential covering: a conjunction of thresholds is grown on two thirds of the labelled
rows by information gain, cut back on the other third, and accepted while it is precise
there; the rows it covers go, and the next one is grown. The list is a chain of
``when`` conditions, which reads as it stands.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import statistics as S
from tidemill.llm.store import bounded, stage


@dataclass(frozen=True)
class Settings:
    sample_rows: int = 50_000
    """Most labelled rows that are learned from, the least by a hash of doc_id; they are
    the only rows that reach the driver, as numbers."""
    cuts: int = 64
    """Thresholds tried for each statistic, at quantiles."""
    conditions: int = 4
    rules: int = 24
    precision: float = 0.8
    """Least share of rejects that a rule must cover among the rows kept for cutting back."""
    least_rows: int = 4
    """Least rejects that a rule must cover there."""


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def holds(self, rows: pd.DataFrame) -> np.ndarray:
        values = rows[self.statistic].to_numpy()
        return values > self.threshold if self.above else values <= self.threshold

    def column(self, statistics: dict[str, Column]) -> Column:
        value = statistics[self.statistic]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold!r}"


Rule = tuple[Condition, ...]


def learn(rows: pd.DataFrame, reject: np.ndarray, growing: np.ndarray, settings: Settings = Settings()) -> list[Rule]:
    """Rules for ``reject``, in order; ``growing`` marks the rows to grow on."""
    cuts = {name: np.unique(np.quantile(rows[name], np.linspace(0, 1, settings.cuts + 1)[1:-1])) for name in rows} if len(rows) else {}
    bins = {name: np.searchsorted(cuts[name], rows[name].to_numpy(), "left") for name in cuts}
    left = np.ones(len(rows), bool)
    found: list[Rule] = []
    while len(found) < settings.rules and (left & growing & reject).any():
        rule = _cut_back(_grow(left & growing, reject, cuts, bins, settings), rows, left & ~growing, reject)
        covered = left & ~growing & _covers(rule, rows)
        good = int((covered & reject).sum())
        if not rule or good < settings.least_rows or good < settings.precision * covered.sum():
            break
        found.append(rule)
        left &= ~_covers(rule, rows)
    return found


def _covers(rule: Rule, rows: pd.DataFrame) -> np.ndarray:
    return reduce(np.logical_and, (c.holds(rows) for c in rule), np.ones(len(rows), bool))


def _grow(inside: np.ndarray, reject: np.ndarray, cuts: dict, bins: dict, settings: Settings) -> Rule:
    rule: list[Condition] = []
    while len(rule) < settings.conditions:
        hits, misses = int((inside & reject).sum()), int((inside & ~reject).sum())
        if not hits or not misses:
            break
        before, best = np.log2(hits / (hits + misses)), (1e-9, None)
        for name, thresholds in cuts.items():
            size = len(thresholds) + 1
            good = np.cumsum(np.bincount(bins[name][inside & reject], minlength=size))[:-1].astype(float)
            bad = np.cumsum(np.bincount(bins[name][inside & ~reject], minlength=size))[:-1].astype(float)
            for above, p, n in ((False, good, bad), (True, hits - good, misses - bad)):
                gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / np.maximum(p + n, 1)) - before), 0)
                place = int(gain.argmax()) if len(gain) else 0
                if len(gain) and gain[place] > best[0]:
                    best = (gain[place], Condition(name, above, float(thresholds[place])))
        if best[1] is None:
            break
        rule.append(best[1])
        place = np.searchsorted(cuts[rule[-1].statistic], rule[-1].threshold)
        side = bins[rule[-1].statistic] > place
        inside = inside & (side if rule[-1].above else ~side)
    return tuple(rule)


def _cut_back(rule: Rule, rows: pd.DataFrame, inside: np.ndarray, reject: np.ndarray) -> Rule:
    """The shortest beginning of the rule with the best (p - n) / (p + n)."""
    def worth(size: int) -> float:
        covered = inside & _covers(rule[:size], rows)
        total = covered.sum()
        return (2 * (covered & reject).sum() - total) / total if total else -1.0

    return rule[: max(range(1, len(rule) + 1), key=lambda size: (worth(size), -size))] if rule else rule


def verdict(rules: list[Rule], statistics: dict[str, Column]) -> Column:
    """The number of the first rule that holds, from 1; 0 where none does."""
    if not rules:
        return F.lit(0)
    conditions = [reduce(lambda a, b: a & b, (c.column(statistics) for c in rule)) for rule in rules]
    chain = F.when(conditions[0], 1)
    for number, condition in enumerate(conditions[1:], 2):
        chain = chain.when(condition, number)
    return chain.otherwise(0)


def base_failed(struct: str = "statistics") -> Column:
    """Fewer than 20 words, or more than 30 percent of them in repeated windows."""
    words, repeated = F.col(f"{struct}.n_words"), F.col(f"{struct}.n_repeat_words")
    return (words < 20) | (100 * repeated > 30 * words)


def marked(labels: DataFrame, settings: Settings) -> DataFrame:
    """The (doc_id, quality) that are learned from: at most ``sample_rows``."""
    known = labels.where("doc_id is not null and quality is not null")
    return bounded(known.groupBy("doc_id").agg(F.max("quality").alias("quality")), settings.sample_rows)


def fit(counted: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> list[Rule]:
    """Rules from rows of (doc_id, statistics) whose label ``quality`` is 0 or 1.

    Rows that the base rules fail, or without doc_id or label, teach nothing; of a
    repeated label the greatest counts. Without labels there are no rules.
    """
    features = S.ratios()
    known = counted.where(~base_failed()).join(F.broadcast(marked(labels, settings)), "doc_id").select(
        F.xxhash64(F.col("doc_id").cast("long")).alias("place"), (F.col("quality") == 0).alias("reject"),
        *[column.alias(name) for name, column in features.items()],
    )
    # Rows may repeat a doc_id: the limit holds for them too.
    rows = known.orderBy("place", *features).limit(settings.sample_rows).toPandas()
    reject = rows["reject"].to_numpy(bool)
    growing = rows["place"].to_numpy() % 3 != 0
    return learn(rows[list(features)], reject, growing, settings)


def judged(counted: DataFrame, rules: list[Rule]) -> DataFrame:
    """``counted`` with base_failed, rule (0: none) and kept after its columns."""
    return counted.withColumns({"base_failed": base_failed(), "rule": verdict(rules, S.ratios())}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0)
    )


def digest(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Counts and verdict of each row of (doc_id, text, ...); a null text has no words and fails."""
    counted = stage(S.counted(docs.select("doc_id", "text")).select("doc_id", "statistics"), "statistics")
    found = judged(counted, fit(counted, labels, settings))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select("doc_id", *[f"statistics.{name}" for name in names], "base_failed", "kept", "rule")


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that the base rules and the learned list keep, with its columns.

    The texts that are learned from are read once before all are judged.
    """
    # At most ``sample_rows`` ids.
    sample = F.broadcast(marked(labels, settings).select("doc_id"))
    taught = docs.select("doc_id", "text").join(sample, "doc_id", "left_semi")
    rules = fit(S.counted(taught).select("doc_id", "statistics"), labels, settings)
    names = [f"x{i}" for i in range(len(docs.columns))]
    rows = S.counted(docs.toDF(*names), names[docs.columns.index("text")])
    return judged(rows, rules).where("kept").select(*names).toDF(*docs.columns)
