"""Language of web pages by Bayesian fusion of text, markup, address and host.

Text gives a likelihood from byte trigrams, learned from documents of known language.
The pages' own text posteriors, summed by group, then say how far the declared markup
language and the address suffix follow the language, and what languages each host has;
a host's prior is smoothed towards its domain's and that towards the whole corpus. A
page is left out of the sums that judge it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import words as W
from tidemill.llm.store import bounded, stage
from tidemill.llm.url_trust import located


@dataclass(frozen=True)
class Settings:
    sample_rows: int = 20_000
    """Most documents of known language that the text model is learned from, the least by
    a hash of doc_id."""
    bits: int = 15
    """Trigrams are hashed to so many bits."""
    smoothing: float = 0.5
    trust: float = 0.2
    """Weight of a trigram's evidence: neighbours overlap and are not independent."""
    strongest: float = 40.0
    """Most log odds that the text alone can give."""
    prior: float = 2.0
    """Pages that a coarser level's shares are worth in a finer level."""


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray
    """Log probability of each hashed trigram, one row a language."""


MARKUP = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>"
DECLARED = r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?\s*([a-z]+)"""


def trigrams(texts: pa.Array, bits: int):
    """(row, cells): the hashed byte trigrams of each text, A-Z in lower case."""
    table = np.arange(256, dtype=np.uint32)
    table[0x41:0x5B] += 0x20
    table[:0x41] = 0x20  # digits, stops and white space tell nothing
    for first, end, data, offsets in W.chunks(texts):
        codes = table[data]
        cells = (codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA77) + codes[2:] * np.uint32(0xC2B2AE3D)) if len(data) > 2 else codes[:0]
        cells = ((cells ^ (cells >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - bits)
        for row in range(first, end):
            low, high = int(offsets[row - first]), int(offsets[row - first + 1]) - 2
            yield row, cells[low : max(low, high)]


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Trigram shares of each ``lang`` of (doc_id, text, lang, ...); null langs teach nothing."""
    size = 1 << settings.bits

    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for row, cells in trigrams(batch.column(0), settings.bits):
                held = counts.setdefault(langs[row], np.zeros(size, np.int64))
                held += np.bincount(cells, minlength=size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array([c.tobytes() for c in counts.values()], pa.binary())], ["lang", "counts"]
        )

    known = docs.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    ids = bounded(known.select("doc_id"), settings.sample_rows).distinct()
    sample = known.join(F.broadcast(ids), "doc_id").select("text", "lang")
    # A few tables of fixed size from each task of a bounded sample.
    totals: dict[str, np.ndarray] = {}
    for part in sample.coalesce(8).mapInArrow(run, "lang string, counts binary").toLocalIterator():
        totals[part["lang"]] = totals.get(part["lang"], 0) + np.frombuffer(part["counts"], np.int64)
    languages = sorted(totals)
    shares = [(totals[lang] + settings.smoothing) / (totals[lang].sum() + settings.smoothing * size) for lang in languages]
    return Model(languages, np.log(np.array(shares)).reshape(len(languages), size))


def text_odds(rows: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """``rows``, whose first column is ``text``, with log likelihoods in place of it: one a
    language, the likeliest 0."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weights = sent.value.weights
        for batch in batches:
            sums = np.zeros((batch.num_rows, len(weights)))
            for row, cells in trigrams(batch.column(0), settings.bits):
                for first in range(0, len(cells), 1 << 16):
                    sums[row] += weights[:, cells[first : first + (1 << 16)]].sum(1)
            sums = (sums - sums.max(1, keepdims=True)) * settings.trust
            odds = np.maximum(sums, -settings.strongest)
            yield pa.RecordBatch.from_arrays([pa.array(list(odds), pa.list_(pa.float64())), *batch.columns[1:]], ["odds", *batch.schema.names[1:]])

    rest = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, f"odds array<double>, {rest}")


def posterior(odds: Column) -> Column:
    """Shares from log odds."""
    raised = F.transform(odds, lambda x: F.exp(x - F.array_max(odds)))
    total = F.aggregate(raised, F.lit(0.0), lambda a, b: a + b)
    return F.transform(raised, lambda x: x / total)


def sums(rows: DataFrame, key: str, languages: int) -> DataFrame:
    """The text posteriors of each group added up, language by language."""
    parts = [F.sum(F.col("shares")[k]) for k in range(languages)]
    return rows.groupBy(key).agg(F.array(*parts).alias(f"{key}_sums"))


def identified(pages: DataFrame, docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Language of each row of (page_id, url, html, ...), learned with (doc_id, text, lang, ...).

    Returns page_id, host, declared (null if the markup names none), suffix, language,
    confidence and text_language (of the text alone; ties go to the first by name). A null
    html has no text and declares nothing; a url without host belongs to no group of
    hosts but the empty one. Without documents of known language, language is null.
    """
    model = fit(docs, settings)
    count = len(model.languages)
    labels = F.split("host", r"\.")
    declared = F.nullif(F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), DECLARED, 1)), F.lit(""))
    rows = located(pages).select(
        F.regexp_replace(F.coalesce("html", F.lit("")), MARKUP, " ").alias("text"), "page_id", "host",
        F.element_at(labels, -1).alias("suffix"),
        F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), F.least(F.size(labels), F.lit(2))), ".").alias("domain"),
        declared.alias("declared"),
    )
    if not count:
        empty = [F.lit(None).cast(kind).alias(name) for name, kind in (("language", "string"), ("confidence", "double"), ("text_language", "string"))]
        return rows.select("page_id", "host", "declared", "suffix", *empty)
    read = text_odds(rows, model, settings).withColumn("shares", posterior(F.col("odds"))).withColumn("said", F.coalesce("declared", F.lit("")))
    read = stage(read, "odds")

    every = read.agg(F.array(*[F.sum(F.col("shares")[k]) for k in range(count)]).alias("all_sums"))
    totals = every.first()["all_sums"]
    totals = [x or 0.0 for x in totals]
    joined = read
    for key in ("host", "domain", "said", "suffix"):
        joined = joined.join(sums(read, key, count), key)
    whole = sum(totals) + settings.smoothing * count

    def smoothed(name: str, coarser: Column) -> Column:
        """Shares of a group without the page itself, drawn towards a coarser level's."""
        own = F.zip_with(name, "shares", lambda s, x: F.greatest(s - x, F.lit(0.0)))
        size = F.aggregate(own, F.lit(0.0), lambda a, b: a + b)
        return F.zip_with(own, coarser, lambda s, p: (s + settings.prior * p) / (size + settings.prior))

    joined = joined.withColumn("all", F.array(*[F.lit((t + settings.smoothing) / whole) for t in totals]))
    joined = joined.withColumn("domain_prior", smoothed("domain_sums", F.col("all")))
    joined = joined.withColumn("prior", smoothed("host_sums", F.col("domain_prior")))

    def evidence(name: str) -> Column:
        """log P(language | group) / P(language): what the group adds to the prior."""
        return F.zip_with(smoothed(name, F.col("all")), "all", lambda p, q: F.log(p / q))

    joined = joined.withColumns({"by_markup": evidence("said_sums"), "by_suffix": evidence("suffix_sums")})
    added = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    fused = added(added(F.col("odds"), F.transform("prior", lambda p: F.log(p))), added(F.col("by_markup"), F.col("by_suffix")))
    joined = joined.withColumn("found", posterior(fused))
    names = F.array(*[F.lit(name) for name in model.languages])
    best = lambda shares: F.element_at(names, F.array_position(shares, F.array_max(shares)).cast("int"))
    return joined.select(
        "page_id", "host", "declared", "suffix", best(F.col("found")).alias("language"),
        F.array_max("found").alias("confidence"), best(F.col("shares")).alias("text_language"),
    )
