"""Mixing sources to target weights with Pareto order sampling, in DataFrame functions only.

Each document is due ``target / source size`` copies, times its preference. The whole
copies are certain; the remainder p is its inclusion probability for one more. Documents
are ranked by random odds over inclusion odds, u / (1 - u) over p / (1 - p), and taken in
that order until the source's remaining words are used up: a sample of fixed size, in
words, with unequal probabilities. The random numbers are hashes of doc_id, so that
reruns agree.

No source is sorted as a whole. The words of each narrow range of ranks are summed, the
range where the target is met is refined once, and only the few documents of that last
range are ranked one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.store import stage


@dataclass(frozen=True)
class Settings:
    weights: tuple[int, ...] = (3, 1, 2)
    """Weights of the sources in code-point order, null last, repeating."""
    share: float = 1.5
    """Words of the mix, of those of all sources."""
    most: int = 2
    """Most copies of a document, and of a source."""
    coarse: int = 32
    """Ranges in a unit of the rank's logarithm."""
    fine: int = 4096
    """Parts of the range where a target is met."""


WORD = r"[^\x20\x09-\x0D]+"


def measured(docs: DataFrame, preference: Column | None = None) -> list[Column]:
    """Size, key of the source, chance, order among equals, and preference of a document."""
    chance = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 13), 16, 10).cast("double")
    liked = F.lit(1.0) if preference is None else F.greatest(F.coalesce(preference.cast("double"), F.lit(0.0)), F.lit(0.0))
    return [
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("mix_size"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("mix_source"),
        ((chance + 0.5) / F.lit(float(1 << 52))).alias("mix_chance"),
        F.xxhash64("doc_id", "text").alias("mix_order"),
        liked.alias("mix_liked"),
    ]


def targets(sizes: DataFrame, settings: Settings) -> DataFrame:
    """``sizes`` (mix_source, source_size), one row a source, with its target.

    A target is the source's weight times a level that all share, but at most ``most``
    times the source's size. In the order of the level at which they are full, the first
    source that is not full has the level.
    """
    place = F.row_number().over(Window.orderBy(F.col("mix_source") == "", "mix_source")) - 1
    weights = F.array(*[F.lit(w) for w in settings.weights])
    weighed = sizes.withColumn("weight", F.element_at(weights, (place % len(settings.weights)) + 1))
    by_level = Window.orderBy(F.col("source_size") * 1.0 / F.col("weight"), "mix_source")
    total = F.sum("source_size").over(Window.partitionBy()) * settings.share
    before = F.coalesce(F.sum(F.col("source_size") * settings.most).over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight = F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    levels = weighed.withColumn("level", (total - before) / weight)
    full = F.col("source_size") * settings.most <= F.col("level") * F.col("weight")
    shared = F.min(F.when(~full, F.struct((F.col("source_size") * 1.0 / F.col("weight")).alias("a"), F.col("mix_source").alias("b"), "level"))).over(
        Window.partitionBy()
    )["level"]
    target = F.when(full, (F.col("source_size") * settings.most).cast("double")).otherwise(shared * F.col("weight"))
    return levels.select("mix_source", "source_size", target.alias("target"))


def ranked(rows: DataFrame, settings: Settings) -> DataFrame:
    """Whole copies and rank of each row of ``measured`` columns joined with its source's plan."""
    due = F.least(
        F.lit(float(settings.most)),
        F.when(F.col("liked_size") > 0, F.col("target") * F.col("mix_liked") / F.col("liked_size")).otherwise(F.lit(0.0)),
    )
    part = F.col("due") - F.col("whole")
    odds = F.col("mix_chance") / (1 - F.col("mix_chance")) / (part / (1 - part))
    return (
        rows.withColumn("due", due).withColumn("whole", F.floor("due"))
        .withColumn("mix_rank", F.when(part > 0, F.log(odds)))
        .withColumn("coarse", F.floor(F.col("mix_rank") * settings.coarse))
        .withColumn("fine", F.floor(F.col("mix_rank") * (settings.coarse * settings.fine)))
    )


def plan(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row a source of ``measured`` rows: sizes, target, and the last rank that is taken."""
    sizes = docs.groupBy("mix_source").agg(
        F.sum("mix_size").alias("source_size"), F.sum(F.col("mix_size") * F.col("mix_liked")).alias("liked_size")
    )
    aims = stage(targets(sizes.select("mix_source", "source_size"), settings).join(sizes.drop("source_size"), "mix_source"), "targets")
    rows = ranked(docs.join(aims, "mix_source"), settings)
    left = rows.groupBy("mix_source").agg(
        (F.first("target") - F.sum(F.col("whole") * F.col("mix_size"))).alias("left")
    )
    left = stage(left, "left")
    open_rows = rows.where("mix_rank is not null").join(left, "mix_source")

    coarse = _met(open_rows.groupBy("mix_source", "coarse").agg(F.sum("mix_size").alias("words"), F.first("left").alias("left")), "coarse", F.lit(0))
    coarse = stage(coarse, "edges")
    inside = open_rows.join(coarse.withColumnRenamed("before", "below"), ["mix_source", "coarse"])
    fine = _met(
        inside.groupBy("mix_source", "fine").agg(F.sum("mix_size").alias("words"), F.first("left").alias("left"), F.first("below").alias("below")),
        "fine", F.col("below"),
    )
    fine = stage(fine, "edges")

    edge = open_rows.join(fine, ["mix_source", "fine"])
    order = Window.partitionBy("mix_source").orderBy("mix_rank", "mix_order").rowsBetween(Window.unboundedPreceding, 0)
    taken = edge.withColumn("sum", F.col("before") + F.sum("mix_size").over(order) - F.col("mix_size") / 2.0).where("sum <= left")
    last = taken.groupBy("mix_source").agg(F.max(F.struct("mix_rank", "mix_order")).alias("last"))
    whole = aims.join(left, "mix_source").join(fine.select("mix_source", F.col("fine").alias("edge")), "mix_source", "left")
    return stage(whole.join(last, "mix_source", "left"), "plan")


def _met(words: DataFrame, part: str, below: Column) -> DataFrame:
    """The range of each source in which its words are used up, and the words before it."""
    order = Window.partitionBy("mix_source").orderBy(part)
    sums = words.withColumn("until", below + F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    reached = sums.where(F.col("until") >= F.col("left")).groupBy("mix_source").agg(F.min(F.struct(part, (F.col("until") - F.col("words")).alias("before"))).alias("met"))
    return reached.select("mix_source", f"met.{part}", "met.before")


def copies(rows: DataFrame, planned: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``rows`` with ``measured`` columns, and the copies that the mix takes of each.

    Where a source's words do not reach its target, all its documents are taken; with no
    words left to give, none beyond the whole copies.
    """
    found = ranked(rows.join(planned, "mix_source"), settings)
    before = F.col("fine") < F.col("edge")
    on_edge = (F.col("fine") == F.col("edge")) & (F.struct("mix_rank", "mix_order") <= F.col("last"))
    more = (F.col("left") > 0) & F.col("mix_rank").isNotNull() & (F.col("edge").isNull() | before | F.coalesce(on_edge, F.lit(False)))
    return found.withColumn("copies", F.col("whole") + F.coalesce(more, F.lit(False)).cast("long"))


def digest(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Size, target and words taken of each row of (doc_id, text, source, ...).

    A null text has no words; documents without a source are a source by themselves. Rows
    that repeat a doc_id have the same chance and are told apart by their text.
    """
    rows = stage(docs.select("doc_id", *measured(docs)), "sizes")
    found = copies(rows, plan(rows, settings), settings)
    return found.select(
        "doc_id", F.col("mix_size").alias("size"), "source_size", "target", (F.col("copies") * F.col("mix_size")).alias("taken")
    )


def mixed(docs: DataFrame, settings: Settings = Settings(), preference: str | None = None) -> DataFrame:
    """The mix: each row of ``docs`` as often as it is taken, with the columns of ``docs``.

    ``preference`` names a column of relative inclusion odds (null or negative: 0); a
    source comes short of its target only where its preferred documents run out.
    """
    names = [n if n in ("doc_id", "text", "source") else f"x{i}" for i, n in enumerate(docs.columns)]
    plain = docs.toDF(*names)
    liked = F.col(names[docs.columns.index(preference)]) if preference else None
    planned = plan(stage(plain.select(*measured(plain, liked)), "sizes"), settings)
    found = copies(plain.select("*", *measured(plain, liked)), planned, settings).where("copies > 0")
    repeated = found.select(*names, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return repeated.drop("copy").toDF(*docs.columns)
