"""Insert-ignore: add the rows of a batch whose keys are not taken yet."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import stage, unstage


def insert_ignore(
    target: DataFrame, batch: DataFrame, key: str | list[str], order_by: list[str | Column]
) -> DataFrame:
    """The rows of ``batch`` to append to ``target``: existing keys stay, the first row wins.

    ``order_by`` says which row of a key is first and must decide between any
    two. A NULL key is refused, as a primary key refuses it. Spark cuts each
    task's rows to one per key before the shuffle (a row_number limit), so a
    hot key stays small. Of the target only keys the batch holds are kept: while
    the batch is small enough to broadcast, the target is not shuffled; beyond that
    its keys are cut to one row each before they meet the batch.
    """
    keys = [key] if isinstance(key, str) else key
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    first = batch.where(known).withColumn("__place", place).where("__place = 1").drop("__place")
    taken = target.select(*keys).distinct().join(first.select(*keys), keys, "left_semi")
    return first.join(taken, keys, "left_anti").select(*batch.columns)


# Rows of a group of rivals that one task settles, each compared with those accepted before it.
SETTLED_AT_ONCE = 2_000


def insert_ignore_unique(
    target: DataFrame,
    batch: DataFrame,
    primary_key: str,
    unique: list[str],
    order_by: list[str],
) -> DataFrame:
    """``insert_ignore`` under a primary key and further unique columns, row by row in effect.

    A row goes in when no row before it that went in shares its primary key or
    a unique value; NULL is not shared in a unique column. Of rows that tie in
    ``order_by``, any may come first. Rows without rivals go in at once. The others
    are joined to groups of direct and indirect rivals, which cannot touch each
    other: a group of up to ``SETTLED_AT_ONCE`` rows is walked through in order in one
    expression; larger ones are settled in rounds, in each of which the rows that are
    first under all their keys go in, chains that begin with them are followed to their
    ends, and rows sharing a key with an accepted one are out. Only order and keys take
    part; the rows themselves are fetched once, at the end.
    """
    keys = [primary_key, *unique]
    offered = batch.where(F.col(primary_key).isNotNull())
    for key in keys:
        offered = _without_values(offered, target, key)
    # Written once, so that the ids that tell tied rows apart stay the same.
    offered = stage(offered.withColumn("__id", F.monotonically_increasing_id()), "offered")
    order = F.struct(*order_by, "__id")

    ties = reduce(DataFrame.unionByName, [_ties(offered, key) for key in keys])
    groups = _groups(ties)
    sizes = groups.groupBy("__group").agg(F.count("*").alias("__size"))
    # Rivals alone are fetched, once, and each of their columns once.
    named = offered.select("__id", *dict.fromkeys([*order_by, *keys]))
    rivals = stage(named.join(groups.join(sizes, "__group"), "__id"), "rivals").withColumn("__order", order)
    small = rivals.where(F.col("__size") <= SETTLED_AT_ONCE)
    large = rivals.where(F.col("__size") > SETTLED_AT_ONCE)
    accepted = [_walked(small, keys), *_in_rounds(large.select("__id", "__order", *keys), keys)]
    chosen = reduce(DataFrame.unionByName, accepted)
    # Rows without rivals are most, and meet nothing but the ids that stay out.
    out = stage(groups.select("__id").join(chosen, "__id", "left_anti"), "out")
    return offered.join(out, "__id", "left_anti").select(*batch.columns)


def _ties(rows: DataFrame, key: str) -> DataFrame:
    """Each row of a shared key value with the first of them: edges (a, b) between ids."""
    known = rows.where(F.col(key).isNotNull())
    firsts = known.groupBy(key).agg(F.min("__id").alias("b"), F.count("*").alias("n"))
    pairs = known.select(F.col("__id").alias("a"), key).join(firsts.where("n > 1"), key)
    return pairs.where("a <> b").select("a", "b")


def _groups(ties: DataFrame) -> DataFrame:
    """(__id, __group): the least id that each end of the edges reaches.

    Each node is tied to the least of its neighbours and itself, from the greater
    side and the smaller in turn, until every group is a star; long chains halve.
    """
    edges = stage(ties.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "ties")
    while not edges.join(edges.select(F.col("v").alias("u")), "u", "left_semi").isEmpty() or not (
        edges.groupBy("u").count().where("count > 1").isEmpty()
    ):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        above = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = above.groupBy("u").agg(F.min("v").alias("m"))
        below = above.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stage(below.unionByName(least.withColumnRenamed("m", "v")).distinct(), "ties")
        unstage(edges)
        edges = after
    roots = edges.select(F.col("v").alias("__id"), F.col("v").alias("__group")).distinct()
    return roots.unionByName(edges.select(F.col("u").alias("__id"), F.col("v").alias("__group")))


def _walked(rivals: DataFrame, keys: list[str]) -> DataFrame:
    """The ids that go in when each group is walked through in order."""
    row = F.struct("__order", *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    groups = rivals.groupBy("__group").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    none = F.slice("rows", 1, 0)

    def clash(a: Column, b: Column) -> Column:
        shared = [F.coalesce(a[f"k{i}"] == b[f"k{i}"], F.lit(False)) for i in range(len(keys))]
        return reduce(lambda x, y: x | y, shared)

    def step(taken: Column, one: Column) -> Column:
        blocked = F.exists(taken, lambda other: clash(other, one))
        return F.when(blocked, taken).otherwise(F.concat(taken, F.array(one)))

    accepted = groups.select(F.explode(F.aggregate("rows", none, step)).alias("row"))
    return accepted.select(F.col("row.__order.__id").alias("__id"))


def _in_rounds(rest: DataFrame, keys: list[str]) -> list[DataFrame]:
    """The ids that go in, round by round.

    In a round, rows without an earlier rival go in, chains of rows with just one earlier
    rival are decided up to their ends, and all that share a key with an accepted row are out.
    """
    accepted = []
    rest = stage(rest, "rest")
    while not rest.isEmpty():
        places = stage(_places(rest, keys), "places")
        leaders = places.where(F.col("firsts") == len(keys)).select("__id")
        one_rival = (F.col("rivals") == 1) & (F.col("firsts") == len(keys) - 1)
        followers = places.where(one_rival).select("__id", "to")
        chosen = stage(leaders.unionByName(_every_other(followers, leaders)), "chosen")
        accepted.append(chosen)
        left, taken = rest, stage(rest.join(chosen, "__id", "left_semi"), "taken")
        for key in keys:
            left = _without_values(left, taken, key)
        after = stage(left, "rest")
        for done in (rest, places, taken):
            unstage(done)
        rest = after
    return accepted


def _places(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(__id, firsts, rivals, to) of the rows that are first or second under a key.

    ``firsts`` counts the keys under which a row is first, ``rivals`` those under which it is second,
    with the first row of such a key in ``to``. A row without a value is first under that key.
    Two least orders of each value are all that is looked at, so rows of a hot key spread out.
    """
    parts = []
    for key in keys:
        known = rows.where(F.col(key).isNotNull()).select(key, "__order")
        first = known.groupBy(key).agg(F.min("__order").alias("__first"))
        later = known.join(first.select(F.col("__first").alias("__order")), "__order", "left_anti")
        second = later.groupBy(key).agg(F.min("__order").alias("__second")).join(first, key)
        none = rows.where(F.col(key).isNull()).select(F.col("__order.__id").alias("__id"))
        firsts = first.select(F.col("__first.__id").alias("__id")).unionByName(none)
        parts.append(firsts.select("__id", F.lit(1).alias("firsts"), F.lit(0).alias("rivals"), F.lit(None).cast("long").alias("to")))
        parts.append(
            second.select(F.col("__second.__id").alias("__id"), F.lit(0).alias("firsts"), F.lit(1).alias("rivals"), F.col("__first.__id").alias("to"))
        )
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("__id").agg(F.sum("firsts").alias("firsts"), F.sum("rivals").alias("rivals"), F.max("to").alias("to"))


def _every_other(followers: DataFrame, leaders: DataFrame) -> DataFrame:
    """The ids that go in of chains (__id, to) whose first row goes in: each second one.

    A row whose only earlier rival is ``to`` goes in just if that one does not. Each step
    doubles the way that a row looks back, so a chain takes steps as its logarithm.
    """
    ways = stage(followers.withColumn("steps", F.lit(1).cast("long")), "ways")
    while True:
        ahead = ways.select(F.col("__id").alias("to"), F.col("to").alias("__next"), F.col("steps").alias("__more"))
        if ways.join(ahead, "to", "left_semi").isEmpty():
            break
        further = ways.join(ahead, "to", "left").select(
            "__id", F.coalesce("__next", "to").alias("to"), (F.col("steps") + F.coalesce("__more", F.lit(0))).alias("steps")
        )
        after = stage(further, "ways")
        unstage(ways)
        ways = after
    begun = ways.join(leaders.select(F.col("__id").alias("to")), "to", "left_semi")
    return begun.where(F.col("steps") % 2 == 0).select("__id")


def _without_values(rows: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not taken; a NULL key is never taken."""
    offered = rows.select(key).where(F.col(key).isNotNull()).distinct()
    held = taken.select(key).distinct().join(offered, key, "left_semi")
    return rows.join(held, key, "left_anti")


def seed_if_empty(
    target: DataFrame,
    rows: Callable[[], DataFrame],
    write: Callable[[DataFrame], None],
    also_required: DataFrame | None = None,
) -> bool:
    """Write the seed rows only while the target, or ``also_required``, has none.

    Returns whether it wrote. ``rows`` is called only then.
    """
    tables = [target] if also_required is None else [target, also_required]
    if not any(table.isEmpty() for table in tables):
        return False
    write(rows())
    return True
