from hypothesis import given, settings
from hypothesis import strategies as st

from plans import operators
from tidemill.operators import insert

SCHEMA = "pk string, email string, n int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def one_by_one(target, batch):
    """Insert row by row, skipping every conflict, as the database does."""
    keys = {r[0] for r in target}
    emails = {r[1] for r in target if r[1] is not None}
    added = []
    for pk, email, n in sorted(batch, key=lambda r: r[2]):
        if pk is None or pk in keys or email in emails:
            continue
        keys.add(pk)
        if email is not None:
            emails.add(email)
        added.append((pk, email, n))
    return sorted(added, key=repr)


def test_existing_keys_stay_and_first_row_wins(spark):
    target = frame(spark, [("a", "x", 0), ("a", "again", 0)])
    batch = frame(spark, [("a", "y", 1), ("b", "late", 3), ("b", "first", 2), (None, "z", 4)])
    assert rows(insert.insert_ignore(target, batch, "pk", ["n"])) == [("b", "first", 2)]
    assert rows(insert.insert_ignore(target, batch.limit(0), "pk", ["n"])) == []
    assert rows(insert.insert_ignore(target.limit(0), batch, "pk", ["n"])) == [
        ("a", "y", 1), ("b", "first", 2),
    ]


def test_rows_are_cut_to_one_per_key_before_the_shuffle(spark):
    batch = spark.range(1000).selectExpr(
        "IF(id < 900, 'hot', 'cold') AS pk", "'x' AS email", "CAST(id AS int) AS n"
    )
    added = insert.insert_ignore(frame(spark, [("a", "x", 0)]), batch, "pk", ["n"])
    assert rows(added) == [("cold", "x", 900), ("hot", "x", 0)]
    exchanged = [
        n.metrics().apply("shuffleRecordsWritten").value()
        for n in operators(added)
        if n.getClass().getSimpleName() == "ShuffleExchangeExec"
    ]
    assert exchanged and max(exchanged) <= 2 * batch.rdd.getNumPartitions()


def test_later_row_goes_in_when_its_rival_did_not(spark):
    # The second row loses its email to the first, so its key is free for the third.
    batch = [("1", "a", 1), ("2", "a", 2), ("2", "c", 3)]
    added = insert.insert_ignore_unique(
        frame(spark, []), frame(spark, batch), "pk", ["email"], ["n"]
    )
    assert rows(added) == [("1", "a", 1), ("2", "c", 3)]


def test_rows_without_rivals_are_not_carried_to_the_end_by_id(spark):
    batch = frame(spark, [(f"p{n}", f"e{n}", n) for n in range(3000)] + [("p0", "z", 5000)])
    added = insert.insert_ignore_unique(frame(spark, []), batch, "pk", ["email"], ["n"])
    assert len(added.collect()) == 3000
    plan = [n.getClass().getSimpleName() for n in operators(added)]
    # What is left out is a small table: a single join, without a shuffle of the rows.
    assert plan.count("BroadcastHashJoinExec") == 1 and "ShuffleExchangeExec" not in plan and "SortMergeJoinExec" not in plan


KEYS = st.one_of(st.none(), st.sampled_from("abcdefg"))


@settings(max_examples=12, deadline=None)
@given(
    st.lists(st.tuples(KEYS, KEYS), max_size=4),
    st.lists(st.tuples(KEYS, KEYS), max_size=25),
    st.randoms(use_true_random=False),
)
def test_two_keys_match_row_by_row_inserts(spark, taken, offered, random):
    target = [(pk, email, 0) for pk, email in taken if pk is not None]
    batch = [(pk, email, n) for n, (pk, email) in enumerate(offered)]
    batch += batch[:3]  # rows that repeat
    shuffled = batch[:]
    random.shuffle(shuffled)
    added = insert.insert_ignore_unique(
        frame(spark, target), frame(spark, shuffled), "pk", ["email"], ["n"]
    )
    assert rows(added) == one_by_one(target, batch)


def test_tied_rows_of_a_key_go_in_once(spark):
    batch = frame(spark, [("a", "x", 1), ("a", "x", 1), ("a", "y", 1), ("b", "y", 1)])
    added = insert.insert_ignore_unique(frame(spark, []), batch, "pk", ["email"], ["n"]).collect()
    assert len({r.pk for r in added}) == len(added) == len({r.email for r in added})


def chain(length):
    """Rows of which each shares a value with the one before."""
    return [(f"p{(n + 1) // 2}", f"e{n // 2}", n) for n in range(length)]


def test_a_chain_of_rivals_takes_few_jobs(spark):
    batch = chain(1_000)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("chain", "chain")
    try:
        added = insert.insert_ignore_unique(frame(spark, []), frame(spark, batch), "pk", ["email"], ["n"])
        assert rows(added) == one_by_one([], batch)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("chain")) < 150


def test_large_groups_are_settled_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(insert, "SETTLED_AT_ONCE", 3)
    batch = [*chain(9), ("q", "z", 20), ("r", "z", 21), ("r", None, 22)]
    added = insert.insert_ignore_unique(frame(spark, []), frame(spark, batch), "pk", ["email"], ["n"])
    assert rows(added) == one_by_one([], batch)


def test_a_long_chain_takes_steps_as_its_logarithm(spark, monkeypatch):
    """A chain whose rows each have the one before as only earlier rival, and side branches."""
    monkeypatch.setattr(insert, "SETTLED_AT_ONCE", 10)
    staged = []
    write = insert.stage

    def recorded(frame, label):
        staged.append(label)
        return write(frame, label)

    monkeypatch.setattr(insert, "stage", recorded)
    batch = chain(20_000) + [(f"p{n}", f"side{n}", 30_000 + n) for n in range(0, 9_000, 7)]
    added = insert.insert_ignore_unique(frame(spark, []), frame(spark, batch), "pk", ["email"], ["n"])
    assert rows(added) == one_by_one([], batch)
    assert staged.count("rest") <= 4 and staged.count("ways") <= 25


def test_seed_only_while_empty(spark, tmp_path):
    path = str(tmp_path / "t")

    def write(new):
        new.write.mode("append").parquet(path)

    def seed(n, also=None):
        target = frame(spark, []) if not (tmp_path / "t").exists() else spark.read.parquet(path)
        return insert.seed_if_empty(target, lambda: frame(spark, [("a", "x", n)]), write, also)

    assert seed(1) is True
    assert seed(2) is False
    # Orders are loaded again when their items are missing.
    assert seed(3, also=frame(spark, [])) is True
    assert rows(spark.read.parquet(path)) == [("a", "x", 1), ("a", "x", 3)]
