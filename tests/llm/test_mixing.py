from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from odd import documents, empty_documents, odd_documents, prose
from oracle import connect, differences
from tidemill.llm import mixing as M
from tidemill.llm.oracle import ORACLE_SQL

SF_DIR = "/root/testdata/sf0.001"


def reshared(sizes, weights, total, most=2):
    """Targets by sharing out again and again."""
    targets, full = [0.0] * len(sizes), [False] * len(sizes)
    while True:
        left = total - sum(most * s for s, f in zip(sizes, full) if f)
        parts = sum(w for w, f in zip(weights, full) if not f)
        targets = [most * s if f else left * w / parts for s, w, f in zip(sizes, weights, full)]
        above = [t > most * s for t, s in zip(targets, sizes)]
        if not any(a and not f for a, f in zip(above, full)):
            return targets
        full = [a or f for a, f in zip(above, full)]


@pytest.mark.parametrize("sizes", [[10, 1000, 30, 5, 500], [1, 1], [7], [100, 0, 3, 900, 20, 20, 20]])
def test_targets_match_resharing(spark, sizes):
    names = [f"={chr(97 + n)}" for n in range(len(sizes))]
    frame = spark.createDataFrame(list(zip(names, sizes)), "mix_source string, source_size long")
    got = {r.mix_source: r.target for r in M.targets(frame, M.Settings()).collect()}
    weights = [(3, 1, 2)[n % 3] for n in range(len(sizes))]
    assert [got[n] for n in names] == pytest.approx(reshared(sizes, weights, 1.5 * sum(sizes)))


def test_mix_equals_its_sql(spark):
    frame = M.digest(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    assert differences(frame, connect(SF_DIR), ORACLE_SQL["op6_mix_sources"]) == ""


def test_words_come_near_their_targets_whatever_the_bins(spark):
    docs = [(n, prose(n, 1 + n * 7 % 90), "abc"[n % 9 // 4]) for n in range(3000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    found = {s: M.digest(frame, s).collect() for s in (M.Settings(), M.Settings(coarse=1, fine=2))}
    first, second = ({r.doc_id: r.taken for r in rows} for rows in found.values())
    assert first == second
    taken, target = defaultdict(int), {}
    for r in found[M.Settings()]:
        source = docs[r.doc_id][2]
        taken[source] += r.taken
        target[source] = r.target
        assert r.taken in (0, r.size, 2 * r.size)
    assert all(abs(taken[s] - target[s]) <= 45 for s in target)


def test_preferred_documents_are_taken_more_often(spark):
    docs = [(n, prose(n, 20), "a" if n % 2 else "b", float(n % 4 > 1)) for n in range(800)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, wish double")
    counts = Counter(r.doc_id for r in M.mixed(frame, M.Settings(share=0.4), "wish").collect())
    assert all(counts[n] == 0 for n, _, _, wish in docs if not wish)
    assert sum(counts.values()) == pytest.approx(0.4 * 800, abs=3)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    found = M.digest(docs).collect()
    assert len(found) == len(documents())
    assert {r.size for r in found if r.doc_id in (2, 3, 4)} == {0}
    assert all(r.taken <= 2 * r.size for r in found)
    mixed = M.mixed(docs)
    assert mixed.columns == docs.columns
    assert set(map(str, mixed.collect())) <= set(map(str, docs.collect()))
    assert M.digest(empty_documents(spark)).count() == M.mixed(empty_documents(spark)).count() == 0


def test_no_python_on_the_way(spark):
    frame = M.mixed(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    plan = frame._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    assert frame.where(F.col("doc_id").isNull()).count() == 0
