import random
import re
from math import comb

import pyarrow as pa
import pytest

import corpus_pipeline as P
from odd import documents, empty_documents, odd_documents, prose, rows
from tidemill.llm import near_dedup as N
from tidemill.llm.near_dedup import Settings

DOCS = "doc_id long, text string"


def shingles(text, size=5):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def by_hand(docs, percent=85):
    """Components from all pairs."""
    sets = [(doc, shingles(text)) for doc, text in docs]
    label = {doc: doc for doc, _ in docs}
    links = [
        (a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
        if x and y and 100 * len(x & y) >= percent * len(x | y)
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return sorted((doc, len(s), label[doc], label[doc] == doc) for doc, s in sets)


def edited(text, seed, edits):
    rng, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies():
    """Groups of copies of different closeness, chains of copies of copies, and strangers."""
    docs = [prose(n, 80) for n in range(30)]
    base = prose(100, 200)
    docs += [edited(base, n, n % 8) for n in range(60)]
    chain = [prose(200, 120)]
    for n in range(20):
        chain.append(edited(chain[-1], n, 1))
    docs += chain + [docs[3], docs[3].upper(), "", "a b", "A b", "a b c"]
    random.Random(5).shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("block", [512, 4])
def test_components_match_all_pairs(spark, copies, block):
    found = N.near_duplicates(spark.createDataFrame(copies, DOCS).repartition(5), Settings(block=block))
    assert rows(found) == sorted(by_hand(copies), key=repr)


def test_one_of_each_group_stays(spark, copies):
    frame = spark.createDataFrame(copies, DOCS)
    kept = sorted(r.doc_id for r in N.keep_one(frame).collect())
    assert kept == [doc for doc, _, _, stays in by_hand(copies) if stays]


def test_odd_documents(spark):
    docs = odd_documents(spark)
    found = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in N.near_duplicates(docs).collect()}
    assert found[(1, 56)] == (1, True) and found[(5, 56)] == (1, False) and found[(9, 56)] == (1, False)
    assert found[(None, 56)] == (1, False) and found[(None, 36)] == (None, True)
    assert found[(2, 0)] == (2, True) and found[(3, 0)] == (3, True) and found[(8, 1)] == (8, True)
    assert N.near_duplicates(docs).count() == len(documents())
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "6", "7", "8", "10", "None"])
    assert N.near_duplicates(empty_documents(spark)).count() == 0


def test_rows_without_id_are_linked_by_their_texts(spark):
    docs = [(None, prose(n, 100)) for n in range(5)] * 3 + [(None, edited(prose(1, 100), 7, 1)), (4, prose(2, 100)), (None, None), (None, None), (None, " "), (None, " ")]
    kept = N.keep_one(spark.createDataFrame(docs, DOCS).repartition(3)).collect()
    named = [r.doc_id for r in kept if r.doc_id is not None]
    texts = sorted((r.text or "").strip() for r in kept if r.doc_id is None)
    assert named == [4] and texts[:4] == [""] * 4 and len(texts) == 8
    assert {prose(0, 100), prose(3, 100), prose(4, 100)} < set(texts)


@pytest.mark.parametrize("block", [512, 32])
def test_what_leaves_a_task_grows_with_the_group_and_not_its_square(spark, monkeypatch, block):
    """Texts all alike but mostly below the threshold, from which each other is about 0.82."""
    made = {}
    write = N.stage

    def recorded(frame, label, *rest):
        done = write(frame, label, *rest)
        made.setdefault(label, []).append(done.count())
        return done

    monkeypatch.setattr(N, "stage", recorded)
    base = prose(300, 200).split()
    for count in (60, 240):
        docs = []
        for n in range(count):
            rng, words = random.Random(n), list(base)
            for at in rng.sample(range(200), 2):
                words[at] = f"changed{n}x{at}"
            docs.append((n, " ".join(words)))
        made.clear()
        found = N.near_duplicates(spark.createDataFrame(docs, DOCS).repartition(4), Settings(block=block))
        assert rows(found) == sorted(by_hand(docs), key=repr)
        # All pairs would be count / 2 for each text.
        assert max(made["pairs"]) <= 20 * count and max(made["links"]) <= 3 * count, made


def test_posterior_bounds_spare_links():
    """A pair at the threshold passes every look; a distant pair fails the first."""
    for n, least in N.least_matches(Settings()):
        assert 0 < least <= 0.85 * n
    assert N.least_matches(Settings())[0][1] > 0.4 * 32


def test_sets_do_not_depend_on_chunks():
    texts = [prose(n, 50) for n in range(40)] + ["", "x"]
    whole = [s.tolist() for s in N.shingle_sets(pa.array(texts), 5)]
    alone = [next(N.shingle_sets(pa.array([t]), 5)).tolist() for t in texts]
    assert whole == alone and [len(s) for s in whole] == [len(shingles(t)) for t in texts]


def test_pipeline_removes_copies_from_80_percent(spark):
    docs = []
    for n in range(12):
        words = prose(1000 + n, 200).split()
        docs.append((2 * n, " ".join(words)))
        for at in range(20, 200, 50):
            words[at] = f"changed{n}"
        docs.append((2 * n + 1, " ".join(words)))
        a, b = shingles(docs[-2][1]), shingles(docs[-1][1])
        assert 0.80 <= len(a & b) / len(a | b) < 0.85
    frame = spark.createDataFrame(docs, DOCS)
    kept = sorted(r.doc_id for r in P.distinct_documents(spark, frame, "").collect())
    assert kept == [doc for doc, _, _, stays in by_hand(docs, 80) if stays] == list(range(0, 24, 2))
    assert N.keep_one(frame).count() == len(docs)


@pytest.mark.parametrize("percent", [80, 85])
def test_links_are_lost_no_more_than_stated(percent):
    """The chance that a pair at the threshold is dropped at any look, by sums over the table."""
    settings, t = Settings(percent=percent), percent / 100
    going, read = {0: 1.0}, 0
    for n, least in N.least_matches(settings):
        step, after = n - read, {}
        for had, chance in going.items():
            for m in range(step + 1):
                after[had + m] = after.get(had + m, 0.0) + chance * comb(step, m) * t**m * (1 - t) ** (step - m)
        going, read = {m: c for m, c in after.items() if m >= least}, n
    assert 0 < 1 - sum(going.values()) <= settings.miss
