import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from odd import documents, empty_documents, odd_documents, prose, rows
from tidemill.llm import quality_gam as G
from tidemill.llm import quality_rules as Q
from tidemill.llm import statistics as S
from tidemill.llm import words as W

SF_DIR = "/root/testdata/sf0.001"


def by_hand(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    repeated = {i + k for i in range(len(found) - 7) if windows[tuple(found[i : i + 8])] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return {
        "n_words": len(found), "word_chars": sum(map(len, found)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated), "n_lines": len(lines),
        "n_distinct_words": len(set(found)), "n_chars": len(text), "n_digits": len(re.findall("[0-9]", text)),
        "n_upper": len(re.findall("[A-Z]", text)), "n_same_words": sum(a == b for a, b in zip(found, found[1:])),
    }


def texts():
    again = "\n".join([prose(1, 9), prose(2, 9), prose(1, 9), "", "  ", "  ", " " + prose(1, 9)])
    return [d[1] for d in documents()] + [again, "a " * 50, "x # $ < > | % & *", " é ü\x0bŒ\x0c", "\n\n", "same\nsame\n"]


def test_counts_match_the_words_by_hand(monkeypatch):
    for limit in (1 << 20, 10):
        parts = [S.count(data, offsets) for _, _, data, offsets in W.chunks(pa.array(texts()), limit)]
        for name in by_hand(""):
            got = np.concatenate([part[name] for part in parts]).tolist()
            assert got == [by_hand(text)[name] for text in texts()], name


def labelled(count=600):
    """Documents of which those with symbols, or with one word over and over, are bad."""
    rng, docs, labels = random.Random(4), [], []
    for n in range(count):
        kind = rng.randrange(6)
        words = prose(n, rng.randrange(25, 120)).split()
        if kind == 0:
            words = [w + rng.choice(["%%%", "###", "$"]) for w in words]
        if kind == 1:
            words = [w for w in words[: len(words) // 5 + 4] for _ in range(5)]
        docs.append((n, " ".join(words)))
        labels.append((n, int(kind > 1), 0))
    return docs, labels


def test_rules_are_learned_and_reject_in_order(spark):
    docs, labels = labelled()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame(labels[:400], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in Q.digest(frame, marks).collect()}
    truth = {doc: quality for doc, quality, _ in labels}
    unseen = [found[n] for n in range(400, 600) if not found[n].base_failed]
    assert np.mean([r.kept == bool(truth[r.doc_id]) for r in unseen]) > 0.95
    for r in found.values():
        assert r.kept == (not r.base_failed and r.rule == 0)
        expected = by_hand(docs[r.doc_id][1])
        assert r.base_failed == (expected["n_words"] < 20 or 100 * expected["n_repeat_words"] > 30 * expected["n_words"])
    kept = {r.doc_id for r in Q.keep_good(frame, marks).collect()}
    assert kept == {n for n, r in found.items() if r.kept}


def features(text):
    """The ratios that rules read, by hand."""
    n, text = by_hand(text), text or ""
    letters = sum(c.isascii() and c.isalpha() or not c.isascii() for c in text)
    share = lambda above, below: above / below if below else 0.0
    return {
        "words": float(n["n_words"]), "word_length": share(n["word_chars"], n["n_words"]), "symbols": share(n["n_symbols"], n["n_words"]),
        "repeated_lines": share(n["n_dup_lines"], n["n_lines"]), "repeated_words": share(n["n_repeat_words"], n["n_words"]),
        "distinct_words": share(n["n_distinct_words"], n["n_words"]), "same_words": share(n["n_same_words"], n["n_words"]),
        "capitals": share(n["n_upper"], letters), "digits": share(n["n_digits"], n["n_chars"]), "shouts": share(text.count("!"), n["n_words"]),
        "stops": share(sum(text.count(c) for c in ".,;:?"), n["n_words"]), "bars": share(text.count("|"), n["n_words"]),
        "letters": share(letters, n["n_chars"]), "line_words": share(n["n_words"], n["n_lines"]),
    }


def test_the_column_chain_says_what_the_conditions_hold(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    counted = S.counted(docs)
    rules = Q.fit(counted.select("doc_id", "statistics"), spark.read.parquet(f"{folder}/labels.parquet"))
    assert rules
    rules += [(Q.Condition("words", True, 100.0), Q.Condition("stops", False, 0.05)), (Q.Condition("digits", True, 0.0),)]
    found = Q.judged(counted, rules).collect()
    table = pd.DataFrame([features(r.text) for r in found])
    for name, column in S.ratios().items():
        mine = [r[0] for r in counted.select(column).collect()]
        assert np.allclose(mine, table[name].to_numpy(), rtol=1e-12, atol=0), name
    held = np.array([Q._covers(rule, table) for rule in rules])
    first = np.where(held.any(0), held.argmax(0) + 1, 0)
    assert [r.rule for r in found] == first.tolist() and len(set(first)) > 2


def test_a_list_covers_one_part_after_the_other():
    rng = np.random.default_rng(0)
    data = pd.DataFrame({"a": rng.random(3000), "b": rng.random(3000)})
    reject = ((data.a > 0.8) | ((data.b < 0.2) & (data.a < 0.5))).to_numpy()
    rules = Q.learn(data, reject, np.arange(3000) % 3 != 0)
    found = np.any([Q._covers(rule, data) for rule in rules], axis=0)
    assert (found == reject).mean() > 0.95 and all(len(rule) <= 4 for rule in rules)
    assert Q.learn(data, np.zeros(3000, bool), np.arange(3000) % 3 != 0) == []
    assert Q.learn(data.head(0), reject[:0], reject[:0]) == []


def test_odd_documents_and_no_labels(spark):
    docs, none = odd_documents(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1, 0), (1, None, 0), (1, 1, 0), (1, 0, 0), (77, 0, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        found = Q.digest(docs, labels)
        assert found.count() == len(documents())
        assert {r.base_failed for r in found.where("doc_id in (2, 3, 4, 8)").collect()} == {True}
        kept = Q.keep_good(docs, labels)
        assert kept.columns == docs.columns
        assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 5, 5, None, None, 6, 9, 10] )
        scores = G.digest(docs, labels).collect()
        assert len(scores) == len(documents()) and all(0 <= r.score <= 1 for r in scores)
    assert Q.digest(empty_documents(spark), none).count() == G.digest(empty_documents(spark), none).count() == 0


def test_score_ranks_held_out_documents(spark):
    docs, labels = labelled()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = G.digest(frame, marks).collect()
    truth = {doc: quality for doc, quality, _ in labels}
    out = [r for r in found if r.held_out]
    assert {r.doc_id for r in out} == {n for n, _ in docs if zlib.crc32(str(n).encode()) % 5 == 0}
    good, bad = ([r.score for r in out if truth[r.doc_id] == q] for q in (1, 0))
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97
    assert all(r.predicted == int(r.score >= 0.3) for r in found)
    # Held-out labels change nothing.
    flipped = marks.withColumn("quality", F.when(G.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert rows(G.digest(frame, flipped)) == sorted(map(tuple, found), key=repr)


def test_a_score_is_a_sum_of_table_entries():
    rng = np.random.default_rng(1)
    values = {"a": rng.random(2000), "b": rng.random(2000)}
    label = ((values["a"] > 0.5) ^ (values["b"] > 0.5)).astype(float)
    model = G.learn(values, label)
    assert ("a", "b") in model.pair_tables
    assert ((model.score(values) > 0.5) == label).mean() > 0.9
    total = np.full(2000, model.base)
    for name, table in model.tables.items():
        total += [table[(model.cuts[name] < x).sum()] for x in values[name]]
    for (a, b), table in model.pair_tables.items():
        total += [table[(model.pair_cuts[a] < x).sum(), (model.pair_cuts[b] < y).sum()] for x, y in zip(values[a], values[b])]
    assert np.allclose(model.score(values), 1 / (1 + np.exp(-total)))
