import hashlib
import re

from odd import documents, empty_documents, odd_documents, prose, rows
from oracle import connect, differences
from tidemill.llm import decontaminate as D
from tidemill.llm.oracle import ORACLE_SQL

SF_DIR = "/root/testdata/sf0.001"
BENCH = "item_id long, text string, found string"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def by_hand(docs, items):
    out = []
    for doc, text in docs:
        said, hit, named = words(text), set(), set()
        for item, phrase in items:
            wanted = words(phrase)
            size = min(10, len(wanted))
            known = {tuple(wanted[i : i + size]) for i in range(len(wanted) - size + 1)} if size else set()
            places = [i for i in range(len(said) - size + 1) if tuple(said[i : i + size]) in known] if size else []
            for i in places:
                hit |= set(range(i, i + size))
            if places and item is not None:
                named.add(str(item))
        joined = ",".join(sorted(named))
        out.append((doc, len(said), len(hit), len(named), hashlib.sha256(joined.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def cases():
    item = prose(7, 25)
    items = [(1, item), (2, prose(8, 12)), (10, "Short phrase here"), (11, None), (12, " ., "), (2, prose(9, 11)), (13, "中文"), (None, prose(20, 12))]
    part = " ".join(item.split()[4:16])
    docs = [(n, prose(50 + n, 60)) for n in range(20)]
    docs += [
        (30, f"{prose(1, 20)} {part.upper()}! {prose(2, 5)}"), (31, prose(9, 11).replace(" ", "--")), (32, "a short PHRASE, here."),
        (33, part.rsplit(" ", 3)[0]), (34, f"{item} {item}"), (35, "x 中文 y"), (36, prose(20, 12)), (37, prose(8, 9)),
    ]
    return docs, items


def test_matches_windows_by_hand(spark):
    docs, items = cases()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(*i, "f") for i in items], BENCH)
    expected = by_hand(docs, items)
    assert rows(D.digest(D.contamination(frame, bench))) == expected
    # Several blocks find the same.
    small = D.Settings(block_bytes=600)
    assert len(D.blocks(bench, small)) > 2
    assert rows(D.digest(D.contamination(frame, bench, small))) == expected
    clean = {doc for doc, *_, dirty in expected if not dirty}
    for settings in (D.Settings(), small):
        assert {r.doc_id for r in D.keep_clean(frame, bench, settings).collect()} == clean


def test_spans_are_cut_out(spark):
    docs, items = cases()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(*i, "f") for i in items], BENCH)
    left = {r.doc_id: r.text for r in D.cut_spans(frame, bench).collect()}
    assert left[30] == f"{prose(1, 20)} ! {prose(2, 5)}" and left[34] == "" and left[32] == "a ."
    assert left[5] == docs[5][1]
    for size in (300, 600, 2000):
        small = D.Settings(block_bytes=size)
        assert len(D.blocks(bench, small)) > 1
        assert {r.doc_id: r.text for r in D.cut_spans(frame, bench, small).collect()} == left


def test_an_item_goes_whole_however_many_blocks_hold_its_windows(spark):
    item = " ".join(f"w{n}" for n in range(30))
    frame = spark.createDataFrame([(1, f"a {item} z"), (1, f"a {item} z"), (None, f"{item}"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item, "f")], BENCH)
    for parts in (1, 5, 9):
        settings = D.Settings(block_bytes=(64 << 20) if parts == 1 else 21 * 130 // parts)
        left = D.cut_spans(frame, bench, settings)
        assert rows(left) == sorted([(1, "a  z"), (1, "a  z"), (2, None), (None, "")], key=repr)


def test_a_block_is_about_as_large_as_its_words(spark):
    """What is broadcast is arrays, not objects: within twice the measure of ``block_bytes``."""
    import pickle

    bench = spark.createDataFrame([(n, prose(n, 300), "f") for n in range(100)], BENCH)
    known = D.windows(bench, D.Settings()).toArrow()
    measure = sum(len(w) + 64 + 16 * len(i) for w, i in zip(known["words"].to_pylist(), known["items"].to_pylist()))
    assert len(pickle.dumps(D.Lookup(known))) < 1.2 * measure


def test_equals_its_sql(spark):
    docs, bench = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    found = D.digest(D.contamination(docs, bench))
    assert found.where("contaminated").count() > 0
    assert differences(found, connect(SF_DIR), ORACLE_SQL["op8_decontaminate"]) == ""


def test_odd_documents(spark):
    docs = odd_documents(spark)
    bench = spark.createDataFrame([(1, prose(1, 30), "f"), (None, prose(3, 11), "f")], BENCH)
    found = D.digest(D.contamination(docs, bench)).collect()
    assert len(found) == len(documents())
    assert {r.doc_id for r in found if r.contaminated} == {1, 5, 6, 9, None}
    kept = D.keep_clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(documents()) - 6
    none = bench.limit(0)
    assert D.keep_clean(docs, none).count() == len(documents())
    assert D.cut_spans(docs, none).columns == docs.columns
    assert D.digest(D.contamination(empty_documents(spark), bench)).count() == 0
