import struct
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline as P
from odd import DOCS, documents, odd_documents
from test_decontaminate import by_hand as hits_by_hand
from test_near_dedup import by_hand as components_by_hand
from test_quality import by_hand as counts_by_hand
from test_quality import features
from tidemill.llm import quality_rules, queries, statistics
from tidemill.llm.oracle import ORACLE_SQL

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = set(entry_points.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert {name.split("_")[0] for name in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_stages_take_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    held = {tuple(r) for r in docs.collect()}
    counts = [len(held)]
    for name, apply in P.STAGES[:-1]:
        docs = P.stage(apply(spark, docs, SF_DIR), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        now = Counter(tuple(r) for r in docs.collect())
        assert set(now) <= held and (max(now.values()) == 1 or name == "mix_sources")
        held = set(now)
        counts.append(sum(now.values()))
    assert counts[0] > counts[1] > counts[2] > counts[3]
    out = P.STAGES[-1][1](spark, docs, SF_DIR)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in docs.collect())


def chain_by_hand(docs, items, rules, vocabulary):
    """(doc_id, start, n_tokens, ids_crc32) of the five stages by plain loops, sets and one SQL."""
    passed = []
    for row in docs:
        n = counts_by_hand(row.text)
        if n["n_words"] >= 20 and 100 * n["n_repeat_words"] <= 30 * n["n_words"]:
            table = pd.DataFrame([features(row.text)])
            if not any(np.all([c.holds(table) for c in rule]) for rule in rules):
                passed.append(row)
    stays = {doc for doc, _, _, kept in components_by_hand([(r.doc_id, r.text) for r in passed], 80) if kept}
    distinct = [r for r in passed if r.doc_id in stays]
    dirty = {doc for doc, *_, hit in hits_by_hand([(r.doc_id, r.text) for r in distinct], items) if hit}
    clean = [r for r in distinct if r.doc_id not in dirty]
    documents = pa.table({name: [r[name] for r in clean] for name in ("doc_id", "text", "source")})  # noqa: F841
    found = duckdb.sql(ORACLE_SQL["op6_mix_sources"]).fetchall()
    copies = {doc: taken // size for doc, size, _, _, taken in found}
    library, out, start = Tokenizer.from_file(str(vocabulary)), [], 0
    for row in sorted(clean, key=lambda r: r.doc_id):
        ids = [*library.encode(row.text, add_special_tokens=False).ids, 2]
        for _ in range(copies[row.doc_id]):
            out.append((row.doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
            start += len(ids)
    return [len(docs), len(passed), len(distinct), len(clean)], out


def test_run_equals_the_stages_by_hand(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    rules = quality_rules.fit(statistics.counted(docs.select("doc_id", "text")), spark.read.parquet(f"{folder}/labels.parquet"))
    steps, expected = chain_by_hand(docs.collect(), items, rules, public_tokenizers.path(P.VOCABULARY))
    found = P.run(spark, folder)
    assert rules and found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == expected
    assert steps[0] > steps[1] > steps[2] > steps[3] > 0 and max(Counter(r[0] for r in expected).values()) == 2


@pytest.mark.parametrize("stage", P.STAGES[:-1], ids=lambda s: s[0])
def test_stages_keep_columns_of_odd_documents(spark, stage):
    docs = odd_documents(spark)
    out = stage[1](spark, docs, SF_DIR)
    assert out.columns == docs.columns and 0 < out.count() <= 2 * len(documents())
    assert stage[1](spark, spark.createDataFrame([], DOCS), SF_DIR).count() == 0
