import numpy as np
import pyarrow as pa
import pytest

from tidemill.llm import store
from tidemill.llm import words as W


@pytest.mark.parametrize("cut", [1, 2, 3, 100])
def test_groups_cross_batches(cut):
    rows = pa.table({"a": [1, 1, 1, 2, 2, 3, 3, 3, 3], "b": [0, 0, 1, 1, 1, 1, 1, 1, 2], "v": list(range(9))})
    found = [g["v"].to_pylist() for g in store.grouped(iter(rows.to_batches(cut)), ["a", "b"])]
    assert found == [[0, 1], [2], [3, 4], [5, 6, 7], [8]]


def test_groups_of_empty_batches():
    empty = pa.RecordBatch.from_pydict({"a": pa.array([], pa.int64())})
    assert list(store.grouped(iter([empty, empty]), ["a"])) == []


def test_bounded_samples_are_stable_and_bounded(spark):
    rows = spark.range(5000).select(spark.range(1).columns[0]).toDF("doc_id")
    first = sorted(r.doc_id for r in store.bounded(rows, 200).collect())
    again = sorted(r.doc_id for r in store.bounded(rows.repartition(7), 200).collect())
    assert first == again and 150 <= len(first) <= 200
    assert store.bounded(rows, 10_000).count() == 5000


def test_staged_tables_are_removed(spark):
    frame = store.stage(spark.range(10).toDF("n"), "numbers")
    assert frame.count() == 10
    store.drop_staged(frame)
    with pytest.raises(Exception):
        spark.read.parquet(frame.inputFiles()[0]).count()


def test_equal_words_hash_alike_wherever_they_stand():
    texts = pa.array(["Alpha beta", None, "beta  ALPHA\tβeta", "", "beta"])
    ((first, end, data, offsets),) = W.chunks(texts)
    folded = W.words(data, offsets, W.SPACED, fold=True)
    assert (first, end, folded.count.tolist()) == (0, 5, [2, 0, 3, 0, 1])
    h = folded.hashes
    assert h[0] == h[3] and h[1] == h[2] == h[5] and len(set(h.tolist())) == 3
    exact = W.words(data, offsets, W.SPACED, fold=False).hashes
    assert exact[0] != exact[3] and exact[1] == exact[2]
    assert W.covered(np.array([1, 2]), 3, 6).tolist() == [False, True, True, True, True, False]
