"""What the driver holds while it builds the index of examples."""

import pickle

import numpy as np

from tessera.llm import toxicity as T
from tests.llm.test_toxicity import made

ARRAYS = ("idf", "counts", "rows", "weights", "pointers", "block_max", "votes", "toxic")


def test_terms_come_in_slices_of_examples(spark, monkeypatch):
    docs, labels = made(3)
    df = spark.createDataFrame([(i, t) for i, t, _ in docs], "doc_id long, text string").repartition(3, "doc_id")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    whole = T.fit(df, known)
    got, fetch = [], type(df).toArrow

    def seen(self):
        got.append(fetch(self))
        return got[-1]

    monkeypatch.setattr(type(df), "toArrow", seen)
    monkeypatch.setattr(T, "FETCH", 20)
    index = T.fit(df, known)
    assert len(index.rows) > 5 * max(t.num_rows for t in got)
    assert index.terms.equals(whole.terms) and index.ids == whole.ids
    for name in ARRAYS:
        assert np.array_equal(getattr(index, name), getattr(whole, name)), name


def test_only_postings_are_sent(spark):
    own = [str(i).translate(str.maketrans("0123456789", "abcdefghij")) + "x" for i in range(4 * T.BLOCK)]
    docs = [(i, f"common {w} {'vile ' * (i % 2)}") for i, w in enumerate(own)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    index = T.fit(df, spark.createDataFrame([(i, i % 2) for i, _ in docs], "doc_id long, toxic int"))
    want = index.judge_all(["common vile", "dx", ""])
    sent = pickle.dumps(index, protocol=5)
    # rows, weights; idf, count and text of a term; votes, toxic and id of an example
    assert index.block_max.shape == (len(docs) + 2, 4)
    assert len(sent) < 8 * len(index.rows) + 24 * len(index.terms) + 24 * len(docs) + 2000
    back = pickle.loads(sent)
    assert back.judge_all(["common vile", "dx", ""]) == want
    assert all(np.array_equal(getattr(back, n), getattr(index, n)) for n in ARRAYS)


def test_without_examples(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    index = T.fit(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert len(index.rows) == len(index.terms) == 0 and index.judge("a b") == (0.0, [])
