import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import toxicity as T
from tests.conftest import SF001


def made(seed=1, n=400):
    r = random.Random(seed)
    words = [f"{a}{b}" for a in "bcdfghjk" for b in ("a", "e", "io", "un")]
    bad = ["vile", "scumé", "Rotten"]
    docs, labels = [], []
    for i in range(n):
        toxic = r.random() < 0.3
        w = [r.choice(words) for _ in range(r.randint(5, 60))]
        for _ in range(3 * toxic):
            w.insert(r.randrange(len(w)), r.choice(bad))
        docs.append((i, " ".join(w), "c"))
        if r.random() < 0.7:
            labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = made()
    df = spark.createDataFrame(docs, "doc_id long, text string, score string")
    return docs, labels, df, T.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"), min_z=2.0)


def test_nearest_equals_brute_force(fitted):
    docs, _, _, index = fitted
    n, blocks = len(index.toxic), index.block_max.shape[1]
    dense = np.zeros((n, len(index.vocabulary)))
    for t in range(len(index.vocabulary)):
        for b in range(blocks):
            a, z = index.pointers[t * blocks + b], index.pointers[t * blocks + b + 1]
            dense[index.rows[a:z], t] = index.weights[a:z]
            assert (index.rows[a:z] // T.BLOCK == b).all() and index.weights[a:z].max(initial=0) == index.block_max[t, b]
    text_of = {d: t for d, t, _ in docs}
    for i, d in enumerate(index.ids):  # the index holds each example's own vector
        terms, value = index.vector(text_of[d])
        assert np.allclose(dense[i, terms], value) and np.allclose(np.delete(dense[i], terms), 0)
    for _, text, _ in docs:
        terms, value = index.vector(text)
        want = dense[:, terms] @ value if len(terms) else np.zeros(n)
        got, cosine = index.nearest(text)
        ranked = np.sort(want)[::-1][:T.NEIGHBOURS]
        assert np.allclose(cosine, ranked[ranked > 1e-12][:len(cosine)]) and len(cosine) == (ranked > 1e-12).sum()
        assert np.allclose(want[got], cosine)


def test_scores_and_filter(fitted):
    docs, labels, df, index = fitted
    out = {r.doc_id: r for r in T.score(df, index).collect()}
    toxic = {d for d, t, _ in docs if any(b in t for b in ("vile", "scumé", "Rotten"))}
    wrong = [d for d in out if (d in toxic) != bool(out[d].predicted)]
    assert len(wrong) <= 0.03 * len(docs)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and len(r.evidence) <= 3 for r in out.values())
    kept = T.keep_clean(df, index)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, r in out.items() if not r.predicted}


def test_defined_cases(spark, fitted):
    *_, index = fitted
    rows = [(1, None), (2, ""), (None, "vile vile"), (3, "zzz"), (3, "zzz"), (4, "vile scumé " * 20_000)]
    out = T.score(spark.createDataFrame(rows, "doc_id long, text string"), index).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == 6 and by[1].score == by[2].score == by[3].score == pytest.approx(index.prior) and by[4].predicted == 1
    none = T.fit(spark.createDataFrame(rows, "doc_id long, text string"),
                 spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int"))
    assert {r.score for r in T.score(spark.createDataFrame(rows, "doc_id long, text string"), none).collect()} == {0.0}
    assert T.score(spark.createDataFrame([], "doc_id long, text string"), index).count() == 0


def test_sample_is_bounded(spark):
    docs, labels = made(2)
    df = spark.createDataFrame(docs, "doc_id long, text string, score string")
    index = T.fit(df, spark.createDataFrame([*labels, (labels[0][0], 1)], "doc_id long, toxic int"), max_examples=30)
    assert len(index.toxic) == 60 and index.toxic.sum() == 30


def test_query_on_held_out_rows(spark):
    out = T.op1(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = out.join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    hit = sum(r.toxic == r.predicted for r in rows)
    caught = [r.predicted for r in rows if r.toxic]
    assert len(rows) > 300 and hit >= 0.97 * len(rows) and sum(caught) >= 0.9 * len(caught)
