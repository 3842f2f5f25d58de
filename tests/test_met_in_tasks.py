"""Neighbours, predictions and lists that are finished in the tasks that form the sums equal those of joins, in any number of rounds."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import neighborhood as NB, similarity as S
from tessera.session import written
from test_gram import ratings


@pytest.fixture(scope="module")
def train(spark):
    rows = [x for x in ratings() if (x[0] * 7 + x[1]) % 5]
    # a constant rater, users 950 and 951 alike, a user of one rating
    rows += [(949, i, 3.0) for i in range(6)] + [(u, i, i % 4 + 1.0) for u in (950, 951) for i in range(5)] + [(952, 3, 2.0)]
    return written(spark.createDataFrame(rows, "user_id long, item_id long, rating double"), "t")


def by_joins(monkeypatch, f):
    with monkeypatch.context() as m:
        for name in ("nearest", "predicted", "best"):
            m.setattr(S, name, lambda *a, **b: None)
        return f()


@pytest.fixture(params=[(60, 10 ** 9, 4_000_000), (60, 1, 40)])
def small(request, monkeypatch):
    own, rounds, products = request.param
    for name, value in (("OWN_ROWS", own), ("ROUND_ROWS", rounds), ("ROUND_TIMES", 0), ("PRODUCTS", products), ("LIST_ROWS", 9)):
        monkeypatch.setattr(S, name, value)


def frame_of(rows):
    return sorted(rows, key=lambda r: r[:2])


@pytest.mark.parametrize("k,n_all", [(5, 98), (95, 98)])
def test_neighbours(train, small, monkeypatch, k, n_all):
    asked = train.select("user_id").distinct().where("user_id % 3 <> 1")
    run = lambda: frame_of([(r.a, r.b, r["rank"]) for r in NB.neighbours(train, "user_id", k, n_all, asked, 9)[2].where("abs(sim) > 1e-9").collect()])
    want = by_joins(monkeypatch, run)
    assert run() == want and want


@pytest.mark.parametrize("entity,k,bias,chunk", [("user_id", 3, True, 9), ("user_id", 90, False, 9), ("item_id", 30, True, 1)])
def test_predictions(spark, train, small, monkeypatch, entity, k, bias, chunk):
    pairs = spark.createDataFrame([(u, i, 1.0, "x") for u in list(range(0, 90, 4)) + [949, 950, 952, 5000] for i in list(range(0, 40, 3)) + [900, 7000]]
                                  + [(0, 3, 2.0, "y"), (None, 3, 1.0, "x"), (4, None, 1.0, "x")], "user_id long, item_id long, rating double, split string")
    key = lambda r: (r.user_id is None, r.user_id or 0, r.item_id is None, r.item_id or 0, r.split)
    run = lambda: sorted(NB.predict(train, pairs, k, entity, 130, bias, chunk=chunk).collect(), key=key)
    want = by_joins(monkeypatch, run)
    called = []
    monkeypatch.setattr(S, "_predicted_met", lambda *a, f=S._predicted_met: called.append(a) or f(*a))
    got = run()
    assert called and [key(r) for r in got] == [key(r) for r in want] and sum(abs(r.den) > 0 for r in want) > 20
    assert all(abs(a.pred - b.pred) < 1e-9 and abs(a.den - b.den) < 1e-9 for a, b in zip(got, want) if abs(b.den) > 1e-6)


@pytest.mark.parametrize("k,n", [(40, 10), (5, 60)])
def test_lists(spark, train, small, monkeypatch, k, n):
    items = train.select("item_id").unionByName(spark.range(2000, 2003).toDF("item_id"))
    users = train.select("user_id").where("user_id % 4 <> 2").unionByName(spark.range(6000, 6001).toDF("user_id"))
    run = lambda: frame_of([(r.user_id, r["rank"], r.item_id, round(r.pred, 6)) for r in NB.recommend(train, users, k, n, 120, 9, items).collect()])
    want = by_joins(monkeypatch, run)
    called = []
    monkeypatch.setattr(S, "_best_met", lambda *a, f=S._best_met: called.append(a) or f(*a))
    assert run() == want and called and len(want) > 100


def test_rounds_send_a_part_of_the_rows(train, monkeypatch):
    """What a round sends follows the ratings: a round's lists are a part of all."""
    cent = S.centered(train, "user_id", "item_id")
    monkeypatch.setattr(S, "ROUND_ROWS", 1)
    blocks = S._blocks(cent, "user_id", "item_id", None, 9, 60, 10 ** 6)
    n = cent.count()
    sent = blocks.lists.select((F.size("wants") * F.size("entities")).alias("n")).agg(F.sum("n")).first()[0]
    assert sent > S.ROUND_TIMES * n and blocks.rounds == min(-(-n // 60), -(-sent // (S.ROUND_TIMES * n)))


def test_smaller_blocks_where_one_would_meet_too_many(train):
    cent = S.centered(train, "user_id", "item_id")
    whole = S._blocks(cent, "user_id", "item_id", None, 9, 10 ** 6, 10 ** 6)
    most = cent.count() - 1
    cut = S._blocks(cent, "user_id", "item_id", None, 9, cent.count(), most)
    assert whole is not None and cut is not None


def test_rounding_as_in_spark(spark):
    r = np.random.default_rng(3)
    x = np.r_[2.0 ** -np.arange(1, 30), r.normal(size=300), r.integers(0, 10 ** 10, 200) / 1e10, (2 * r.integers(0, 10 ** 9, 200) + 1) * 5 / 1e11, 0.0]
    x = np.r_[x, -x]
    want = [y[0] for y in spark.createDataFrame([(float(v),) for v in x], "x double").select(F.round("x", 9)).collect()]
    assert [float(v) for v in S._rounded(x)] == want
