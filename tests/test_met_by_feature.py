"""Neighbours by feature: a block of entities meets the raters of its own features only."""
import pytest
from pyspark.sql import functions as F

from tessera.operators import similarity as S
from test_gram import ratings


@pytest.fixture(scope="module")
def cent(spark):
    df = spark.createDataFrame(ratings(), "user_id long, item_id long, rating double")
    return S.centered(df, "user_id", "item_id")


def ranks(found, k, n_all):
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("_nco"))
    near = S.top_k(found.where("b IS NOT NULL").drop("n"), k, n_all, counts)
    return sorted((r.a, r.b, r["rank"]) for r in near.where("abs(sim) > 1e-9").collect())


@pytest.mark.parametrize("k,n_all,products", [(1, 120, 4_000_000), (5, 95, 40), (80, 95, 4_000_000)])
def test_same_neighbours_as_pairs_of_blocks(cent, monkeypatch, k, n_all, products):
    asked = cent.select("user_id").distinct().where("user_id % 3 <> 1")
    want = S.candidates(cent, "user_id", "item_id", k, asked, chunk=10 ** 6)
    assert S._by_feature(cent, "user_id", "item_id", asked, k, 10 ** 6, n_all, 60, 10 ** 6) is None
    # the function itself, as its pieces are a setting of the module
    monkeypatch.setattr(S, "PRODUCTS", products)
    monkeypatch.setattr(S, "LIST_ROWS", 9)
    got = S.candidates(cent, "user_id", "item_id", k, asked, chunk=9, n_all=n_all, own_rows=60)
    assert ranks(got, k, n_all) == ranks(want, k, n_all)


def test_pieces_of_sums(monkeypatch):
    import numpy as np
    r = np.random.default_rng(2)
    at = np.r_[0, np.cumsum(r.integers(0, 9, 12))]
    starts = np.r_[0, np.cumsum(r.integers(0, 7, 5))]
    codes, values = r.integers(0, 5, at[-1]), r.normal(size=at[-1])
    partner, weight = r.integers(0, 30, starts[-1]), r.normal(size=starts[-1])
    want = {}
    for e in range(12):
        for x in range(at[e], at[e + 1]):
            for y in range(starts[codes[x]], starts[codes[x] + 1]):
                want[e, partner[y]] = want.get((e, partner[y]), 0) + values[x] * weight[y]
    for products in (1, 7, 40, 10 ** 6):
        monkeypatch.setattr(S, "PRODUCTS", products)
        got = {(p, q): s for each in S._sums_of(codes, at, values, starts, partner, weight, 30) for p, q, s in zip(*each)}
        assert got.keys() == want.keys() and all(abs(got[c] - want[c]) < 1e-12 for c in want)


def test_rows_sent_follow_the_raters(spark):
    """600 entities of 20 ratings in 60 groups that share nothing: ratings meet their group's blocks, not all."""
    df = spark.createDataFrame([(u, 1000 * (u // 10) + (u * 7 + n * 3) % 40, (u * n) % 5 + 1.0) for u in range(600) for n in range(20)],
                               "user_id long, item_id long, rating double").dropDuplicates(["user_id", "item_id"])
    cent = S.centered(df, "user_id", "item_id")
    found = S._by_feature(cent, "user_id", "item_id", None, 5, 10, 600, 1000, 10 ** 6)
    assert found is not None and found.where("b IS NOT NULL").count() > 0
    assert found.where("a div 10 <> b div 10").count() == 0
    assert S._by_feature(cent, "user_id", "item_id", None, 5, 10, 600, 1000, 100) is None
