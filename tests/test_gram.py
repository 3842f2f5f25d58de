"""Blocked Gram product: blocks, feature parts and map-side limits give the rows of a plain self-join."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import neighborhood as NB, similarity as S


def ratings(seed=3, users=90, items=40):
    r = random.Random(seed)
    rows = {(u, i): r.randint(1, 10) / 2 for u in range(users) for i in r.sample(range(items), r.randint(1, 12))}
    rows |= {(u, 900): r.randint(1, 10) / 2 for u in range(users)}         # an item of every user
    rows |= {(700, i): r.randint(1, 10) / 2 for i in range(items)}         # a user of every item
    return [(u, i, x) for (u, i), x in rows.items()]


def plain(cent):
    by = {}
    for r in cent.collect():
        by.setdefault(r.item_id, []).append((r.user_id, r.cn))
    out = {}
    for rows in by.values():
        for a, x in rows:
            for b, y in rows:
                if a != b:
                    out[a, b] = out.get((a, b), 0.0) + x * y
    return out


@pytest.fixture(scope="module")
def cent(spark):
    df = spark.createDataFrame(ratings(), "user_id long, item_id long, rating double")
    return S.centered(df, "user_id", "item_id")


@pytest.mark.parametrize("block,task_rows", [(2048, 10 ** 6), (7, 10 ** 6), (20, 30), (2048, 50)])
def test_sums_equal_plain_self_join(cent, block, task_rows):
    want = plain(cent)
    got = S.similarities(cent, "user_id", "item_id", chunk=block, task_rows=task_rows).collect()
    assert len(got) == len(want)
    assert {(r.a, r.b) for r in got} == set(want)
    assert max(abs(r.sim - want[r.a, r.b]) for r in got) < 1e-12


@pytest.mark.parametrize("block,task_rows", [(2048, 10 ** 6), (9, 10 ** 6), (20, 30)])
@pytest.mark.parametrize("k", [1, 5, 200])
def test_candidates_give_the_same_neighbours(cent, k, block, task_rows):
    asked = cent.select("user_id").distinct().where("user_id % 3 <> 1")
    sims = S.similarities(cent, "user_id", "item_id", asked)

    def ranks(nearest):  # sums that cancel are 0 or not by the order of adding
        return sorted((r.a, r.b, r.rank) for r in nearest.where("abs(sim) > 1e-9").collect())
    want = ranks(S.top_k(sims, k, 120))
    found = S.candidates(cent, "user_id", "item_id", k, asked, block, task_rows)
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("_nco"))
    got = S.top_k(found.where("b IS NOT NULL").drop("n"), k, 120, counts)
    assert ranks(got) == want


def test_products_in_pieces(monkeypatch):
    r = np.random.default_rng(1)
    f = np.sort(r.integers(0, 9, 200))
    side = f, r.integers(0, 12, 200), r.normal(size=200)
    whole = S._products(side, side, 9, (12, 12), False)
    monkeypatch.setattr(S, "PRODUCTS", 50)
    pieces = S._products(side, side, 9, (12, 12), False)
    assert np.allclose(whole[0], pieces[0]) and (whole[1] == pieces[1]).all()


def test_rows_shuffled_follow_the_ratings(cent):
    """Each rating goes to every block once, also those of the item all users rated."""
    groups, parts, _ = S._dealt(cent, "user_id", "item_id", None, 30, 10 ** 6)
    blocks = max(1, -(-cent.select("user_id").distinct().count() // 30))
    sent = groups.count().agg(F.sum("count")).collect()[0][0]
    assert parts == 1 and sent in [cent.count() * n for n in (blocks - 1, blocks, blocks + 1)]


def test_predictions_do_not_depend_on_the_side_expanded(spark):
    """k below and above the raters of an item: both orders of the joins, one result."""
    rows = ratings(5)
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    pairs = df.where("(user_id + item_id) % 4 = 0")
    train = df.subtract(pairs)
    for k in (3, 25):
        got = {(r.user_id, r.item_id): r.pred for r in NB.predict(train, pairs, k=k).collect()}
        cent, st, nb = NB.neighbours(train, "user_id", k, train.select("user_id").distinct().count(), targets=pairs.select("user_id"))
        slow = (pairs.join(nb.select(F.col("a").alias("user_id"), "b", "sim"), "user_id")
                .join(cent.select(F.col("user_id").alias("b"), "item_id", "c"), ["b", "item_id"])
                .groupBy("user_id", "item_id").agg((F.sum(F.expr("sim * c")) / (F.sum("sim") + F.lit(S.EPS))).alias("x")))
        slow = {(r.user_id, r.item_id): r.x for r in slow.collect()}
        avg = {r.user_id: r.avg for r in st.collect()}
        assert len(slow) > 20
        assert all(abs(p - avg.get(u, 0.0) - slow.get((u, i), 0.0)) < 1e-9 for (u, i), p in got.items())
