"""User/item CF against a dense numpy brute force."""
import numpy as np
import pytest

from tessera.operators import neighborhood as NB, similarity as S

EPS = 1e-9
# user 5 is a constant rater (Q4), users 1 and 2 have identical vectors,
# user 8 is only in the pair list (unseen, Q1)
TRAIN = [
    (1, 1, 5.0), (1, 2, 3.0), (1, 3, 1.0), (1, 5, 2.0),
    (2, 1, 5.0), (2, 2, 3.0), (2, 3, 1.0), (2, 5, 2.0),
    (3, 1, 1.0), (3, 2, 4.5), (3, 4, 5.0), (3, 6, 2.0),
    (4, 2, 2.0), (4, 3, 5.0), (4, 4, 1.5), (4, 6, 4.0),
    (5, 1, 3.0), (5, 4, 3.0), (5, 6, 3.0),
    (6, 1, 2.0), (6, 3, 4.0), (6, 5, 5.0), (6, 6, 1.0),
    (7, 2, 5.0), (7, 4, 0.5), (7, 5, 3.5),
]
PAIRS = [(1, 4, 4.0), (1, 6, 2.0), (3, 3, 3.0), (5, 2, 4.0), (6, 2, 1.0), (7, 1, 2.0),
         (8, 2, 3.0), (4, 5, 2.5)]
ALL_USERS = 8


def dense_predict(train, pairs, k, n_all, entity="user"):
    trip = [(u, i, r) if entity == "user" else (i, u, r) for u, i, r in train]
    ents = sorted({a for a, _, _ in trip} | set(range(1, n_all + 1)))
    feats = sorted({f for _, f, _ in trip} | {p[1] if entity == "user" else p[0] for p in pairs})
    ei, fi = {e: n for n, e in enumerate(ents)}, {f: n for n, f in enumerate(feats)}
    R = np.zeros((len(ents), len(feats)))
    for a, f, r in trip:
        R[ei[a], fi[f]] = r
    mask = R != 0
    n = mask.sum(1)
    mean = np.where(n > 0, R.sum(1) / np.maximum(n, 1), 0.0)
    avg = R.sum(1) / (n + EPS)
    C = (R - mean[:, None]) * mask
    norm = np.sqrt((C * C).sum(1))
    Cn = C / (norm[:, None] + EPS)
    sim = Cn @ Cn.T
    out = {}
    for (u, i, _) in pairs:
        a, f = (u, i) if entity == "user" else (i, u)
        if a not in ei or f not in fi:
            out[(u, i)] = 0.0 if a not in ei else avg[ei[a]]
            continue
        x = ei[a]
        cand = [y for y in range(len(ents)) if y != x]
        cls = lambda y: 0 if sim[x, y] > 0 else (1 if sim[x, y] == 0 else 2)
        cand.sort(key=lambda y: (cls(y), -round(sim[x, y], 9), ents[y]))
        top = cand[:k]
        num = sum(sim[x, y] * C[y, fi[f]] for y in top if C[y, fi[f]] != 0)
        den = sum(sim[x, y] for y in top if C[y, fi[f]] != 0)
        out[(u, i)] = avg[x] + num / (den + EPS)
    return out


def _df(spark, data):
    return spark.createDataFrame(data, "user_id long, item_id long, rating double")


@pytest.mark.parametrize("k", [1, 2, 4, 6])
def test_user_cf_matches_dense(spark, k):
    got = NB.predict(_df(spark, TRAIN), _df(spark, PAIRS), k=k, n_entities=ALL_USERS)
    got = {(r.user_id, r.item_id): r.pred for r in got.collect()}
    want = dense_predict(TRAIN, PAIRS, k, ALL_USERS)
    assert set(got) == set(want)
    for key, v in want.items():
        assert abs(got[key] - v) < 1e-6, (k, key, got[key], v)
    assert got[(8, 2)] == 0.0                      # unseen user predicts 0


@pytest.mark.parametrize("k", [2, 5])
def test_item_cf_matches_dense(spark, k):
    n_items = 6
    got = NB.predict(_df(spark, TRAIN), _df(spark, PAIRS), k=k, entity="item_id",
                     n_entities=n_items)
    got = {(r.user_id, r.item_id): r.pred for r in got.collect()}
    want = dense_predict(TRAIN, PAIRS, k, n_items, entity="item")
    for key, v in want.items():
        assert abs(got[key] - v) < 1e-6, (k, key, got[key], v)


def test_negative_neighbours_enter_only_through_free_slots(spark):
    cent = S.centered(_df(spark, TRAIN), "user_id", "item_id")
    sims = S.similarities(cent, "user_id", "item_id")
    nb = S.top_k(sims, 6, ALL_USERS)
    neg = nb.where("sim < 0").count()
    assert neg > 0                                 # k close to n: negatives get slots
    assert nb.where("rank > 6").count() == 0
    assert nb.where("a = b").count() == 0          # self never a neighbour (Q2)
    assert cent.where("user_id = 5").count() == 0  # constant rater centres to 0 (Q4)


def test_salted_self_join_equals_plain(spark):
    cent = S.centered(_df(spark, TRAIN), "user_id", "item_id")
    plain = {(r.a, r.b): r.sim for r in S.similarities(cent, "user_id", "item_id").collect()}
    salted = {(r.a, r.b): r.sim
              for r in S.similarities(cent, "user_id", "item_id", chunk=2).collect()}
    assert plain.keys() == salted.keys()
    for key in plain:
        assert abs(plain[key] - salted[key]) < 1e-12
    assert all(abs(v) <= 1 + 1e-9 for v in plain.values())


def test_unbiased_cf_no_neighbour_is_zero(spark):
    got = NB.predict(_df(spark, TRAIN), _df(spark, [(8, 2, 3.0)]), k=3, bias=False,
                     n_entities=ALL_USERS)
    assert got.first().pred == 0.0


def test_recommend_excludes_rated_items(spark):
    tr = _df(spark, TRAIN)
    rec = NB.recommend(tr, tr.select("user_id"), k=3, n=2, n_entities=ALL_USERS)
    rated = {(u, i) for u, i, _ in TRAIN}
    out = rec.collect()
    assert out and all((r.user_id, r.item_id) not in rated for r in out)
    assert max(r.rank for r in out) <= 2


def test_recommend_covers_items_no_neighbour_rated(spark):
    tr = _df(spark, TRAIN)
    items = _df(spark, TRAIN + [(1, 900, 1.0), (1, 901, 1.0)]).select("item_id")
    rec = NB.recommend(tr, tr.select("user_id"), k=3, n=50, n_entities=ALL_USERS, items=items).collect()
    rated = {(u, i) for u, i, _ in TRAIN}
    every = {(u, i) for u, _, _ in TRAIN for i in [i for _, i, _ in TRAIN] + [900, 901]} - rated
    assert {(r.user_id, r.item_id) for r in rec} == every and len(rec) == len(every)
    few = NB.recommend(tr, tr.select("user_id"), k=3, n=2, n_entities=ALL_USERS, items=items).collect()
    assert {(r.user_id, r.item_id, r.rank) for r in few} == {(r.user_id, r.item_id, r.rank) for r in rec if r.rank <= 2}


def test_pair_join_runs_once(spark):
    tr = _df(spark, TRAIN)
    _, _, nb = NB.neighbours(tr, "user_id", 3, ALL_USERS)
    assert nb._jdf.queryExecution().executedPlan().toString().count("cn_a") == 0
