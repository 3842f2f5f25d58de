import numpy as np

from tessera.operators import baselines as BL

EPS = 1e-9
TRAIN = [(1, 1, 4.0), (1, 2, 2.0), (2, 1, 5.0), (2, 3, 3.0), (3, 2, 1.0)]
PAIRS = [(1, 3, 3.0), (2, 2, 4.0), (9, 1, 2.0), (3, 9, 5.0)]   # user 9 / item 9 unseen


def _run(spark, fn):
    tr = spark.createDataFrame(TRAIN, "user_id long, item_id long, rating double")
    pr = spark.createDataFrame(PAIRS, "user_id long, item_id long, rating double")
    return {(r.user_id, r.item_id): r.pred for r in fn(tr, pr).collect()}


def test_baselines_match_dense_formulas(spark):
    users, items = sorted({u for u, _, _ in TRAIN}), sorted({i for _, i, _ in TRAIN})
    M = np.zeros((10, 10))
    for u, i, r in TRAIN:
        M[u, i] = r
    g = M.sum() / np.count_nonzero(M)
    ua = M.sum(1) / (np.count_nonzero(M, 1) + EPS)
    ia = M.sum(0) / (np.count_nonzero(M, 0) + EPS)
    assert users and items
    got = {m: _run(spark, BL.BASELINES[m]) for m in BL.BASELINES}
    for u, i, _ in PAIRS:
        assert abs(got["global"][(u, i)] - g) < 1e-12
        assert abs(got["user"][(u, i)] - ua[u]) < 1e-9          # unseen user -> 0
        assert abs(got["item"][(u, i)] - ia[i]) < 1e-9          # unseen item -> 0
        assert abs(got["bias"][(u, i)] - (g + (ua[u] - g) + (ia[i] - g))) < 1e-9
    assert got["user"][(9, 1)] == 0.0
    assert got["item"][(3, 9)] == 0.0
