"""Split with exact sizes: borders found by histograms equal those of a sort."""
import hashlib
import random

import pytest

from tessera.operators import ratings as rt


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 403])
def test_equals_sort(spark, n):
    r = random.Random(n)
    pairs = r.sample([(u, i) for u in range(60) for i in range(40)], n)
    df = spark.createDataFrame([(u, i, 3.0, "x") for u, i in pairs], "user_id long, item_id long, rating double, note string")
    got = rt.exact_split(df.repartition(3))
    assert got.columns == ["user_id", "item_id", "rating", "note", "split"]
    order = sorted(pairs, key=lambda p: (int(hashlib.md5(f"{p[0]}_{p[1]}_1".encode()).hexdigest()[:8], 16), p))
    n_train = round(0.8 * n)
    n_valid = round(0.5 * (n - n_train))
    want = {p: "train" if k < n_train else "valid" if k < n_train + n_valid else "test" for k, p in enumerate(order)}
    assert {(x.user_id, x.item_id): x.split for x in got.collect()} == want


def test_ranks_with_ties(spark):
    r = random.Random(1)
    keys = [r.choice([0, 1, 5, 70000, 2 ** 32 - 1, r.getrandbits(32)]) for _ in range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    keys.sort()
    ranks = [0, 3, 250, 499]
    got = rt.keys_at_ranks(df, "k", ranks, digit=5)
    assert got == [(keys[x], x - keys.index(keys[x])) for x in ranks]
