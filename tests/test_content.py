import numpy as np

from tessera.operators import content as CB
from tessera.sources.bindings import NO_GENRES

CATALOG = [(1, "a", "Action|Comedy"), (2, "b", "Drama"), (3, "c", NO_GENRES),
           (4, "d", "Action|Drama"), (2, "b2", "Drama")]          # duplicate id 2
TRAIN = [(1, 1, 5.0), (1, 2, 2.0), (2, 2, 4.0), (2, 4, 1.0), (1, 3, 3.0)]
TEST = [(1, 4, 3.0), (2, 1, 2.0)]


def test_profiles_and_prediction(spark):
    cat = spark.createDataFrame(CATALOG, "item_id long, title string, genres string")
    tr = spark.createDataFrame(TRAIN, "user_id long, item_id long, rating double")
    te = spark.createDataFrame(TEST, "user_id long, item_id long, rating double")
    assert CB.usable_catalog(cat).count() == 3
    assert [r.item_id for r in CB.unknown_items(tr, cat).collect()] == [3]
    assert CB.duplicate_items(cat).first().item_id == 2
    assert CB.unknown_genres(cat, CB.MOVIE_GENRES).count() == 0
    known = CB.rated_known_items(tr, cat)
    ip = CB.item_profile(cat)
    got = {(r.user_id, r.item_id): r.pred for r in CB.predict(known, te, ip).collect()}
    genres = ["Action", "Comedy", "Drama"]
    prof = {1: {"Action", "Comedy"}, 2: {"Drama"}, 4: {"Action", "Drama"}}
    for u, i, _ in TEST:
        mine = [(it, r) for uu, it, r in TRAIN if uu == u and it in prof]
        avg = sum(r for _, r in mine) / (len(mine) + 1e-9)
        w = np.array([sum(r - avg for it, r in mine if g in prof[it])
                      / (sum(1 for it, r in mine if g in prof[it] and r - avg != 0) + 1e-9)
                      for g in genres])
        x = np.array([1.0 if g in prof[i] else 0.0 for g in genres])
        cos = w @ x / (np.linalg.norm(w) * np.linalg.norm(x)) if np.linalg.norm(w) > 0 else 0
        assert abs(got[(u, i)] - (avg + cos)) < 1e-9
