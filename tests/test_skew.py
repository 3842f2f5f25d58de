"""Hot-key path: one item rated by every user, split into many 2-D salts."""
from pyspark.sql import functions as F

from conftest import SF001
from tessera.operators import ratings as rt, similarity as S
from tessera.sources import bindings as B


def test_hot_item_salting_equals_plain(spark):
    train = rt.split_part(rt.with_split(B.ratings(spark, SF001)), "train")
    users = train.select("user_id").distinct()
    hot = users.select("user_id", F.lit(-1).cast("long").alias("item_id"),
                       (F.pmod(F.col("user_id"), F.lit(9)) / 2 + 0.5).alias("rating"))
    skewed = train.unionByName(hot)                # item -1 carries every user
    cent = S.centered(skewed, "user_id", "item_id")
    deg = cent.where("item_id = -1").count()
    assert deg > 100
    plain = {(r.a, r.b): r.sim for r in S.similarities(cent, "user_id", "item_id").collect()}
    salted_df = S.similarities(cent, "user_id", "item_id", chunk=10)   # ~15 salts per side
    salted = {(r.a, r.b): r.sim for r in salted_df.collect()}
    assert plain.keys() == salted.keys()
    assert max(abs(plain[k] - salted[k]) for k in plain) < 1e-12
    top_plain = S.top_k(S.similarities(cent, "user_id", "item_id"), 20, 200).collect()
    top_salted = S.top_k(salted_df, 20, 200).collect()
    assert sorted((r.a, r.b, r.rank) for r in top_plain) == \
        sorted((r.a, r.b, r.rank) for r in top_salted)
