"""Named queries for centring, similarity, top-k and neighbourhood CF (steps 3-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import evaluate, neighborhood as NB, ratings as rt, similarity as S
from tessera.plans import oracle as O
from tessera.plans.queries import _train_eval, n_distinct, register, rnd, split_ratings

USER_K = 100        # neighbours for user-user CF (reference default)
ITEM_K = 1000         # neighbours for item-item CF
SIM_K = 20          # top-k similarity report


def _train(spark, sf):
    return rt.split_part(split_ratings(spark, sf), "train")


def _prepared(spark, sf):
    s = split_ratings(spark, sf)
    train, pairs = _train_eval(spark, sf, s)
    return s, train, pairs


# ---------------------------------------------------------------- step 3 -----

O.cf_ctes("user_id", SIM_K, None, "us_")
O.cf_ctes("item_id", SIM_K, None, "is_")


@register("centered_ratings", O.with_ctes(
    "SELECT user_id, item_id, round(c, 6) AS c, round(cn, 6) AS cn FROM us_cent", "us_cent"))
def q_centered_ratings(spark, sf):
    cent = S.centered(_train(spark, sf), "user_id", "item_id")
    return cent.select("user_id", "item_id", rnd("c").alias("c"), rnd("cn").alias("cn"))


@register("user_norms", O.with_ctes(
    "SELECT user_id, n, round(mean, 6) AS mean, round(avg, 6) AS avg, round(norm, 6) AS norm "
    "FROM us_stat", "us_stat"))
def q_user_norms(spark, sf):
    st = S.entity_stats(_train(spark, sf), "user_id")
    return st.select("user_id", "n", rnd("mean").alias("mean"), rnd("avg").alias("avg"),
                     rnd("norm").alias("norm"))


def _topk_query(entity, prefix):
    def q(spark, sf):
        s, train, _ = _prepared(spark, sf)
        _, _, nb = NB.neighbours(train, entity, SIM_K, n_distinct(s, entity))
        return nb.select(F.col("a").alias(entity), F.col("b").alias("neighbor_id"),
                         rnd("sim").alias("sim"), F.col("rank").cast("bigint").alias("rank"))
    sql = O.with_ctes(f"SELECT a AS {entity}, b AS neighbor_id, round(sim, 6) AS sim, "
                      f"CAST(rank AS BIGINT) AS rank FROM {prefix}nbrs", f"{prefix}nbrs")
    return q, sql


for _e, _p, _key in (("user_id", "us_", "user_topk_sim"), ("item_id", "is_", "item_topk_sim")):
    _q, _sql = _topk_query(_e, _p)
    register(_key, _sql)(_q)


# ---------------------------------------------------------------- step 4 -----

def _cf_query(entity, k, bias):
    def q(spark, sf):
        s, train, pairs = _prepared(spark, sf)
        test = pairs.where(F.col("split") == "test").drop("split")
        pred = NB.predict(train, test, k=k, entity=entity, bias=bias,
                          n_entities=n_distinct(s, entity))
        return pred.select("user_id", "item_id", "rating", rnd("pred").alias("pred"))
    body, names = O.cf_predict_sql(entity, k, "testpairs", bias)
    return q, O.with_ctes(body, "testpairs", *names)


for _e, _k, _b, _key in (("user_id", USER_K, True, "user_cf_predict"),
                         ("user_id", USER_K, False, "user_cf_unbiased"),
                         ("item_id", ITEM_K, True, "item_cf_predict")):
    _q, _sql = _cf_query(_e, _k, _b)
    register(_key, _sql)(_q)


def _mse_sql():
    body, names = O.cf_predict_sql("user_id", USER_K, "evalpairs", True,
                                   select="q.split, q.rating", digits=None)
    return O.with_ctes(f"""
SELECT split, COUNT(*) AS n_pairs, round(AVG(POWER(pred - rating, 2)), 6) AS mse
FROM ({body}) z GROUP BY split""",
                       "evalpairs", *names)


def _item_mse_sql():
    body, names = O.cf_predict_sql("item_id", ITEM_K, "evalpairs", True,
                                   select="q.split, q.rating", digits=None)
    return O.with_ctes(f"""
SELECT split, COUNT(*) AS n_pairs, round(AVG(POWER(pred - rating, 2)), 6) AS mse
FROM ({body}) z GROUP BY split""", "evalpairs", *names)


@register("item_cf_mse", _item_mse_sql())
def q_item_cf_mse(spark, sf):
    """REC-10 / REC-12: validation and test MSE of bias-adjusted item-CF."""
    s, train, pairs = _prepared(spark, sf)
    pred = NB.predict(train, pairs, k=ITEM_K, entity="item_id",
                      n_entities=n_distinct(s, "item_id"))
    return evaluate.mse(pred, by=["split"]).select("split", "n_pairs", rnd("mse").alias("mse"))


@register("user_cf_mse", _mse_sql())
def q_user_cf_mse(spark, sf):
    """REC-11 / REC-12: validation and test MSE of bias-adjusted user-CF."""
    s, train, pairs = _prepared(spark, sf)
    pred = NB.predict(train, pairs, k=USER_K, entity="user_id",
                      n_entities=n_distinct(s, "user_id"))
    return evaluate.mse(pred, by=["split"]).select("split", "n_pairs", rnd("mse").alias("mse"))


O.cf_ctes("user_id", USER_K, None, "ua_")
O.define("ua_rec", ("ua_nbrs", "ua_cent", "ua_stat", "train"), f"""
    SELECT user_id, item_id, pred, rank FROM (
        SELECT user_id, item_id, pred,
               row_number() OVER (PARTITION BY user_id ORDER BY round(pred, 9) DESC, item_id) AS rank
        FROM (SELECT s.user_id, i.item_id, s.avg + COALESCE(x.r, 0) AS pred
              FROM ua_stat s CROSS JOIN (SELECT DISTINCT item_id FROM train) i
              LEFT JOIN (SELECT n.a AS user_id, c.item_id, SUM(n.sim * c.c) / (SUM(n.sim) + 1e-9) AS r
                    FROM ua_nbrs n JOIN ua_cent c ON c.user_id = n.b
                    WHERE NOT EXISTS (SELECT 1 FROM train t
                                      WHERE t.user_id = n.a AND t.item_id = c.item_id)
                    GROUP BY n.a, c.item_id) x ON x.user_id = s.user_id AND x.item_id = i.item_id
              WHERE NOT EXISTS (SELECT 1 FROM train t
                                WHERE t.user_id = s.user_id AND t.item_id = i.item_id)) y) z
    WHERE rank <= 10""")


@register("user_cf_recommend", O.with_ctes(
    "SELECT user_id, item_id, round(pred, 6) AS pred, rank FROM ua_rec", "ua_rec"))
def q_user_cf_recommend(spark, sf):
    """REC-22: top-10 unrated items for every user with a train rating."""
    s, train, _ = _prepared(spark, sf)
    rec = NB.recommend(train, train.select("user_id"), k=USER_K, n=10,
                       n_entities=n_distinct(s, "user_id"))
    return rec.select("user_id", "item_id", rnd("pred").alias("pred"), "rank")
