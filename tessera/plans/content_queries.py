"""Named queries for content-based recommendation (step 5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import content as CB, evaluate, ratings as rt
from tessera.plans import oracle as O
from tessera.plans.queries import register, rnd
from tessera.session import cut_lineage
from tessera.sources import bindings as B

HOLD_OUT = 10

O.define("catalog", (), """
    SELECT p_partkey AS item_id, p_name AS title,
           CASE WHEN p_partkey % 50 = 0 THEN '(no genres listed)'
                ELSE concat(p_type, '|', replace(p_name, ' ', '|')) END AS genres
    FROM part""")
O.define("cat_ok", ("catalog",), """
    SELECT item_id, min({'title': title, 'genres': genres}).genres AS genres
    FROM catalog WHERE genres <> '(no genres listed)' GROUP BY item_id""")
O.define("iprof", ("cat_ok",), """
    SELECT DISTINCT item_id, genre FROM (
        SELECT item_id, unnest(string_split(genres, '|')) AS genre FROM cat_ok) t""")
O.define("cr", ("ratings", "cat_ok"), """
    SELECT * FROM ratings WHERE item_id IN (SELECT item_id FROM cat_ok)""")
O.define("clno", ("cr",), f"""
    SELECT user_id, item_id, rating, CASE WHEN rn <= {HOLD_OUT} THEN 'test' ELSE 'train' END AS split
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                  ORDER BY {O.md5_int("concat(user_id, '_', item_id, '_1')")}, item_id) AS rn,
                 COUNT(*) OVER (PARTITION BY user_id) AS n
          FROM cr) t
    WHERE n >= {HOLD_OUT}""")
O.define("ctrain", ("clno",), "SELECT user_id, item_id, rating FROM clno WHERE split = 'train'")
O.define("ctest", ("clno",), "SELECT user_id, item_id, rating FROM clno WHERE split = 'test'")
O.define("cavg", ("ctrain",), """
    SELECT user_id, SUM(rating) / (COUNT(*) + 1e-9) AS avg FROM ctrain GROUP BY user_id""")
O.define("uprof", ("ctrain", "cavg", "iprof"), """
    SELECT c.user_id, ip.genre,
           SUM(c.c) / (COUNT(*) FILTER (WHERE c.c <> 0) + 1e-9) AS weight
    FROM (SELECT t.user_id, t.item_id, t.rating - a.avg AS c
          FROM ctrain t JOIN cavg a ON t.user_id = a.user_id) c
    JOIN iprof ip ON ip.item_id = c.item_id
    GROUP BY c.user_id, ip.genre""")
O.define("cpred", ("ctest", "iprof", "uprof", "cavg"), """
    SELECT t.user_id, t.item_id, t.rating,
           COALESCE(a.avg, 0) + CASE WHEN un.n > 0 AND inn.n > 0
                                     THEN COALESCE(d.dot, 0) / (un.n * inn.n) ELSE 0 END AS pred
    FROM ctest t
    LEFT JOIN (SELECT k.user_id, k.item_id, SUM(p.weight) AS dot
               FROM (SELECT DISTINCT user_id, item_id FROM ctest) k
               JOIN iprof ip ON ip.item_id = k.item_id
               JOIN uprof p ON p.user_id = k.user_id AND p.genre = ip.genre
               GROUP BY k.user_id, k.item_id) d ON d.user_id = t.user_id AND d.item_id = t.item_id
    LEFT JOIN cavg a ON a.user_id = t.user_id
    LEFT JOIN (SELECT user_id, sqrt(SUM(weight * weight)) AS n FROM uprof GROUP BY user_id) un
           ON un.user_id = t.user_id
    LEFT JOIN (SELECT item_id, sqrt(COUNT(*)) AS n FROM iprof GROUP BY item_id) inn
           ON inn.item_id = t.item_id""")


def _content_split(spark, sf):
    cat = B.catalog(spark, sf)
    known = CB.rated_known_items(B.ratings(spark, sf), cat)
    lno = cut_lineage(rt.leave_n_out(known, n=HOLD_OUT, seed=1))
    train = lno.where(F.col("split") == "train").drop("split")
    test = lno.where(F.col("split") == "test").drop("split")
    return cat, train, test


@register("item_profile", O.with_ctes("SELECT item_id, genre FROM iprof", "iprof"))
def q_item_profile(spark, sf):
    return CB.item_profile(B.catalog(spark, sf))


@register("user_profile", O.with_ctes(
    "SELECT user_id, genre, round(weight, 6) AS weight FROM uprof", "uprof"))
def q_user_profile(spark, sf):
    cat, train, _ = _content_split(spark, sf)
    up = CB.user_profile(train, CB.item_profile(cat))
    return up.select("user_id", "genre", rnd("weight").alias("weight"))


@register("content_predict", O.with_ctes(
    "SELECT user_id, item_id, rating, round(pred, 6) AS pred FROM cpred", "cpred"))
def q_content_predict(spark, sf):
    cat, train, test = _content_split(spark, sf)
    pred = CB.predict(train, test, CB.item_profile(cat))
    return pred.select("user_id", "item_id", "rating", rnd("pred").alias("pred"))


@register("content_mse", O.with_ctes(
    "SELECT COUNT(*) AS n_pairs, round(AVG(POWER(pred - rating, 2)), 6) AS mse FROM cpred",
    "cpred"))
def q_content_mse(spark, sf):
    cat, train, test = _content_split(spark, sf)
    pred = CB.predict(train, test, CB.item_profile(cat))
    return evaluate.mse(pred).select("n_pairs", rnd("mse").alias("mse"))


@register("unknown_items", O.with_ctes(
    "SELECT user_id, item_id, rating FROM ratings WHERE item_id NOT IN (SELECT item_id FROM cat_ok)",
    "ratings", "cat_ok"))
def q_unknown_items(spark, sf):
    return CB.unknown_items(B.ratings(spark, sf), B.catalog(spark, sf)).select(
        "user_id", "item_id", "rating")
