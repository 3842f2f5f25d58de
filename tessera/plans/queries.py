"""Named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the scale-factor tables (or data Spark derives from them)
in full.  Floating outputs are rounded to ``ROUND`` digits in this reporting
layer only, so results compare across engines; the operators themselves
return full precision.  ``ORACLE`` holds the DuckDB SQL for each key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import baselines, evaluate, ratings as rt
from tessera.plans import oracle as O
from tessera.session import written
from tessera.sources import bindings as B

ROUND = O.ROUND

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rnd(c, digits: int = ROUND):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def split_ratings(spark: SparkSession, sf: str) -> DataFrame:
    """The split ratings every model of a query reads several times: derived
    once (join, dedupe, split) and written."""
    return written(rt.with_split(B.ratings(spark, sf)), "split-ratings")


def _train_eval(spark: SparkSession, sf: str, s: DataFrame | None = None):
    s = split_ratings(spark, sf) if s is None else s
    train = rt.split_part(s, "train")
    pairs = s.where(F.col("split") != "train").drop("bucket")
    return train, pairs


def n_distinct(s: DataFrame, col: str):
    """Scalar subquery: distinct ``col`` values over all splits."""
    return s.select(F.countDistinct(col)).scalar()


# ---------------------------------------------------------------- step 0 -----

@register("baseline_user_avg_mse", O.with_ctes("""
SELECT p.split, COUNT(*) AS n_pairs, round(AVG(POWER(COALESCE(ua.user_avg, 0) - p.rating, 2)), 6) AS mse
FROM evalpairs p LEFT JOIN user_avg ua ON p.user_id = ua.user_id
GROUP BY p.split""", "evalpairs", "user_avg"))
def q_baseline_user_avg_mse(spark, sf):
    train, pairs = _train_eval(spark, sf)
    pred = baselines.predict_user_average(train, pairs)
    return evaluate.mse(pred, by=["split"]).select("split", "n_pairs", rnd("mse").alias("mse"))


# ---------------------------------------------------------------- step 1 -----

@register("dataset_stats", O.with_ctes("""
SELECT split, COUNT(DISTINCT user_id) AS n_users, COUNT(DISTINCT item_id) AS n_items,
       COUNT(*) AS n_ratings FROM split GROUP BY split
UNION ALL
SELECT 'all', COUNT(DISTINCT user_id), COUNT(DISTINCT item_id), COUNT(*) FROM split""", "split"))
def q_dataset_stats(spark, sf):
    return rt.dataset_stats(split_ratings(spark, sf))


@register("split_counts", O.with_ctes("""
SELECT split, COUNT(*) AS n_ratings, round(AVG(rating), 6) AS avg_rating,
       MIN(rating) AS min_rating, MAX(rating) AS max_rating
FROM split GROUP BY split""", "split"))
def q_split_counts(spark, sf):
    return (split_ratings(spark, sf).groupBy("split")
            .agg(F.count(F.lit(1)).alias("n_ratings"), rnd(F.avg("rating")).alias("avg_rating"),
                 F.min("rating").alias("min_rating"), F.max("rating").alias("max_rating")))


@register("split_exact", O.with_ctes(f"""
SELECT user_id, item_id, rating, CASE WHEN r <= n_train THEN 'train'
       WHEN r <= n_train + round_even((n - n_train) * 0.5, 0) THEN 'valid' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY {O.md5_int("concat(user_id, '_', item_id, '_1')")}, user_id, item_id) AS r,
             count(*) OVER () AS n, round_even(count(*) OVER () * 0.8, 0) AS n_train FROM ratings) t""", "ratings"))
def q_split_exact(spark, sf):
    """SPL-1: every rating's part, 80 / 10 / 10 with sizes exact to a row."""
    return rt.exact_split(B.ratings(spark, sf)).select("user_id", "item_id", "rating", "split")


@register("split_overlap", O.with_ctes("""
SELECT (SELECT COUNT(*) FROM (SELECT user_id, item_id FROM split WHERE split = 'train'
                              INTERSECT SELECT user_id, item_id FROM split WHERE split = 'test') x) AS n_overlap,
       (SELECT COUNT(*) FROM (SELECT user_id, item_id FROM ratings
                              EXCEPT SELECT user_id, item_id FROM split WHERE split = 'train') y) AS n_rest""",
                                       "split"))
def q_split_overlap(spark, sf):
    """SET-4 / SET-5 / JN-2: train and test are disjoint; rest = all minus train."""
    s = split_ratings(spark, sf)
    keys = ["user_id", "item_id"]
    tr = s.where(F.col("split") == "train").select(*keys)
    te = s.where(F.col("split") == "test").select(*keys)
    overlap = tr.intersect(te).agg(F.count(F.lit(1)).alias("n_overlap"))
    rest = (s.select(*keys).join(tr, keys, "left_anti")
            .agg(F.count(F.lit(1)).alias("n_rest")))
    return overlap.select(F.col("n_overlap"), rest.scalar().alias("n_rest"))


@register("leave_n_out", O.with_ctes(f"""
SELECT user_id, item_id, rating, CASE WHEN rn <= 10 THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                  ORDER BY {O.md5_int("concat(user_id, '_', item_id, '_1')")}, item_id) AS rn,
             COUNT(*) OVER (PARTITION BY user_id) AS n
      FROM ratings) t
WHERE n >= 10""", "ratings"))
def q_leave_n_out(spark, sf):
    return rt.leave_n_out(B.ratings(spark, sf), n=10, seed=1)


@register("item_index", O.with_ctes("""
SELECT item_id, first_user, row_number() OVER (ORDER BY first_user, item_id) - 1 AS item_ix
FROM (SELECT item_id, MIN(user_id) AS first_user FROM ratings GROUP BY item_id) t""", "ratings"))
def q_item_index(spark, sf):
    return rt.item_index(B.ratings(spark, sf))


@register("ratings_dedupe", """
SELECT o_custkey AS user_id, l_partkey AS item_id,
       SUM(CAST(ceil(l_quantity / 5) AS DOUBLE) / 2) AS rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_custkey, l_partkey""")
def q_ratings_dedupe(spark, sf):
    """AGG-17 with the sparse-matrix convention: duplicate cells are summed."""
    return rt.dedupe_ratings(B.raw_ratings(spark, sf), "sum")


# ---------------------------------------------------------------- step 2 -----

def _baseline_query(method: str):
    def q(spark, sf):
        train, pairs = _train_eval(spark, sf)
        test = pairs.where(F.col("split") == "test").drop("split")
        pred = baselines.BASELINES[method](train, test)
        return pred.select("user_id", "item_id", "rating", rnd("pred").alias("pred"))
    expr, deps = O.baseline_pred_sql(method)
    sql = O.with_ctes(f"SELECT p.user_id, p.item_id, p.rating, {O.r(expr)} AS pred\n"
                      f"FROM {O.baseline_join('testpairs')}",
                      "testpairs", "user_avg", "item_avg", *deps)
    return q, sql


for _m, _key in (("global", "baseline_global_avg"), ("item", "baseline_item_avg"),
                 ("bias", "baseline_bias")):
    _q, _sql = _baseline_query(_m)
    register(_key, _sql)(_q)


def _mse_all_sql() -> str:
    parts = []
    for m in ("global", "user", "item", "bias"):
        expr, _ = O.baseline_pred_sql(m)
        parts.append(f"SELECT '{m}' AS method, p.split, COUNT(*) AS n_pairs, "
                     f"round(AVG(POWER({expr} - p.rating, 2)), 6) AS mse "
                     f"FROM {O.baseline_join('evalpairs')} GROUP BY p.split")
    return O.with_ctes("\nUNION ALL\n".join(parts), "evalpairs", "user_avg", "item_avg",
                       "global_avg")


@register("baseline_mse_all", _mse_all_sql())
def q_baseline_mse_all(spark, sf):
    train, pairs = _train_eval(spark, sf)
    out = None
    for m, fn in baselines.BASELINES.items():
        e = evaluate.mse(fn(train, pairs), by=["split"]).select(
            F.lit(m).alias("method"), "split", "n_pairs", rnd("mse").alias("mse"))
        out = e if out is None else out.unionByName(e)
    return out
