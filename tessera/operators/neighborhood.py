"""Neighbourhood collaborative filtering (REC-7, REC-8, REC-10, REC-22).

The prediction is restricted to the requested target pairs *before* anything
is expanded.  A target meets the raters of its feature, which then join its
entity's top-k neighbours, where the feature has at most k raters; else it meets
the k neighbours, which join the feature's raters.  Either way a target
expands to at most k rows.  Where neighbours are found by feature
(``similarity.predicted``, ``similarity.best``) a target's neighbours are met in the task
that ranks them, and only sums or finished lists leave it.

User-user (``entity='user_id'``) and item-item (``entity='item_id'``) are
the same plan with the roles of the two id columns swapped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators import similarity as S
from tessera.operators.ratings import dense_index
from tessera.plans.sizing import broadcast_if_small
from tessera.session import cut_lineage, written

EPS = S.EPS


def _other(entity: str) -> str:
    return "item_id" if entity == "user_id" else "user_id"


def neighbours(train: DataFrame, entity: str, k: int, n_entities,
               targets: DataFrame | None = None, chunk: int = S.BLOCK,
               stats: DataFrame | None = None):
    """(centred ratings, stats, top-k neighbours ``(a, b, sim, rank)``).

    The centred table and the neighbours, or the candidate pairs where tasks cannot rank
    them, are written once as tables in the shared folder: the upstream derivation and the
    pair sums run once, and a lost executor reads the files again.
    """
    st = stats if stats is not None else S.entity_stats(train, entity)
    cent, n_all = _centred(train, entity, n_entities, st)
    return cent, st, _ranked(cent, entity, k, n_entities, n_all, targets, chunk)


def _centred(train: DataFrame, entity: str, n_entities, st: DataFrame):
    """(centred ratings, written; the number of entities that are ranked)."""
    cent = written(S.centered(train, entity, _other(entity), st), "cf-centred")
    return cent, n_entities if isinstance(n_entities, int) else train.sparkSession.range(1).select(n_entities).head()[0]


def _ranked(cent: DataFrame, entity: str, k: int, n_entities, n_all: int, targets: DataFrame | None, chunk: int) -> DataFrame:
    """Top-k neighbours ``(a, b, sim, rank)``."""
    feature = _other(entity)
    near = S.nearest(cent, entity, feature, k, n_all, targets, chunk)
    if near is not None:
        return near
    found = written(S.candidates(cent, entity, feature, k, targets, chunk, n_all=n_all, by_feature=False), "cf-pairs")
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("_nco"))
    return S.top_k(found.where("b IS NOT NULL").drop("n"), k, n_entities, counts)


def _met(pairs: DataFrame, nb: DataFrame, vals: DataFrame, entity: str, feature: str, k: int) -> DataFrame:
    """(entity, feature, sim, v) for each pair and neighbour that rated the feature."""
    near = nb.select(F.col("a").alias(entity), "b", "sim")
    raters = vals.groupBy(feature).agg(F.count(F.lit(1)).alias("_raters"))
    sized = pairs.join(raters, feature)
    few = sized.where(F.col("_raters") <= k).drop("_raters").join(vals, feature).join(near, [entity, "b"])
    many = sized.where(F.col("_raters") > k).drop("_raters").join(near, entity).join(vals, ["b", feature])
    cols = [entity, feature, "sim", "v"]
    return few.select(*cols).unionByName(many.select(*cols))


def predict(train: DataFrame, targets: DataFrame, k: int = 100,
            entity: str = "user_id", n_entities=None, bias: bool = True,
            chunk: int = S.BLOCK) -> DataFrame:
    """Predict ``pred`` for every row of ``targets`` (user_id, item_id, ...).

    bias=True (REC-8 / REC-10):
        pred = A + sum s*c / (sum_{c != 0} s + EPS), A = the entity's EPS-average
        (0 for an entity unseen in train); no rated neighbour gives A.
    bias=False (REC-7):
        pred = sum s*r / (sum_{rated} s + EPS); no rated neighbour gives 0.
    The normaliser is the signed sum of similarities, as in the reference.
    ``n_entities`` defaults to the distinct entities of ``train``; pass the
    count over all ratings to rank against the full matrix.
    """
    feature = _other(entity)
    if n_entities is None:
        n_entities = train.select(F.countDistinct(entity)).scalar()
    tkeys = targets.select("user_id", "item_id").distinct()
    st = S.entity_stats(train, entity)
    cent, n_all = _centred(train, entity, n_entities, st)
    if bias:
        vals = cent.select(F.col(entity).alias("b"), feature, F.col("c").alias("v"))
    else:
        vals = train.select(F.col(entity).alias("b"), feature, F.col("rating").alias("v"))
    contrib = S.predicted(cent, vals.withColumnRenamed("b", entity), tkeys, entity, feature, k, n_all, chunk)
    if contrib is None:
        nb = _ranked(cent, entity, k, n_entities, n_all, tkeys.select(entity), chunk)
        contrib = (_met(tkeys, nb, vals, entity, feature, k)
                   .groupBy("user_id", "item_id")
                   .agg(F.sum(F.col("sim") * F.col("v")).alias("_num"),
                        F.sum("sim").alias("_den")))
    out = targets.join(contrib, ["user_id", "item_id"], "left")
    ratio = F.coalesce("_num", F.lit(0.0)) / (F.coalesce("_den", F.lit(0.0)) + F.lit(EPS))
    if bias:
        out = out.join(broadcast_if_small(st.select(entity, F.col("avg").alias("_avg"))),
                       entity, "left")
        pred = F.coalesce("_avg", F.lit(0.0)) + ratio
        return out.withColumn("pred", pred).withColumn("den", F.coalesce("_den", F.lit(0.0))) \
                  .drop("_num", "_den", "_avg")
    return (out.withColumn("pred", ratio).withColumn("den", F.coalesce("_den", F.lit(0.0)))
            .drop("_num", "_den"))


def _first_untaken(users: DataFrame, taken: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """(user_id, item_id): the first ``n`` items by id that a user has no row for in ``taken``."""
    number = dense_index(items, ["item_id"], "ix")
    total = number.select(F.count(F.lit(1)).alias("m"))
    by_ix = W.partitionBy("user_id").orderBy("ix")
    have = taken.join(number, "item_id").select("user_id", "ix").withColumn("before", F.row_number().over(by_ix) - 1) \
        .withColumn("prev", F.coalesce(F.lag("ix").over(by_ix), F.lit(-1)))
    # items between two taken ones, where fewer than n free ones lie further ahead
    inner = have.where((F.col("ix") - F.col("prev") > 1) & (F.col("prev") + 1 - F.col("before") < n)) \
        .select("user_id", (F.col("prev") + 1).alias("a"), (F.col("ix") - 1).alias("z"))
    ends = users.join(taken.join(number, "item_id").groupBy("user_id").agg(F.max("ix").alias("top")), "user_id", "left") \
        .crossJoin(F.broadcast(total)).select("user_id", (F.coalesce("top", F.lit(-1)) + 1).alias("a"), (F.col("m") - 1).alias("z"))
    free = inner.unionByName(ends.where("a <= z")) \
        .select("user_id", F.explode(F.sequence("a", F.least("z", F.col("a") + n - 1))).alias("ix"))
    first = free.withColumn("_r", F.row_number().over(by_ix)).where(F.col("_r") <= n)
    return first.join(number, "ix").select("user_id", "item_id")


def recommend(train: DataFrame, users: DataFrame, k: int = 100, n: int = 10,
              n_entities=None, chunk: int = S.BLOCK,
              items: DataFrame | None = None) -> DataFrame:
    """REC-22: top-``n`` unrated items per user by the bias-adjusted user-CF score.

    Every item of ``items`` (default: the items of ``train``) the user has not
    rated is a candidate.  Those no neighbour rated score exactly the user's
    average; only the first ``n`` of them by item_id can reach the list, and
    they are found as gaps in the user's sorted item numbers, without a
    product of users and items.  The top-n is a ``row_number() <= n`` per user,
    trimmed map-side, or found in the tasks of ``similarity.best``.
    """
    if n_entities is None:
        n_entities = train.select(F.countDistinct("user_id")).scalar()
    u = users.select("user_id").distinct()
    st = S.entity_stats(train, "user_id")
    cent, n_all = _centred(train, "user_id", n_entities, st)
    all_items = (train if items is None else items).select("item_id").distinct()
    nb = S.nearest(cent, "user_id", "item_id", k, n_all, u, chunk)
    if nb is None:
        nb = _ranked(cent, "user_id", k, n_entities, n_all, u, chunk)
    else:                                        # lists are made where a user's neighbours meet
        lists = S.best(nb, cent, train, u.join(st.select("user_id", "avg"), "user_id"), all_items, n, k)
        if lists is not None:
            return lists
    cand = (nb.select(F.col("a").alias("user_id"), "b", "sim")
            .join(cent.select(F.col("user_id").alias("b"), "item_id", "c"), "b")
            .join(train.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
            .groupBy("user_id", "item_id")
            .agg((F.sum(F.col("sim") * F.col("c")) / (F.sum("sim") + F.lit(EPS))).alias("_r"),
                 F.sum("sim").alias("den")))
    cand = cut_lineage(cand)
    avg = st.select("user_id", "avg")
    scored = (cand.join(broadcast_if_small(avg), "user_id")
              .withColumn("pred", F.col("avg") + F.col("_r")).drop("_r", "avg"))
    taken = (cand.select("user_id", "item_id")
             .unionByName(train.join(u, "user_id", "left_semi").select("user_id", "item_id").distinct()))
    fill = (_first_untaken(u, taken, all_items, n)
            .join(broadcast_if_small(avg), "user_id")
            .select("user_id", "item_id", F.lit(0.0).alias("den"), F.col("avg").alias("pred")))
    scored = scored.unionByName(fill)
    w = W.partitionBy("user_id").orderBy(F.round("pred", 9).desc(), F.col("item_id").asc())
    return (scored.withColumn("rank", F.row_number().over(w).cast("bigint"))
            .where(F.col("rank") <= n))
