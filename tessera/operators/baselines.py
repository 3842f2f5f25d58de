"""Average and bias baselines (REC-1..4).

Averages divide by ``count + EPS`` as the reference does, so an entity that
is absent from train predicts 0 (``coalesce`` after a left join), and the
bias baseline for such a side contributes ``-global``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.sizing import broadcast_if_small

EPS = 1e-9


def global_average(train: DataFrame) -> DataFrame:
    """AGG-3: one row ``(global_avg)`` = sum / count over train."""
    return train.agg((F.sum("rating") / F.count(F.lit(1))).alias("global_avg"))


def entity_average(train: DataFrame, key: str, name: str) -> DataFrame:
    """AGG-4 / AGG-5: ``key -> sum / (count + EPS)``."""
    return train.groupBy(key).agg(
        (F.sum("rating") / (F.count(F.lit(1)) + F.lit(EPS))).alias(name))


def _attach(pairs: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    # The stats side has one row per user or item; it is broadcast only when
    # its estimated size is small, otherwise this is a shuffle join.
    return pairs.join(broadcast_if_small(stats), key, "left")


def predict_global(train: DataFrame, pairs: DataFrame) -> DataFrame:
    """REC-1: every pair gets the global average (a scalar subquery)."""
    return pairs.withColumn("pred", global_average(train).scalar())


def predict_user_average(train: DataFrame, pairs: DataFrame) -> DataFrame:
    """REC-2: pair -> user average over train, 0 for an unseen user."""
    ua = entity_average(train, "user_id", "user_avg")
    return (_attach(pairs, ua, "user_id")
            .withColumn("pred", F.coalesce("user_avg", F.lit(0.0))).drop("user_avg"))


def predict_item_average(train: DataFrame, pairs: DataFrame) -> DataFrame:
    """REC-3: pair -> item average over train, 0 for an unseen item."""
    ia = entity_average(train, "item_id", "item_avg")
    return (_attach(pairs, ia, "item_id")
            .withColumn("pred", F.coalesce("item_avg", F.lit(0.0))).drop("item_avg"))


def predict_bias(train: DataFrame, pairs: DataFrame) -> DataFrame:
    """REC-4: b + (A_u - b) + (A_i - b), with A = 0 for an unseen side."""
    ua = entity_average(train, "user_id", "user_avg")
    ia = entity_average(train, "item_id", "item_avg")
    out = (_attach(_attach(pairs, ua, "user_id"), ia, "item_id")
           .withColumn("global_avg", global_average(train).scalar()))
    b = F.col("global_avg")
    pred = (b + (F.coalesce("user_avg", F.lit(0.0)) - b)
            + (F.coalesce("item_avg", F.lit(0.0)) - b))
    return out.withColumn("pred", pred).drop("user_avg", "item_avg", "global_avg")


BASELINES = {
    "global": predict_global,
    "user": predict_user_average,
    "item": predict_item_average,
    "bias": predict_bias,
}
