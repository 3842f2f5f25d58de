"""Ratings preparation: duplicate handling, splits, statistics, dense indices.

A ratings table is long form ``(user_id, item_id, rating)``; a missing rating
is an absent row, never a stored 0.  Splits add a ``split`` column instead of
producing separate tables, so one scan feeds train, validation and test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.hashing import md5_int
from tessera.session import cut_lineage, written

_DEDUPE = {
    "max": F.max,            # fixture convention
    "min": F.min,
    "sum": F.sum,            # sparse COO -> CSR convention
    "mean": F.avg,
}


def dedupe_ratings(raw: DataFrame, on_duplicate: str = "max",
                   user: str = "user_id", item: str = "item_id",
                   rating: str = "rating", ts: str | None = None) -> DataFrame:
    """AGG-17: one row per (user, item).

    ``on_duplicate`` is max / min / sum / mean, or ``last`` (latest ``ts``
    wins, the dense-matrix overwrite).  Partial aggregation runs map-side, so a
    hot user or item costs no more than any other key.
    """
    if on_duplicate == "last":
        if ts is None:
            raise ValueError("on_duplicate='last' needs a ts column")
        agg = F.max_by(rating, ts)
    else:
        agg = _DEDUPE[on_duplicate](rating)
    return raw.groupBy(user, item).agg(agg.cast("double").alias(rating))


def split_label(bucket: F.Column, n_train: int, n_valid: int) -> F.Column:
    return (F.when(bucket < n_train, F.lit("train"))
            .when(bucket < n_train + n_valid, F.lit("valid"))
            .otherwise(F.lit("test")))


def with_split(ratings: DataFrame, seed: int = 1, n_buckets: int = 10,
               n_train: int = 8, n_valid: int = 1) -> DataFrame:
    """SPL-1/SPL-2: deterministic train/valid/test label per (user, item).

    bucket = md5("user_item_seed")[:8] mod n_buckets; buckets below ``n_train``
    train, the next ``n_valid`` validate, the rest test.  No shuffle, and the
    same rows land in the same split on any engine.
    """
    key = F.concat_ws("_", F.col("user_id").cast("string"),
                      F.col("item_id").cast("string"), F.lit(str(seed)))
    bucket = md5_int(key) % F.lit(n_buckets)
    return (ratings.withColumn("bucket", bucket)
            .withColumn("split", split_label(F.col("bucket"), n_train, n_valid)))


#: Bits of the split key that a round of the rank search settles.
DIGIT = 12


def keys_at_ranks(rows: DataFrame, key: str, ranks: list[int], bits: int = 32, digit: int = DIGIT) -> list[tuple[int, int]]:
    """(value, place) for each rank (from 0): the ``key`` at that rank of the sorted
    table, and the rank's place among the rows of that value.

    Keys are integers under ``2 ** bits``.  A round counts, for each rank, the
    next ``digit`` bits of the keys that share the bits found so far: at most
    ``2 ** digit`` counts a rank reach the driver, and no row is sorted or moved.
    """
    found, below, left = [0] * len(ranks), list(ranks), bits
    while left:
        width = min(digit, left)
        value = F.col(key)
        which = F.array(*[F.struct(F.lit(n).alias("n"), (F.shiftright(value, left) == f).alias("here")) for n, f in enumerate(found)])
        bins = (rows.select(F.explode(F.filter(which, lambda w: w["here"])).alias("w"),
                            F.shiftright(value, left - width).bitwiseAND((1 << width) - 1).alias("bin"))
                .groupBy("w.n", "bin").count().collect())
        counts = [{} for _ in ranks]
        for r in bins:
            counts[r.n][r.bin] = r["count"]
        for n, here in enumerate(counts):
            for b in sorted(here):
                if below[n] < here[b]:
                    break
                below[n] -= here[b]
            found[n] = found[n] << width | b
        left -= width
    return list(zip(found, below))


def exact_split(ratings: DataFrame, train: float = 0.8, valid: float = 0.5, seed: int = 1) -> DataFrame:
    """SPL-1 with exact sizes: round(train * n) rows train, round(valid * rest) validate, the rest test.

    Rows are ranked by (md5_int("user_item_seed"), user_id, item_id), and the
    two border rows are found by :func:`keys_at_ranks`; of the few rows that
    share a border's key, the first by id up to it are taken.  Every row is then
    labelled on its own.  (user, item) pairs are distinct.
    """
    key = md5_int(F.concat_ws("_", F.col("user_id").cast("string"), F.col("item_id").cast("string"), F.lit(str(seed))))
    rows = written(ratings.withColumn("_key", key), "split-keys")
    n = rows.count()
    n_train = round(train * n)
    ends = [n_train, n_train + round(valid * (n - n_train))]
    label = F.lit("test")
    asked = [e - 1 for e in ends if e]
    at = dict(zip([e for e in ends if e], keys_at_ranks(rows, "_key", asked) if asked else []))
    for end, name in reversed(list(zip(ends, ("train", "valid")))):
        if end:
            value, place = at[end]
            last = rows.where(F.col("_key") == value).orderBy("user_id", "item_id").select("user_id", "item_id").limit(place + 1).collect()[-1]
            tie = (F.col("user_id") < last.user_id) | ((F.col("user_id") == last.user_id) & (F.col("item_id") <= last.item_id))
            label = F.when((F.col("_key") < value) | ((F.col("_key") == value) & tie), F.lit(name)).otherwise(label)
    return rows.withColumn("split", label).drop("_key")


def random_split(ratings: DataFrame, weights=(0.8, 0.1, 0.1), seed: int = 1):
    """Bernoulli split with Spark's ``randomSplit`` (approximate sizes)."""
    return ratings.randomSplit(list(weights), seed=seed)


def split_part(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") == name).drop("split", "bucket")


def leave_n_out(ratings: DataFrame, n: int = 10, seed: int = 1,
                min_ratings: int | None = None) -> DataFrame:
    """SPL-3 / WIN-3: hold out ``n`` pseudo-random ratings per user.

    Users with fewer than ``min_ratings`` (default ``n``) ratings are left
    out.  The held-out rows come from a ``row_number() <= n`` filter, which
    Spark turns into a per-partition limit before the shuffle; the per-user
    counts are a partial aggregate.  The two joins on the user are left to AQE's
    skew handling.  The ratings are written once (checkpoint).
    """
    ratings = cut_lineage(ratings)
    need = n if min_ratings is None else min_ratings
    counts = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    eligible = counts.where(F.col("_n") >= need).select("user_id")
    base = ratings.join(eligible, "user_id", "left_semi")
    order = md5_int(F.concat_ws("_", F.col("user_id").cast("string"),
                                F.col("item_id").cast("string"), F.lit(str(seed))))
    w = W.partitionBy("user_id").orderBy(order, F.col("item_id"))
    test = (base.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= n).drop("_rn"))
    train = base.join(test.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    return (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test"))))


def assert_disjoint(a: DataFrame, b: DataFrame, keys=("user_id", "item_id")) -> bool:
    """SET-4: True when no key pair is in both tables."""
    return a.select(*keys).intersect(b.select(*keys)).isEmpty()


def dataset_stats(split_ratings: DataFrame) -> DataFrame:
    """AGG-1 / REC-24: distinct users, items and ratings per split and overall."""
    per = (split_ratings.groupBy("split")
           .agg(F.countDistinct("user_id").alias("n_users"),
                F.countDistinct("item_id").alias("n_items"),
                F.count(F.lit(1)).alias("n_ratings")))
    total = split_ratings.agg(F.lit("all").alias("split"),
                              F.countDistinct("user_id").alias("n_users"),
                              F.countDistinct("item_id").alias("n_items"),
                              F.count(F.lit(1)).alias("n_ratings"))
    return per.unionByName(total)


def dense_index(keys: DataFrame, order_cols, name: str = "ix") -> DataFrame:
    """0-based dense index of ``keys`` rows in ``order_cols`` order.

    A range-partitioned sort, then per-partition row counts (one row per
    partition) turned into offsets.  The sorted keys are checkpointed first so
    both uses see the same partitioning.  Nothing is gathered into one task.
    """
    s = keys.orderBy(*order_cols).withColumn("_mid", F.monotonically_increasing_id())
    s = cut_lineage(s.withColumn("_pid", F.shiftright("_mid", 33)))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(
            W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    local = F.col("_mid") - F.shiftleft(F.col("_pid"), 33)
    return (s.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
            .withColumn(name, F.col("_off") + local)
            .drop("_mid", "_pid", "_off"))


def item_index(ratings: DataFrame) -> DataFrame:
    """WIN-6: items numbered in order of first appearance.

    The ratings order is (user_id, item_id), as in a file sorted by user; an
    item first appears with its smallest rater.
    """
    first = ratings.groupBy("item_id").agg(F.min("user_id").alias("first_user"))
    return dense_index(first, ["first_user", "item_id"], "item_ix")
