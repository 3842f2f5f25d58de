"""Content-based recommendation from item genres (REC-18..21).

Item profile: multi-hot genres of each catalogue item (long form
``(item_id, genre)``).  User profile: for each genre, the sum of the user's
centred train ratings on items of that genre divided by the number of such
non-zero entries (+EPS).  Prediction for a pair: cosine of the user profile
and the item profile, plus the user's average; a zero-norm profile gives
cosine 0 (the reference produced NaN there).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.sizing import broadcast_if_small
from tessera.sources.bindings import NO_GENRES

EPS = 1e-9

# The genre list of the movie catalogue the reference reads.
MOVIE_GENRES = ("Action", "Adventure", "Animation", "Children", "Comedy", "Crime",
                "Documentary", "Drama", "Fantasy", "Film-Noir", "Horror", "Musical",
                "Mystery", "Romance", "Sci-Fi", "Thriller", "War", "Western", "IMAX")


def usable_catalog(catalog: DataFrame) -> DataFrame:
    """FLT-1 + AGG-18: drop items without genres, keep one row per item id
    (the smallest (title, genres) when an id repeats)."""
    c = catalog.where(F.col("genres") != NO_GENRES)
    return (c.groupBy("item_id").agg(F.min(F.struct("title", "genres")).alias("_r"))
            .select("item_id", "_r.title", "_r.genres"))


def duplicate_items(catalog: DataFrame) -> DataFrame:
    """AGG-18 report: item ids that appear more than once, with their count."""
    return (catalog.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def _genres(catalog: DataFrame) -> DataFrame:
    return catalog.select("item_id", F.explode(F.array_distinct(
        F.split("genres", r"\|"))).alias("genre"))


def item_profile(catalog: DataFrame, vocabulary=None) -> DataFrame:
    """REC-18: ``(item_id, genre)``; with a ``vocabulary`` only known genres stay
    (see ``unknown_genres`` for the rest)."""
    g = _genres(usable_catalog(catalog))
    if vocabulary is None:
        return g
    vocab = g.sparkSession.createDataFrame([(x,) for x in vocabulary], "genre string")
    return g.join(F.broadcast(vocab), "genre", "left_semi")


def unknown_genres(catalog: DataFrame, vocabulary) -> DataFrame:
    """Rows whose genre is not in ``vocabulary`` (an error in the reference)."""
    vocab = catalog.sparkSession.createDataFrame([(x,) for x in vocabulary], "genre string")
    return _genres(usable_catalog(catalog)).join(F.broadcast(vocab), "genre", "left_anti")


def rated_known_items(ratings: DataFrame, catalog: DataFrame) -> DataFrame:
    """JN-3: ratings of catalogue items with genres (the data the model uses)."""
    return ratings.join(usable_catalog(catalog).select("item_id"), "item_id", "left_semi")


def unknown_items(ratings: DataFrame, catalog: DataFrame) -> DataFrame:
    """JN-3 report: ratings whose item is not in the usable catalogue."""
    return ratings.join(usable_catalog(catalog).select("item_id"), "item_id", "left_anti")


def user_average(train: DataFrame) -> DataFrame:
    return train.groupBy("user_id").agg(
        (F.sum("rating") / (F.count(F.lit(1)) + F.lit(EPS))).alias("avg"))


def user_profile(train: DataFrame, iprof: DataFrame) -> DataFrame:
    """REC-19 / AGG-12: ``(user_id, genre, weight)``."""
    ua = user_average(train)
    c = (train.join(broadcast_if_small(ua), "user_id")
         .select("user_id", "item_id", (F.col("rating") - F.col("avg")).alias("c")))
    return (c.join(iprof, "item_id")
            .groupBy("user_id", "genre")
            .agg((F.sum("c") / (F.count(F.when(F.col("c") != 0, 1)) + F.lit(EPS)))
                 .alias("weight")))


def predict(train: DataFrame, pairs: DataFrame, iprof: DataFrame) -> DataFrame:
    """REC-20: ``pred`` = cos(user profile, item profile) + user average.

    Only the requested pairs are scored: pairs join their item's genres and
    then the user's weight for each genre (JN-9 restricted to targets).
    """
    uprof = user_profile(train, iprof)
    unorm = uprof.groupBy("user_id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("_un"))
    inorm = iprof.groupBy("item_id").agg(F.sqrt(F.count(F.lit(1)).cast("double")).alias("_in"))
    keys = pairs.select("user_id", "item_id").distinct()
    dots = (keys.join(iprof, "item_id")
            .join(uprof, ["user_id", "genre"])
            .groupBy("user_id", "item_id").agg(F.sum("weight").alias("_dot")))
    out = (pairs.join(dots, ["user_id", "item_id"], "left")
           .join(broadcast_if_small(user_average(train)), "user_id", "left")
           .join(unorm, "user_id", "left").join(inorm, "item_id", "left"))
    cos = (F.when((F.col("_un") > 0) & (F.col("_in") > 0),
                  F.coalesce("_dot", F.lit(0.0)) / (F.col("_un") * F.col("_in")))
           .otherwise(F.lit(0.0)))
    return (out.withColumn("pred", F.coalesce("avg", F.lit(0.0)) + cos)
            .drop("_dot", "avg", "_un", "_in"))
