"""File sources and sinks (SRC-1..6, SNK-1..5) with explicit schemas.

No schema inference anywhere: inference scans the data an extra time and
guesses types (it would turn a zero-padded id into an integer).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.tables import LINKS_SCHEMA, MOVIES_SCHEMA, RATINGS_SCHEMA, TAGS_SCHEMA


def read_ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: ``userId,movieId,rating,timestamp`` with a header line."""
    return spark.read.schema(RATINGS_SCHEMA).option("header", True).csv(path)


def read_movies_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2: ``movieId,title,genres`` (quoted titles may contain commas)."""
    return (spark.read.schema(MOVIES_SCHEMA).option("header", True)
            .option("quote", '"').option("escape", '"').csv(path))


def read_links_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3: ``movieId,imdbId,tmdbId``; imdbId stays a string with its zeros."""
    return spark.read.schema(LINKS_SCHEMA).option("header", True).csv(path)


def read_tags_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TAGS_SCHEMA).option("header", True).csv(path)


MOVIE_RECORD_SCHEMA = T.StructType([
    T.StructField("imdbid", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("genres", T.ArrayType(T.StringType())),
    T.StructField("directors", T.ArrayType(T.StringType())),
    T.StructField("dir_name", T.ArrayType(T.StringType())),
    T.StructField("writer", T.StringType()), T.StructField("writer_name", T.StringType()),
    T.StructField("rating", T.StringType()),
    T.StructField("actors", T.ArrayType(T.StringType())),
    T.StructField("actor_names", T.ArrayType(T.StringType())),
    T.StructField("country", T.StringType()), T.StructField("release_date", T.StringType()),
    T.StructField("gross", T.StringType()), T.StructField("color", T.StringType()),
    T.StructField("related_movies", T.ArrayType(T.StringType())),
    T.StructField("synopsis", T.StringType()),
])


def read_movie_records(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """SRC-4: movie records; broken JSON lines are dropped, not fatal."""
    if fmt == "json":
        return (spark.read.schema(MOVIE_RECORD_SCHEMA).option("mode", "DROPMALFORMED")
                .json(path))
    return spark.read.parquet(path)


MEDIAWIKI_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("revision", T.StructType([T.StructField("text", T.StringType())])),
])


def read_mediawiki_xml(spark: SparkSession, path: str) -> DataFrame:
    """SRC-5: one row per ``<page>`` (title, id, revision.text)."""
    return (spark.read.format("xml").option("rowTag", "page")
            .option("ignoreSurroundingSpaces", False).schema(MEDIAWIKI_SCHEMA).load(path)
            .select("title", "id", F.col("revision.text").alias("text")))


def write_mediawiki_xml(pages: DataFrame, path: str) -> None:
    """Pages ``(title, id, text)`` as MediaWiki-style XML."""
    (pages.select("title", "id", F.struct(F.col("text")).alias("revision"))
     .write.mode("overwrite").format("xml").option("rootTag", "mediawiki")
     .option("rowTag", "page").save(path))


def read_text_shards(spark: SparkSession, path: str) -> DataFrame:
    """SRC-6: every line of every shard file under ``path`` (``value``)."""
    return spark.read.text(path)


def write_shards(df: DataFrame, path: str, n: int | None = None, fmt: str = "json") -> None:
    """SNK-1 / SNK-5: ``n`` round-robin shard files; one for each partition by default."""
    (df.repartition(n) if n else df).write.mode("overwrite").format(fmt).save(path)


def write_text_shards(df: DataFrame, col: str, path: str, n: int | None = None) -> None:
    lines = df.select(F.col(col).alias("value"))
    (lines.repartition(n) if n else lines).write.mode("overwrite").text(path)


def write_ratings_csv(ratings: DataFrame, path: str) -> None:
    (ratings.select(F.col("user_id").alias("userId"), F.col("item_id").alias("movieId"),
                    "rating", F.lit(0).cast("long").alias("timestamp"))
     .write.mode("overwrite").option("header", True).csv(path))


def write_catalog_csv(catalog: DataFrame, path: str) -> None:
    """movies.csv layout: movieId,title,genres (titles quoted when needed)."""
    (catalog.select(F.col("item_id").alias("movieId"), "title", "genres")
     .write.mode("overwrite").option("header", True).option("quote", '"')
     .option("escape", '"').csv(path))


def write_links_csv(links: DataFrame, path: str) -> None:
    """links.csv layout: movieId,imdbId,tmdbId with the ids as strings."""
    (links.select(F.col("item_id").alias("movieId"), F.col("imdb_id").alias("imdbId"),
                  F.col("tmdb_id").alias("tmdbId"))
     .write.mode("overwrite").option("header", True).csv(path))
