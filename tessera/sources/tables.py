"""Parquet tables of a scale-factor folder and explicit schemas of the inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

RATINGS_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("ts", T.LongType()),
])

MOVIES_SCHEMA = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])

LINKS_SCHEMA = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("imdb_id", T.StringType()),   # keeps leading zeros
    T.StructField("tmdb_id", T.StringType()),
])

TAGS_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("tag", T.StringType()),
    T.StructField("ts", T.LongType()),
])

DOCS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("actors", T.ArrayType(T.StringType())),
    T.StructField("directors", T.ArrayType(T.StringType())),
    T.StructField("writer", T.StringType()),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a scale-factor folder (column pruning and filters reach the scan)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
