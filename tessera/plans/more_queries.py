"""Named queries for the matrix triples, legacy store, catalogue files and
nested postings (REC-23, TXT-9, SRC-2/3 + JN-13, AGG-14, SRC-4 + SNK-5), movie
records with data, catalogue reports, the 90/10 split and the doc store of
repeated ids (HTM-1..10, SRT-1, AGG-18/19, SPL-2, REC-18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import html as H
from tessera.operators import content as CT, index as IX, ratings as rt, search as SR
from tessera.plans import oracle as O
from tessera.plans.queries import register
from tessera.plans.text_queries import _spread
from tessera.session import scratch_path
from tessera.sources import bindings as B, files as FS
from tessera.sources.tables import table


@register("ratings_matrix", O.with_ctes("""
SELECT u.row_ix, i.col_ix, r.rating
FROM ratings r
JOIN (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS row_ix
      FROM (SELECT DISTINCT user_id FROM ratings) x) u ON r.user_id = u.user_id
JOIN (SELECT item_id, row_number() OVER (ORDER BY first_user, item_id) - 1 AS col_ix
      FROM (SELECT item_id, MIN(user_id) AS first_user FROM ratings GROUP BY item_id) y) i
  ON r.item_id = i.item_id""", "ratings"))
def q_ratings_matrix(spark, sf):
    """REC-23 / JN-1: (row, column, value) triples over dense 0-based indices
    (users by id, items by first appearance)."""
    r = B.ratings(spark, sf)
    users = rt.dense_index(r.select("user_id").distinct(), ["user_id"], "row_ix")
    items = rt.item_index(r).select("item_id", F.col("item_ix").alias("col_ix"))
    return r.join(users, "user_id").join(items, "item_id").select("row_ix", "col_ix", "rating")


@register("legacy_docstore", O.with_ctes(f"""
SELECT doc_id, title, '{SR.URL_PREFIX}' || CAST(doc_id AS VARCHAR) || '/' AS url, text
FROM docs""", "docs"))
def q_legacy_docstore(spark, sf):
    """TXT-9: original-case title, result URL and original text."""
    return IX.legacy_docstore(B.docs(spark, sf, with_credits=False), SR.URL_PREFIX)


O.define("links", (), """
    SELECT p_partkey AS item_id, lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS imdb_id,
           CAST(p_partkey + 100000 AS VARCHAR) AS tmdb_id FROM part""")


@register("catalog_links_roundtrip", O.with_ctes("""
SELECT c.item_id, l.imdb_id, c.title, c.genres
FROM catalog c JOIN links l ON c.item_id = l.item_id""", "catalog", "links"))
def q_catalog_links_roundtrip(spark, sf):
    """SRC-2 / SRC-3 / JN-13: catalogue and links written as CSV, read back
    with fixed schemas (the zero-padded imdb id stays a string), joined."""
    cat = B.catalog(spark, sf)
    links = table(spark, sf, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.lpad(F.col("p_partkey").cast("string"), 7, "0").alias("imdb_id"),
        (F.col("p_partkey") + 100000).cast("string").alias("tmdb_id"))
    cpath, lpath = scratch_path(spark, "movies-csv"), scratch_path(spark, "links-csv")
    FS.write_catalog_csv(cat, cpath)
    FS.write_links_csv(links, lpath)
    return (FS.read_movies_csv(spark, cpath)
            .join(FS.read_links_csv(spark, lpath).select("item_id", "imdb_id"), "item_id")
            .select("item_id", "imdb_id", "title", "genres"))


@register("postings_lists", O.with_ctes("""
SELECT shard, term, CAST(floor(doc_id / 100000) AS BIGINT) AS block,
       CAST(to_json(list({'doc_id': doc_id, 'tf': tf} ORDER BY doc_id)) AS VARCHAR) AS postings
FROM postings GROUP BY shard, term, CAST(floor(doc_id / 100000) AS BIGINT)""", "postings"))
def q_postings_lists(spark, sf):
    """AGG-14: nested postings per (shard, term, doc-id block), as JSON text."""
    lists = IX.postings_lists(IX.postings(B.docs(spark, sf), spread=_spread(spark, sf)))
    return lists.select("shard", "term", F.col("block").cast("bigint").alias("block"),
                        F.to_json("postings").alias("postings"))


@register("movie_records_roundtrip")
def q_movie_records_roundtrip(spark, sf):
    """SNK-5 / SNK-1 / SRC-4: records extracted from every page, written as
    JSON shards and read back with the record schema (malformed lines dropped)."""
    recs = (table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("imdbid"), H.movie_record().alias("r"))
        .select("imdbid", "r.*"))
    path = scratch_path(spark, "movie-records")
    FS.write_shards(recs, path)
    return FS.read_movie_records(spark, path)


def _ids_sql(names: str) -> str:
    return (f"array_to_string(list_transform({names}, "
            "lambda x: 'nm' || lpad(right(split_part(x, '#', 2), 7), 7, '0')), '|')")


@register("movie_page_records", O.with_ctes(f"""
SELECT CAST(d.doc_id AS VARCHAR) AS imdbid, d.title || ' ' AS title, c.genres,
       CASE WHEN d.doc_id % 7 = 0 THEN '' ELSE {_ids_sql("d.directors")} END AS directors,
       CASE WHEN d.doc_id % 7 = 0 THEN '' ELSE array_to_string(d.directors, '|') END AS dir_name,
       CASE WHEN d.doc_id % 11 = 0 THEN '' ELSE {_ids_sql("[d.writer]")} END AS writer,
       CASE WHEN d.doc_id % 11 = 0 THEN '' ELSE d.writer END AS writer_name,
       CAST(d.doc_id % 10 AS VARCHAR) AS rating, {_ids_sql("d.actors")} AS actors,
       array_to_string(d.actors, '|') AS actor_names, 'Land & ' || CAST(d.doc_id % 7 AS VARCHAR) AS country,
       '1 May ' || CAST(d.doc_id % 100 + 1900 AS VARCHAR) AS release_date,
       '$' || CAST(d.doc_id AS VARCHAR) AS gross, 'Caf\u00e9 \u00e9 ' || CAST(d.doc_id % 3 AS VARCHAR) AS color,
       'tt' || CAST(d.doc_id AS VARCHAR) || '/' AS related_movies,
       replace(COALESCE(d.text, ''), chr(10), ' ' || chr(10) || ' ') AS synopsis
FROM docs d JOIN catalog c ON d.doc_id = c.item_id""", "docs", "catalog"))
def q_movie_page_records(spark, sf):
    """HTM-1..10, SNK-5, SRC-4: records of rendered movie pages, written as JSON
    shards and read back, lists joined by '|'."""
    recs = B.movie_pages(spark, sf).select(F.col("page_id").cast("string").alias("imdbid"),
                                           H.movie_record().alias("r")).select("imdbid", "r.*")
    path = scratch_path(spark, "movie-page-records")
    FS.write_shards(recs, path)
    got = FS.read_movie_records(spark, path)
    return got.select(*[F.array_join(c, "|").alias(c) if t.startswith("array") else F.col(c)
                        for c, t in got.dtypes])


@register("catalog_sorted", O.with_ctes("SELECT item_id, title, genres FROM catalog ORDER BY item_id", "catalog"))
def q_catalog_sorted(spark, sf):
    """SRT-1: the catalogue in item order."""
    return B.catalog(spark, sf).orderBy("item_id")


@register("duplicate_items", """
SELECT p_partkey - p_partkey % 3 AS item_id, COUNT(*) AS n FROM part
GROUP BY p_partkey - p_partkey % 3 HAVING COUNT(*) > 1""")
def q_duplicate_items(spark, sf):
    """AGG-18: ids listed more than once, in a catalogue where three parts share an id."""
    shared = B.catalog(spark, sf).withColumn("item_id", F.col("item_id") - F.col("item_id") % 3)
    return CT.duplicate_items(shared)


KNOWN_GENRES = ("ECONOMY", "SMALL", "red", "blue")


@register("unknown_genres", O.with_ctes(f"""
SELECT DISTINCT item_id, genre FROM (
    SELECT item_id, unnest(string_split(genres, '|')) AS genre FROM catalog
    WHERE genres <> '{B.NO_GENRES}') t
WHERE genre NOT IN {KNOWN_GENRES}""", "catalog"))
def q_unknown_genres(spark, sf):
    """REC-18 report: genres of the usable catalogue outside a given list."""
    return CT.unknown_genres(B.catalog(spark, sf), KNOWN_GENRES).select("item_id", "genre")


@register("split_90_10", O.with_ctes(f"""
SELECT CASE WHEN b < 9 THEN 'train' ELSE 'test' END AS split, COUNT(*) AS n, SUM(rating) AS sum_rating
FROM (SELECT rating, {O.md5_int("concat(user_id, '_', item_id, '_1')")} % 10 AS b FROM ratings) t
GROUP BY 1""", "ratings"))
def q_split_90_10(spark, sf):
    """SPL-2: size and rating sum of a 90/10 split."""
    s = rt.with_split(B.ratings(spark, sf), n_train=9, n_valid=0)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("sum_rating"))


@register("docstore_latest", """
SELECT CAST(doc_id - doc_id % 2 AS BIGINT) AS doc_id, arg_max(text, doc_id) AS text
FROM (SELECT doc_id, COALESCE(text, '') AS text FROM documents) t GROUP BY doc_id - doc_id % 2""")
def q_docstore_latest(spark, sf):
    """AGG-19: a store of repeated ids (neighbouring documents share one) keeps the last row of each."""
    d = table(spark, sf, "documents").select(
        (F.col("doc_id") - F.col("doc_id") % 2).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.col("doc_id").alias("position"))
    return IX.keep_last(d, "doc_id", "position").select("doc_id", "text")
