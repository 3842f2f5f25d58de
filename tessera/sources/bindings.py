"""Bindings of the recommender and search inputs onto the given tables.

* ratings  -- user = customer, item = part, rating on the 0.5 grid from the
              line quantity, one row per (user, item)
* catalog  -- one row per part; every 50th part has no genres
* docs     -- documents joined to their part (title, writer) and the part's
              credits: first 10 buying customers as actors, first 2
              suppliers as directors
* movie_pages -- one rendered movie page per docs row with its catalogue genres
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators.ratings import dedupe_ratings
from tessera.session import cut_lineage, written
from tessera.sources.tables import table

NO_GENRES = "(no genres listed)"


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per line item: (user_id, item_id, rating), duplicates kept."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("item_id"),
        (F.ceil(F.col("l_quantity") / 5).cast("double") / 2).alias("rating"))
    od = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select("user_id", "item_id", "rating"))


def ratings(spark: SparkSession, sf_dir: str, on_duplicate: str = "max") -> DataFrame:
    """(user_id, item_id, rating) with one row per pair."""
    return dedupe_ratings(raw_ratings(spark, sf_dir), on_duplicate)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, title, genres) with pipe-separated genres."""
    p = table(spark, sf_dir, "part")
    genres = (F.when(F.col("p_partkey") % 50 == 0, F.lit(NO_GENRES))
              .otherwise(F.concat(F.col("p_type"), F.lit("|"),
                                  F.regexp_replace("p_name", " ", "|"))))
    return p.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"),
                    genres.alias("genres"))


def _first_n(df: DataFrame, key: str, order: str, name: str, n: int) -> DataFrame:
    """First ``n`` names per key by ``order``; the row_number filter becomes a
    per-partition limit before the shuffle, so a hot key never lands whole in
    one task."""
    w = W.partitionBy(key).orderBy(order)
    top = df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
    return (top.groupBy(key)
            .agg(F.sort_array(F.collect_list(F.struct("rn", name))).alias("_l"))
            .select(key, F.transform("_l", lambda s: s[name]).alias(f"{name}s")))


def credits(spark: SparkSession, sf_dir: str, n_actors: int = 10,
            n_directors: int = 2) -> DataFrame:
    """(doc_id, actors, directors) arrays ordered by customer / supplier key."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    buyers = (li.select("l_orderkey", "l_partkey")
              .join(od, F.col("l_orderkey") == F.col("o_orderkey"))
              .select("l_partkey", F.col("o_custkey").alias("c_custkey")).distinct()
              .join(cu, "c_custkey"))
    sellers = (li.select("l_partkey", F.col("l_suppkey").alias("s_suppkey")).distinct()
               .join(su, "s_suppkey"))
    actors = _first_n(buyers.withColumnRenamed("c_name", "actor"), "l_partkey",
                      "c_custkey", "actor", n_actors)
    directors = _first_n(sellers.withColumnRenamed("s_name", "director"), "l_partkey",
                         "s_suppkey", "director", n_directors)
    return (actors.join(directors, "l_partkey", "full")
            .select(F.col("l_partkey").alias("doc_id"), "actors", "directors"))


def docs(spark: SparkSession, sf_dir: str, with_credits: bool = True, spread: int | None = None) -> DataFrame:
    """Search input: (doc_id, title, text, actors, directors, writer).

    The credits (a join over line items, orders, customers and suppliers)
    are small -- at most 12 names per part -- and are read by several
    consumers, so they are written once; ``with_credits=False`` leaves
    them out entirely (empty arrays) for jobs that never read people.  ``spread``
    deals the documents by id into that many partitions before they meet their part,
    so a job that counts terms by document shuffles a text once.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    if spread is not None:
        d = d.repartition(spread, "doc_id")
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"),
                                            F.col("p_name").alias("title"),
                                            F.col("p_brand").alias("writer"))
    if spread is not None:
        # the small sides are hashed, so that no text is sorted
        p = p.repartition(spread, "doc_id").hint("shuffle_hash")
    d = d.join(p, "doc_id")
    empty = F.array().cast("array<string>")
    if not with_credits:
        return d.select("doc_id", "title", "text", empty.alias("actors"),
                        empty.alias("directors"), "writer")
    cr = written(credits(spark, sf_dir), "credits")
    if spread is not None:
        cr = cr.repartition(spread, "doc_id").hint("shuffle_hash")
    return (d.join(cr, "doc_id", "left")
            .select("doc_id", "title", "text",
                    F.coalesce("actors", empty).alias("actors"),
                    F.coalesce("directors", empty).alias("directors"),
                    "writer"))


def movie_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, html): a movie page per docs row, people with links and genres marked up.

    Every seventh page names a director without a link first, every eleventh
    page's writer has none; text is escaped.
    """
    d = docs(spark, sf_dir).join(catalog(spark, sf_dir).select(F.col("item_id").alias("doc_id"), "genres"),
                                 "doc_id")

    def escaped(c):
        return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                         F.lit(">"), F.lit("&gt;"))

    def link(name, inner=lambda c: c):
        number = F.lpad(F.substring(F.substring_index(name, "#", -1), -7, 7), 7, "0")
        return F.concat(F.lit('<a href="/name/nm'), number, F.lit('/?ref">'), inner(escaped(name)), F.lit("</a>"))

    def each(names, wrap):
        return F.array_join(F.transform(names, wrap), "\n")

    ident, n = F.col("doc_id").cast("string"), F.col("doc_id")
    genres = each(F.split("genres", r"\|"), lambda g: F.concat(F.lit('<span itemprop="genre">'), escaped(g), F.lit("</span>")))
    directors = each(F.col("directors"), lambda x: F.concat(F.lit('<span itemprop="director">'), link(x), F.lit("</span>")))
    actors = each(F.col("actors"), lambda x: F.concat(
        F.lit('<td itemprop="actor">'),
        link(x, lambda c: F.concat(F.lit("<span>"), c, F.lit("</span>"))), F.lit("</td>")))
    writer = F.when(n % 11 == 0, F.lit("Unlinked")).otherwise(link(F.col("writer")))
    html = F.concat(
        F.lit("<html><head><title>"), escaped(F.col("title")), F.lit(" (19"), ident, F.lit(") - Films</title></head><body>"),
        genres, F.when(n % 7 == 0, F.lit('<span itemprop="director">Unlinked</span>')).otherwise(F.lit("")), directors,
        F.lit('<span itemprop="creator">'), writer, F.lit('</span><span class="rating">'), (n % 10).cast("string"),
        F.lit("</span>"), actors,
        F.lit('<h4>Country:</h4> <a href="/c">Land &amp; '), (n % 7).cast("string"), F.lit("</a>"),
        F.lit("<h4>Release Date:</h4> 1 May "), (n % 100 + 1900).cast("string"), F.lit(" (Land)\n"),
        F.lit("<h4>Gross:</h4>" + " " * 8 + "$"), ident, F.lit(" " * 16),
        F.lit('<h4>Color:</h4> <a href="/k">Caf&eacute; &#233; '), (n % 3).cast("string"), F.lit("</a>"),
        F.lit('<a id="follows"></a><a href="/title/tt'), ident, F.lit('/">Earlier</a> (1990)'),
        F.lit('<a href="/title/tt0/">Other</a> (TV (1991))<p class="plotSummary">'),
        escaped(F.coalesce("text", F.lit(""))), F.lit("</p></body></html>"))
    return d.select(F.col("doc_id").alias("page_id"), html.alias("html"))
