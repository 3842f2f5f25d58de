"""Query serving as batch jobs (TXT-11..20, WIN-4, SRT-2, LIM-1, FLT-5, SNK-6).

A *table* of queries ``(query_id, q)`` is answered in one job:

1. terms: ``split(q, ' ')`` with positions; duplicates count twice, case is
   kept for the index lookup (people are indexed with case).
2. score(d) = sum over query terms of tf(t, d) * idf(t)^2 (unknown term: idf 0,
   so a document reached only through such terms keeps score 0).
3. a scored document is kept if the title+text (plot search) or a person field
   (person search) contains a query term.  A hit through a term that stands
   there is kept without a look at the text; only documents reached through
   other fields alone are fetched and tested;
4. the first ``limit`` per query by (score, doc_id) desc are returned.  With
   ``shard_limit`` only that many kept documents of each shard are merged,
   which changes the list only where it is below ``limit``.

Search (3 and 4) goes by block maxima: with the most that a block of documents
holds of each term, a query's score is bounded for the whole block.  The
``FIRST`` blocks of highest bound are scored and filtered; the query's
``limit``-th kept score is then a floor, and only blocks whose bound reaches it
are scored at all.  A document left out is below the floor, so the lists are
those of scoring everything.  Texts are fetched for the returned rows and the
documents tested in step 3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.text import any_term_in, highlight, leading_snippet, snippet
from tessera.operators.index import block_maxima
from tessera.plans.sizing import broadcast_if_small
from tessera.session import written

# Result URL format, results per query.
URL_PREFIX = "http://www.imdb.com/title/tt"
RESULT_LIMIT = 10
#: Query-term rows (a term and two numbers each) that may be broadcast.
BROADCAST_TERMS = 100_000
#: Blocks of each query that are scored to find its floor.
FIRST = 4
#: Covers the rounding of a bound, a sum in another order than the scores'.
ABOVE = 1 + 1e-9


def result_url(doc_id, prefix: str = URL_PREFIX) -> Column:
    """TXT-20: prefix + id + '/'."""
    d = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.concat(F.lit(prefix), d.cast("string"), F.lit("/"))


def query_terms(queries: DataFrame) -> DataFrame:
    """TXT-11: ``(query_id, pos, term)`` from a single-space split, case kept."""
    return queries.select("query_id", F.posexplode(F.split("q", " ", -1)).alias("pos", "term"))


def term_lists(queries: DataFrame) -> DataFrame:
    """``(query_id, terms)``: the split query as an array (bounded by query length)."""
    return queries.select("query_id", F.split("q", " ", -1).alias("terms"))


def _counted(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint where it has few rows: written lists of many queries are small
    files, but the driver holds every row of a broadcast."""
    return F.broadcast(df) if df.count() <= BROADCAST_TERMS else df


def _weighted(queries: DataFrame, idf: DataFrame) -> DataFrame:
    """(query_id, term, qidf), written: read by every step and counted."""
    return written(query_terms(queries)
                   .join(broadcast_if_small(idf.select("term", "idf")), "term", "left")
                   .select("query_id", "term", F.coalesce("idf", F.lit(0.0)).alias("qidf")), "query-terms")


def _hits(qt: DataFrame, post: DataFrame, broadcast_terms: int, salts: int, by: str = "doc_id") -> DataFrame:
    """Rows of ``post`` joined to the query terms: broadcast where counted, else salted by ``by``."""
    if qt.count() <= broadcast_terms:
        return post.join(F.broadcast(qt), "term")
    parts = qt.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (post.withColumn("_part", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
            .join(parts, ["term", "_part"]).drop("_part"))


def score(queries: DataFrame, postings: DataFrame, idf: DataFrame,
          broadcast_terms: int = BROADCAST_TERMS, salts: int = 32) -> DataFrame:
    """TXT-12 / TXT-13 / JN-10 / JN-11 / AGG-16: ``(query_id, shard, doc_id, score)``.

    The weighted query terms are written once and counted.  Up to
    ``BROADCAST_TERMS`` rows they are broadcast, so the postings of a frequent
    term are probed where they lie; beyond it the postings are spread over
    ``salts`` parts of each term, and the query terms repeated for each part.
    Both ways give the same rows.
    """
    qt = _weighted(queries, idf)
    hits = _hits(qt, postings.select("shard", "term", "doc_id", "tf"), broadcast_terms, salts)
    return (hits.groupBy("query_id", "shard", "doc_id")
            .agg(F.sum(F.col("tf") * F.col("qidf") * F.col("qidf")).alias("score")))


def shard_top(scored: DataFrame, shard_limit: int | None = None) -> DataFrame:
    """WIN-4: best ``shard_limit`` per (query, shard) by (score desc, doc_id desc)."""
    if shard_limit is None:
        return scored
    w = W.partitionBy("query_id", "shard").orderBy(F.col("score").desc(), F.col("doc_id").desc())
    return (scored.withColumn("_r", F.row_number().over(w))
            .where(F.col("_r") <= shard_limit).drop("_r"))


def _ranked(df: DataFrame, limit: int) -> DataFrame:
    """SRT-2 + LIM-1: first ``limit`` per query by (score desc, doc_id desc)."""
    w = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").desc())
    return (df.withColumn("rank", F.row_number().over(w).cast("bigint"))
            .where(F.col("rank") <= limit))


def _found(hits: DataFrame, queries: DataFrame, store: DataFrame, tested, broadcast_terms: int) -> DataFrame:
    """JN-12: scored documents that hold a query term where ``tested`` looks; only unsure ones are fetched."""
    cols = ["query_id", "shard", "doc_id", "score"]
    sure, unsure = hits.where("sure").select(*cols), hits.where(~F.col("sure")).select(*cols)
    n = unsure.count()
    if not n:
        return sure
    asked = store.drop("shard").join(F.broadcast(unsure) if n <= broadcast_terms else unsure, "doc_id")
    return sure.unionByName(asked.join(_counted(term_lists(queries)), "query_id").where(tested("terms")).select(*cols))


def block_max_top(queries: DataFrame, postings: DataFrame, idf: DataFrame, store: DataFrame, tested, flag: str,
                  shard_limit: int | None = None, limit: int = RESULT_LIMIT, maxima: DataFrame | None = None,
                  first: int = FIRST, broadcast_terms: int = BROADCAST_TERMS, salts: int = 32) -> DataFrame:
    """WIN-4, SRT-2, LIM-1: ``(query_id, shard, doc_id, score, rank)`` of the kept documents, written.

    ``flag`` names the postings' column that says a term stands in the fields
    that ``tested`` looks at.  ``maxima`` are those of the written index; without
    them they are taken from the postings.  The lists of the terms asked for are
    read once.  The floor comes from documents that
    are kept for sure, so no text is read for it.
    """
    qt = _weighted(queries, idf)
    asked = qt.select("term").distinct()
    # postings without blocks or flags: one block, every document is tested
    post = postings.select("shard", "term", "doc_id", "tf", *[
        (F.col(c) if c in postings.columns else F.lit(0)).alias(n) for c, n in (("block", "block"), (flag, "there"))])
    post = written(post.join(F.broadcast(asked) if qt.count() <= broadcast_terms else asked, "term", "left_semi"), "query-postings")
    weight = F.col("qidf") * F.col("qidf")
    bounds = _hits(qt, block_maxima(post) if maxima is None else maxima, broadcast_terms, salts, "block")
    bounds = bounds.groupBy("query_id", "block").agg((F.sum(F.col("max_tf") * weight) * ABOVE).alias("bound"))
    best = W.partitionBy("query_id").orderBy(F.col("bound").desc(), F.col("block"))
    bounds = written(bounds.withColumn("_r", F.row_number().over(best)), "query-blocks")

    def scored(blocks: DataFrame) -> DataFrame:
        return (_hits(qt, post, broadcast_terms, salts).join(blocks.select("query_id", "block"), ["query_id", "block"], "left_semi")
                .groupBy("query_id", "shard", "doc_id")
                .agg(F.sum(F.col("tf") * F.col("qidf") * F.col("qidf")).alias("score"), (F.max("there") > 0).alias("sure")))
    seen = _ranked(shard_top(scored(bounds.where(F.col("_r") <= first)).where("sure"), shard_limit), limit)
    floor = _counted(written(seen.where(F.col("rank") == limit).select("query_id", F.col("score").alias("floor")), "query-floors"))
    reach = bounds.join(floor, "query_id", "left").where(F.col("floor").isNull() | (F.col("bound") >= F.col("floor")))
    hits = (scored(reach).join(floor, "query_id", "left")
            .where(F.col("floor").isNull() | (F.col("score") >= F.col("floor"))).drop("floor"))
    kept = _found(written(hits, "query-hits"), queries, store, tested, broadcast_terms)
    return written(_ranked(shard_top(kept, shard_limit), limit), "query-top")


def _fetched(top: DataFrame, store: DataFrame, queries: DataFrame) -> DataFrame:
    """Returned documents with their stored fields and the query's terms."""
    return (store.drop("shard").join(_counted(top), "doc_id")
            .join(_counted(term_lists(queries)), "query_id"))


def search_plot(queries: DataFrame, postings: DataFrame, idf: DataFrame, store: DataFrame,
                shard_limit: int | None = None, limit: int = RESULT_LIMIT,
                url_prefix: str = URL_PREFIX, maxima: DataFrame | None = None) -> DataFrame:
    """TXT-15: ``(query_id, rank, doc_id, title, url, snippet, score)``.

    A candidate is kept when its title+text contains a query term
    (case-insensitive literal substring); the snippet is cut from the
    highlighted title+text.
    """
    body = F.concat("title", "text")
    top = block_max_top(queries, postings, idf, store, lambda terms: any_term_in(body, terms), "in_content",
                        shard_limit, limit, maxima)
    return _fetched(top, store, queries).select(
        "query_id", "rank", "doc_id", "title", result_url("doc_id", url_prefix).alias("url"),
        snippet(highlight(body, "terms")).alias("snippet"), "score")


def highlighted(results: DataFrame, store: DataFrame, queries: DataFrame) -> DataFrame:
    """TXT-17 over result documents: ``(query_id, doc_id, highlighted)``."""
    r = results.select("query_id", "doc_id")
    return (r.join(store.drop("shard"), "doc_id").join(term_lists(queries), "query_id")
            .select("query_id", "doc_id",
                    highlight(F.concat("title", "text"), "terms").alias("highlighted")))


def search_person(queries: DataFrame, postings: DataFrame, idf: DataFrame, store: DataFrame,
                  shard_limit: int | None = None, limit: int = RESULT_LIMIT,
                  url_prefix: str = URL_PREFIX, maxima: DataFrame | None = None) -> DataFrame:
    """TXT-16: ``(query_id, rank, doc_id, title, url, actors, directors, writers,
    snippet, score)``.  A candidate is kept when a query term occurs in one of
    its person fields; those fields come back highlighted, the snippet is the
    leading part of title+text (TXT-19)."""
    def tested(terms):
        return any_term_in("actors", terms) | any_term_in("directors", terms) | any_term_in("writer", terms)
    top = block_max_top(queries, postings, idf, store, tested, "in_people", shard_limit, limit, maxima)
    return _fetched(top, store, queries).select(
        "query_id", "rank", "doc_id", "title", result_url("doc_id", url_prefix).alias("url"),
        highlight("actors", "terms").alias("actors"), highlight("directors", "terms").alias("directors"),
        highlight("writer", "terms").alias("writers"),
        leading_snippet(F.concat("title", "text")).alias("snippet"), "score")


def search_json(queries: DataFrame, results: DataFrame, person: bool = False) -> DataFrame:
    """SNK-6: ``(query_id, json)`` with ``{"num_results": n, "results": [...]}``.

    Every query gets an envelope (0 results included); a result list is at
    most ``limit`` long, so the per-query collect is bounded.
    """
    fields = [F.col("doc_id").alias("imdbID"), "title", "url", "snippet"]
    if person:
        fields += [F.col("actors").alias("Actors"), F.col("directors").alias("Directors"),
                   F.col("writers").alias("Writers")]
    item = F.when(F.col("doc_id").isNotNull(), F.struct(F.col("rank"), F.struct(*fields).alias("r")))
    per_q = (queries.select("query_id").join(results, "query_id", "left")
             .groupBy("query_id").agg(F.sort_array(F.collect_list(item)).alias("_l")))
    res = F.transform("_l", lambda x: x["r"])
    return per_q.select("query_id", F.to_json(F.struct(F.size("_l").alias("num_results"),
                                                       res.alias("results"))).alias("json"))
