"""Inverted index, IDF maps and document store (TXT-4..9, AGG-13..15, SNK-2..4).

Input: a docs DataFrame ``(doc_id, title, text, actors, directors, writer)``.
Title and text are lower-cased before tokenizing; people names keep their
case, so "Cage" finds a person and "hill" finds a plot.

Every aggregate is keyed so that map-side partial aggregation collapses the
work before the shuffle: ``(doc_id, term)`` counts leave each map task
already complete for its documents, and document frequencies of common
terms ("the") are pre-summed per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import shard_of
from tessera.functions.text import people_text, person_list, tokenize
from tessera.session import written

N_INDEX_SHARDS = 3
N_DOC_SHARDS = 1
#: Documents of a block of the index, about.
BLOCK_DOCS = 64
#: Blocks of a length class are numbered below it.
CLASS_BLOCKS = 1 << 40


def _content_tokens(docs: DataFrame):
    return F.concat(tokenize(F.lower("title")), tokenize(F.lower("text")))


def doc_terms(docs: DataFrame, with_people: bool = True, spread: int | None = None) -> DataFrame:
    """``(doc_id, term, tf, in_content, in_people, tokens)`` from ONE tokenization pass.

    ``tf`` counts title + text (+ people) occurrences; ``in_content`` says
    the term occurs in the title or text (the IDF vocabulary), ``in_people`` in a
    person field; ``tokens`` is the document's number of tokens.  Postings, document frequencies and the document count all
    derive from this table.  ``spread`` deals the documents by id into that many
    partitions first: the terms of a document are then counted where they lie, so
    texts are shuffled and not their terms, and a task's counts are bounded by its
    share of the documents.
    """
    content = F.transform(_content_tokens(docs), lambda t: F.struct(t.alias("t"), F.lit(1).alias("c")))
    toks = content
    if with_people:
        people = F.transform(tokenize(people_text()),
                             lambda t: F.struct(t.alias("t"), F.lit(0).alias("c")))
        toks = F.concat(content, people)
    rows = docs if spread is None else docs.repartition(spread, "doc_id")
    rows = rows.select("doc_id", toks.alias("_toks")).select("doc_id", F.size("_toks").alias("_n"), F.explode("_toks").alias("x"))
    return (rows.groupBy("doc_id", F.col("x.t").alias("term"))
            .agg(F.count(F.lit(1)).alias("tf"), F.max("x.c").alias("in_content"), (1 - F.min("x.c")).alias("in_people"),
                 F.max("_n").alias("tokens")))


def term_frequencies(docs: DataFrame, with_people: bool = True, spread: int | None = None) -> DataFrame:
    """TXT-4 / AGG-13: ``(doc_id, term, tf)`` over title + text (+ people); ``spread`` as in :func:`doc_terms`."""
    toks = _content_tokens(docs)
    if with_people:
        toks = F.concat(toks, tokenize(people_text()))
    rows = docs if spread is None else docs.repartition(spread, "doc_id")
    return (rows.select("doc_id", F.explode(toks).alias("term"))
            .groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf")))


def with_blocks(dt: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Adds ``block``: documents of like length (half an octave), about ``block_docs`` of them.

    Long documents hold the high frequencies, so maxima over a block follow its
    documents closely.  Only the number of documents in each length class (at
    most about 60 rows) reaches the driver; it decides the size of blocks alone,
    so an estimate will do.
    """
    size = F.floor(2 * F.log2("tokens")).cast("long")
    counted = dt.groupBy(size.alias("c")).agg(F.approx_count_distinct("doc_id").alias("n")).collect()
    blocks = F.lit(1)
    for r in sorted(counted):
        blocks = F.when(size == r.c, F.lit(-(-r.n // block_docs))).otherwise(blocks)
    return dt.withColumn("block", size * F.lit(CLASS_BLOCKS) + F.pmod(F.xxhash64("doc_id"), blocks.cast("long")))


def block_maxima(post: DataFrame) -> DataFrame:
    """``(term, block, max_tf)``: the most a block's documents hold of a term."""
    return post.groupBy("term", "block").agg(F.max("tf").alias("max_tf"))


def postings_from_terms(dt: DataFrame, n_shards: int = N_INDEX_SHARDS) -> DataFrame:
    extra = [c for c in ("block", "in_content", "in_people") if c in dt.columns]
    return dt.select(shard_of("doc_id", n_shards).cast("int").alias("shard"),
                     "term", "doc_id", "tf", *extra)


def postings(docs: DataFrame, n_shards: int = N_INDEX_SHARDS, spread: int | None = None) -> DataFrame:
    """TXT-5: ``(shard, term, doc_id, tf)``; shard = doc_id mod n (PART-2)."""
    return postings_from_terms(term_frequencies(docs, spread=spread), n_shards)


def postings_lists(post: DataFrame, block_width: int = 100_000) -> DataFrame:
    """AGG-14: nested form ``(shard, term, block, postings array<struct<doc_id, tf>>)``.

    A term's list is cut into blocks of doc-id ranges ``block_width`` wide;
    ids are unique, so no list holds more than ``block_width`` entries however
    common the term is.  For lookups the long form is preferred.
    """
    return (post.withColumn("block", F.floor(F.col("doc_id") / F.lit(block_width)))
            .groupBy("shard", "term", "block")
            .agg(F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings")))


def document_frequencies(dt: DataFrame) -> DataFrame:
    """AGG-15: ``(term, df)`` over title + text; people are not counted."""
    return (dt.where(F.col("in_content") == 1)
            .groupBy("term").agg(F.count(F.lit(1)).alias("df")))


def idf_from_terms(dt: DataFrame, smooth: bool = False, docs: DataFrame | None = None) -> DataFrame:
    """TXT-6 / TXT-7 over a (checkpointed) doc-terms table.

    smooth=False: idf = ln(N / df), N = documents with a title or text token.
    smooth=True (legacy map): idf = ln((N + 1) / df), N = all ``docs``.
    """
    if smooth:
        n = docs.select(F.count(F.lit(1)).cast("double") + F.lit(1.0)).scalar()
    else:
        n = (dt.where(F.col("in_content") == 1)
             .select(F.countDistinct("doc_id").cast("double")).scalar())
    return document_frequencies(dt).select("term", "df", F.log(n / F.col("df")).alias("idf"))


def idf(docs: DataFrame, smooth: bool = False, spread: int | None = None) -> DataFrame:
    """TXT-6 / TXT-7 from documents: content terms tokenized once, lineage
    written because both df and N read them."""
    dt = written(doc_terms(docs, with_people=False, spread=spread).select("doc_id", "term", "in_content"), "doc-terms")
    return idf_from_terms(dt, smooth, docs)


def build_index(docs: DataFrame, n_shards: int = N_INDEX_SHARDS,
                n_doc_shards: int = N_DOC_SHARDS, spread: int | None = None):
    """TXT-5 + TXT-6 + TXT-8: ``(postings, idf, docstore)`` from one
    tokenization pass over the corpus (a written doc-terms table).  The postings
    carry their block and where the term stands, for block-max search."""
    dt = written(doc_terms(docs, with_people=True, spread=spread), "doc-terms")
    return postings_from_terms(with_blocks(dt), n_shards), idf_from_terms(dt), docstore(docs, n_doc_shards)


def docstore(docs: DataFrame, n_shards: int = N_DOC_SHARDS) -> DataFrame:
    """TXT-8: lower-cased title and text, ' ; '-terminated people, bare writer."""
    return docs.select(
        shard_of("doc_id", n_shards).cast("int").alias("shard"), "doc_id",
        F.lower("title").alias("title"), F.lower("text").alias("text"),
        person_list("actors").alias("actors"), person_list("directors").alias("directors"),
        F.coalesce("writer", F.lit("")).alias("writer"))


def keep_last(rows: DataFrame, key: str, order: str) -> DataFrame:
    """AGG-19: of the rows of each ``key``, the one with the greatest ``order``
    (then the greatest other columns), pre-aggregated before the shuffle."""
    rest = [c for c in rows.columns if c not in (key, order)]
    last = rows.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("_last"))
    return last.select(key, *[F.col("_last")[c].alias(c) for c in (order, *rest)])


def legacy_docstore(docs: DataFrame, url_prefix: str) -> DataFrame:
    """TXT-9: original-case title, result URL and original text."""
    from tessera.operators.search import result_url
    return docs.select("doc_id", "title", result_url("doc_id", url_prefix).alias("url"), "text")


def write_index(post: DataFrame, idf_df: DataFrame, store: DataFrame, path: str) -> None:
    """SNK-2..4: postings and doc store partitioned by shard, IDF map alongside.

    Postings are range-partitioned on (shard, term) -- many files per shard,
    each covering a term range -- so Parquet min/max statistics prune files
    and row groups for term lookups.  ``doc_id`` is part of the range key, so
    the postings of a very frequent term spread over several files.  Block
    maxima lie beside them, a row for each term and block.
    """
    (post.repartitionByRange("shard", "term", "doc_id").sortWithinPartitions("shard", "term", "doc_id")
     .write.mode("overwrite").partitionBy("shard").parquet(f"{path}/postings"))
    if "block" in post.columns:
        (block_maxima(post).repartitionByRange("term", "block").sortWithinPartitions("term", "block")
         .write.mode("overwrite").parquet(f"{path}/maxima"))
    idf_df.write.mode("overwrite").parquet(f"{path}/idf")
    store.write.mode("overwrite").partitionBy("shard").parquet(f"{path}/docstore")


def read_maxima(spark, path: str) -> DataFrame:
    """Block maxima of an index that :func:`write_index` wrote."""
    return spark.read.parquet(f"{path}/maxima")


def read_index(spark, path: str):
    return (spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/idf"),
            spark.read.parquet(f"{path}/docstore"))
