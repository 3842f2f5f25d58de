"""Stop-word stripping and title-boosted TF-IDF vectors (TXT-10, TXT-21, FLT-7).

Both are long-form DataFrame jobs: no vocabulary is collected to the driver
(as ``CountVectorizer`` would), so the term space can be any size.
"""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.stopwords import STOP_WORDS_EN, WHITESPACE
from tessera.functions.text import tokenize
from tessera.session import written

TITLE_BOOST = 4
#: More frequent terms than this are never broadcast.
HOT_TERMS = 200_000


def whitespace_words(col) -> F.Column:
    """Words of ``str.split()``: split on runs of whitespace, empties dropped."""
    c = F.col(col) if isinstance(col, str) else col
    return F.filter(F.split(c, WHITESPACE, -1), lambda w: F.length(w) > 0)


def strip_stop_words(df: DataFrame, text: str = "text", out: str = "synopsis",
                     stop_words=STOP_WORDS_EN) -> DataFrame:
    """TXT-21 / FLT-7: drop stop words (case-sensitive) and re-join with spaces.

    Uses the JVM ``StopWordsRemover`` (hash-set lookup per token).
    """
    words = df.withColumn("_words", whitespace_words(text))
    remover = StopWordsRemover(inputCol="_words", outputCol="_kept",
                               stopWords=list(stop_words), caseSensitive=True)
    return remover.transform(words).withColumn(out, F.array_join("_kept", " ")) \
        .drop("_words", "_kept")


def with_idf(tf: DataFrame, idf: DataFrame, hot_terms: int = HOT_TERMS) -> DataFrame:
    """``tf`` rows (doc_id, term, tf) with the idf of their term (term, df, idf).

    A term that stands in more than one in ``hot_terms`` of all rows meets its idf by
    broadcast, so its rows stay where they are.  The df of all terms add up to the rows,
    so fewer than ``hot_terms`` terms are that frequent, whatever the corpus.  The rows of
    the others are shuffled by term; no term has more than that share of all rows there.
    """
    rows = tf.select(F.count(F.lit(1))).scalar()
    often = F.col("df") * hot_terms > rows
    hot = idf.where(often).select("term", F.col("idf").alias("_hot"))
    met = tf.join(F.broadcast(hot), "term", "left").select("doc_id", "term", "tf", "_hot")
    rare = met.where("_hot IS NULL").drop("_hot").join(idf.where(~often).select("term", "idf"), "term")
    return (met.where("_hot IS NOT NULL").withColumnRenamed("_hot", "idf")
            .unionByName(rare.select("doc_id", "term", "tf", "idf")))


def boosted_tfidf(docs: DataFrame, boost: int = TITLE_BOOST,
                  stop_words=STOP_WORDS_EN, hot_terms: int = HOT_TERMS, spread: int | None = None) -> DataFrame:
    """TXT-10: ``(doc_id, term, weight)`` of L2-normalised TF-IDF vectors.

    Text = title repeated ``boost`` times + text, lower-cased, tokenized,
    stop words removed; tf = raw count, idf = ln((1 + n) / (1 + df)) + 1
    (smoothed), weight = tf * idf / ||tf * idf||.  The counts and the idf are
    written once, so the corpus is tokenized once.  ``spread`` deals
    the documents by id into that many partitions, where their terms are counted.
    """
    body = F.concat_ws(" ", *([F.col("title")] * boost), F.col("text"))
    remover = StopWordsRemover(inputCol="_toks", outputCol="_kept",
                               stopWords=list(stop_words), caseSensitive=True)
    rows = docs if spread is None else docs.repartition(spread, "doc_id")
    kept = remover.transform(rows.select("doc_id", tokenize(F.lower(body)).alias("_toks")))
    tf = written(kept.select("doc_id", F.explode("_kept").alias("term"))
                     .groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf")), "boosted-terms")
    n = docs.select(F.count(F.lit(1)).cast("double")).scalar()
    idf = written(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
                      .select("term", "df", (F.log((F.lit(1.0) + n) / (F.col("df") + 1)) + 1).alias("idf")), "boosted-idf")
    w = with_idf(tf, idf, hot_terms).select("doc_id", "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("doc_id")))
    return w.select("doc_id", "term", (F.col("w") / norm).alias("weight"))
