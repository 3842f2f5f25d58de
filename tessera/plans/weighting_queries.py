"""Named queries for stop-word stripping and title-boosted TF-IDF (step 8)."""

from __future__ import annotations

from tessera.functions.stopwords import STOP_WORDS_EN, WHITESPACE
from tessera.functions.text import TOKEN_PATTERN
from tessera.operators import weighting as WT
from tessera.plans import oracle as O
from tessera.plans.queries import register, rnd
from tessera.plans.text_queries import _spread
from tessera.sources import bindings as B
from tessera.sources.tables import table

STOPS_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS_EN) + "]"

O.define("btf", ("docs",), f"""
    SELECT doc_id, term, COUNT(*) AS tf FROM (
        SELECT doc_id, unnest(list_filter(
            regexp_extract_all(lower(concat_ws(' ', title, title, title, title, text)), '{TOKEN_PATTERN}', 1),
            lambda t: NOT list_contains({STOPS_SQL}, t))) AS term
        FROM docs) x
    GROUP BY doc_id, term""")
O.define("bw", ("btf", "docs"), """
    SELECT b.doc_id, b.term, b.tf * i.idf AS w
    FROM btf b JOIN (SELECT term, ln((1 + CAST((SELECT COUNT(*) FROM docs) AS DOUBLE)) / (COUNT(*) + 1)) + 1 AS idf
                     FROM btf GROUP BY term) i ON b.term = i.term""")


@register("tfidf_boosted", O.with_ctes(
    "SELECT doc_id, term, round(w / sqrt(SUM(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM bw",
    "bw"))
def q_tfidf_boosted(spark, sf):
    v = WT.boosted_tfidf(B.docs(spark, sf, with_credits=False, spread=_spread(spark, sf)))
    return v.select("doc_id", "term", rnd("weight").alias("weight"))


@register("stopword_strip", f"""
SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(text, '{WHITESPACE}'),
           lambda w: length(w) > 0 AND NOT list_contains({STOPS_SQL}, w)), ' ') AS synopsis
FROM documents""")
def q_stopword_strip(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return WT.strip_stop_words(d).select("doc_id", "synopsis")
