import json
import math

from pyspark.sql import functions as F

from tessera.functions import text as TX
from tessera.operators import index as IX, search as SR, weighting as WT

DOCS = [
    (1, "Été Hill", "the naïve hill climbs into the ring " * 3,
     ["Nicolas Cage", "Ann Ring"], ["Dee Dir"], "Bob Writer"),
    (2, "c++ story", "a tale about c++ and the hills of the valley. " * 20,
     ["Zed Actor"], [], "Cage Smith"),
    (3, "Plain", "the end", [], ["Nicolas Cage"], ""),
    (10, "Hill top", "short hill text with the word", ["Amy"], [], "W"),
]
SCHEMA = "doc_id long, title string, text string, actors array<string>, directors array<string>, writer string"


def _docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


def test_tokenizer_is_unicode_word_runs(spark):
    df = spark.createDataFrame([("Été naïve c++ l'eau x_1 Straße",)], "t string")
    assert df.select(TX.tokenize("t")).first()[0] == ["Été", "naïve", "c", "l", "eau", "x_1", "Straße"]


def test_highlight_keeps_neighbours_and_escapes(spark):
    df = spark.createDataFrame([("Ring of rings c++ (x)", ["ring", "c++", "", "(x)"])],
                               "t string, q array<string>")
    assert df.select(TX.highlight("t", "q")).first()[0] == (
        "<strong>Ring</strong> of <strong>ring</strong>s <strong>c++</strong> <strong>(x)</strong>")


def test_snippets(spark):
    long = "word " * 30 + "target " + "filler " * 100
    df = spark.createDataFrame([(long, "short text target")], "a string, b string")
    h = TX.highlight("a", F.array(F.lit("target")))
    s, lead, short = df.select(TX.snippet(h), TX.leading_snippet("a"),
                               TX.snippet(TX.highlight("b", F.array(F.lit("target"))))).first()
    assert s.startswith("... ") and s.endswith(" ...") and "<strong>target</strong>" in s
    assert short == "short text <strong>target</strong>"
    assert lead.endswith(" ...") and len(lead) <= 400 + len(" ...") + 10


def test_index_and_idf(spark):
    docs = _docs(spark)
    post, idf, store = IX.build_index(docs)
    idfs = {r.term: (r.df, r.idf) for r in idf.collect()}
    assert idfs["the"] == (4, 0.0)                 # a term in every document has idf 0
    assert idfs["hill"][0] == 2 and abs(idfs["hill"][1] - math.log(4 / 2)) < 1e-12
    assert "Cage" not in idfs                      # people are not in the IDF map
    shards = {(r.doc_id, r.shard) for r in post.collect()}
    assert (10, 1) in shards and (3, 0) in shards
    tf = {(r.doc_id, r.term): r.tf for r in post.collect()}
    assert tf[(1, "hill")] == 4 and tf[(1, "Cage")] == 1
    assert store.where("doc_id = 1").first().actors == "Nicolas Cage ; Ann Ring ; "
    assert IX.idf(docs, smooth=True).where("term = 'end'").first().idf > 0


def test_search_plot_and_person(spark):
    docs = _docs(spark)
    post, idf, store = IX.build_index(docs)
    q = spark.createDataFrame([(1, "hill"), (2, "Cage"), (3, "nothing")], "query_id long, q string")
    plot = SR.search_plot(q, post, idf, store)
    got = [(r.query_id, r.rank, r.doc_id) for r in plot.orderBy("query_id", "rank").collect()]
    assert [g for g in got if g[0] == 1][0][2] == 1          # tf 4 beats the others
    assert {g[2] for g in got if g[0] == 1} == {1, 10}        # "hills" is another token
    person = SR.search_person(q, post, idf, store).where("query_id = 2").orderBy("rank").collect()
    # person-only term: every score is 0, so doc_id descending
    assert [r.doc_id for r in person] == [3, 2, 1]
    assert all(r.score == 0 for r in person)
    assert "<strong>Cage</strong>" in person[2].actors
    env = {r.query_id: json.loads(r.json) for r in SR.search_json(q, plot).collect()}
    assert env[3] == {"num_results": 0, "results": []}
    assert env[1]["num_results"] == 2 and env[1]["results"][0]["imdbID"] == 1


def test_stopwords_and_boosted_tfidf(spark):
    from pyspark.ml.feature import StopWordsRemover
    from tessera.functions.stopwords import STOP_WORDS_EN
    assert list(STOP_WORDS_EN) == StopWordsRemover.loadDefaultStopWords("english")
    df = spark.createDataFrame([(1, "The cat and the hat  sat")], "doc_id long, text string")
    assert WT.strip_stop_words(df).first().synopsis == "The cat hat sat"
    v = WT.boosted_tfidf(_docs(spark))
    norms = v.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(abs(r.n - 1) < 1e-9 for r in norms)
    assert v.where("term = 'the'").count() == 0


def test_highlight_quotes_end_marks(spark):
    from tessera.functions.text import highlight
    df = spark.createDataFrame([("a\\Eb c", ["\\E", "C"])], "t string, terms array<string>")
    assert df.select(highlight("t", "terms")).first()[0] == "a<strong>\\E</strong>b <strong>c</strong>"


def test_found_filter_comes_before_the_shard_cut(spark):
    post = spark.createDataFrame([(0, "x", i, 100 - i) for i in range(60)], "shard int, term string, doc_id long, tf long")
    idf = spark.createDataFrame([("x", 1.0)], "term string, idf double")
    store = spark.createDataFrame([(0, i, "t", "has x" if i >= 40 else "none", "", "", "") for i in range(60)],
                                  "shard int, doc_id long, title string, text string, actors string, directors string, writer string")
    q = spark.createDataFrame([(1, "x")], "query_id long, q string")
    for cut in (None, 30):
        got = [r.doc_id for r in SR.search_plot(q, post, idf, store, shard_limit=cut).orderBy("rank").collect()]
        assert got == list(range(40, 50))
    assert SR.search_plot(q, post, idf, store, shard_limit=3).count() == 3


def test_scores_do_not_depend_on_how_the_terms_are_joined(spark):
    """One term in every document; broadcast and salted joins agree, and the
    broadcast form moves no postings by term."""
    from tessera.operators import search as SR
    post = spark.range(400).selectExpr("int(id % 3) shard", "'common' term", "id doc_id", "1 + id % 5 tf").union(
        spark.createDataFrame([(0, "rare", 3, 2)], "shard int, term string, doc_id long, tf long"))
    idf = spark.createDataFrame([("common", 0.5), ("rare", 3.0)], "term string, idf double")
    qs = spark.createDataFrame([(1, "common rare"), (2, "rare rare unseen"), (3, "common")], "query_id long, q string")
    probed, salted = SR.score(qs, post, idf), SR.score(qs, post, idf, broadcast_terms=0, salts=4)
    as_rows = lambda d: sorted((r.query_id, r.shard, r.doc_id, round(r.score, 9)) for r in d.collect())
    assert as_rows(probed) == as_rows(salted) and len(as_rows(probed)) == 801
    assert "hashpartitioning(term" not in probed._jdf.queryExecution().executedPlan().toString()
