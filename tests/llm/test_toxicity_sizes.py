"""Toxicity with production defaults on tables of few examples."""

from tessera.llm import toxicity as T
from tests.conftest import SF001

INSULTS = {"loser", "moron", "trash", "disgusting", "scum", "worthless", "pathetic", "clown", "idiot", "stupid"}


def test_few_examples_find_toxic_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    index = T.fit(docs, T.training_labels(spark.read.parquet(f"{SF001}/labels.parquet")))
    assert INSULTS & set(index.vocabulary)
    insulting = {r.doc_id for r in docs.collect() if len(INSULTS & set(T.WORD.findall((r.text or "").lower()))) >= 2}
    predicted = {r.doc_id for r in T.score(docs, index).collect() if r.predicted}
    assert len(insulting) >= 8 and len(insulting & predicted) >= 0.8 * len(insulting)


def test_every_term_and_all_documents_count(spark):
    docs = [(i, f"common {'vile' if i < 3 else 'kind'} word{chr(97 + i)}") for i in range(12)] + [(100 + i, "common rare rare") for i in range(8)]
    docs[0] = (0, "common vile rare")
    index = T.fit(spark.createDataFrame(docs, "doc_id long, text string"),
                  spark.createDataFrame([(i, int(i < 3)) for i in range(12)], "doc_id long, toxic int"))
    assert set(index.vocabulary) == {w for d, t in docs[:12] for w in t.split()}
    df, n = T.document_frequencies(spark.createDataFrame(docs, "doc_id long, text string"), index.vocabulary)
    assert n == 20 and df[index.vocabulary["rare"]] == 9 and df[index.vocabulary["common"]] == 20
    assert index.judge("you vile thing")[0] >= 0.5 > index.judge("a kind thing")[0]


def test_words_equal_the_pattern():
    texts = ["", "A b-C d_e 9f", "Ünder éa b İstanbul Kelvin x y", "ΑΣ'Α ΟΔΟΣ tail", "日本語 text, текст Δ2δ it's", "a\x1cb\x00c\u0085d e"]
    for t in texts:
        assert sorted(T.words(t)) == sorted(T.WORD.findall(t.lower()))
