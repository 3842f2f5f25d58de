"""Identifiers of other types, clashing columns, many equal rows, null and empty texts."""

import random

import corpus_pipeline as C
from tessera.llm import decontaminate as D, phrase_dedup as P, simhash_dedup as S, toxicity as T
from tests.conftest import SF001


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(n))


def test_phrases_of_string_ids_equal_those_of_integers(spark):
    shared = words(1, 60)
    rows = [(i, f"{words(i + 10, 30)} {shared if i % 3 == 0 else ''} {words(i + 99, 30)}") for i in range(100, 130)]
    rows += [(None, shared), (131, None)]
    number = spark.createDataFrame(rows, "doc_id long, text string")
    by_number = {str(r.doc_id): tuple(r)[1:] for r in P.phrase_report(number).collect()}
    text = number.selectExpr("cast(doc_id AS string) AS doc_id", "text")
    assert {str(r.doc_id): tuple(r)[1:] for r in P.phrase_report(text).collect()} == by_number
    assert by_number["None"][1] == 0 and by_number["102"][1] == 60      # a null id comes first


def test_thousands_of_equal_rows_keep_short_phrase_lists(spark):
    text = words(7, 120)
    docs = spark.range(5000).selectExpr("5L AS doc_id", f"'{text}' AS text").unionByName(
        spark.createDataFrame([(6, text), (7, words(8, 120))], "doc_id long, text string"))
    removed = [(r.doc_id, r.n_removed) for r in P.phrase_report(docs).select("doc_id", "n_removed").distinct().collect()]
    assert sorted(removed) == [(5, 0), (6, 120), (7, 0)]
    assert sorted(r.doc_id for r in S.keep_one(docs).collect()) == [5, 7]


def test_toxicity_with_string_ids(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    named = lambda df: df.withColumn("doc_id", df["doc_id"].cast("string"))
    plain = T.score(docs, T.fit(docs, T.training_labels(labels))).collect()
    index = T.fit(named(docs), T.training_labels(named(labels)))
    assert sorted((str(r.doc_id), r.score, [str(e) for e in r.evidence]) for r in plain) == \
        sorted((r.doc_id, r.score, list(r.evidence)) for r in T.score(named(docs), index).collect())
    assert T.keep_clean(named(docs), index).count() == sum(not r.predicted for r in plain)


def test_rows_with_a_column_named_like_the_key(spark):
    bench = spark.createDataFrame([(1, words(3, 30))], "item_id long, text string")
    docs = spark.createDataFrame([(1, words(4, 40), 9, "a"), (2, words(3, 30) + " end", 9, "b"), (3, None, 9, "c")],
                                 "doc_id long, text string, _rid int, doc string")
    left = D.keep_uncontaminated(docs, bench, literal=True)
    assert left.columns == docs.columns and sorted((r.doc_id, r._rid, r.doc) for r in left.collect()) == [(1, 9, "a"), (3, 9, "c")]


def test_stages_take_nulls_extra_columns_and_empty_tables(spark):
    schema = "doc_id long, text string, rid string, _rid int, spans int, score double"
    rows = [(None, words(1, 80), "r", 1, 2, 0.5), (1, None, None, 1, 2, 0.5), (2, "", "r", None, 2, 0.5), (3, words(2, 80), "r", 1, None, 0.5),
            (4, words(2, 80), "s", 1, 2, None), (4, words(5, 4000), "t", 1, 2, None)]
    for data, ids in ((rows, [None, 1, 3, 4]), ([], [])):
        docs = spark.createDataFrame(data, schema)
        for name, stage in C.STAGES[:-1]:
            out = stage(spark, docs, SF001)
            assert out.columns == docs.columns, name
            docs = spark.createDataFrame(out.collect(), schema)
        done = C.STAGES[-1][1](spark, docs, SF001)
        # null and empty texts have one fingerprint, rows 3 and 4 another
        assert sorted((r.doc_id for r in done.collect()), key=lambda d: (d is not None, d)) == ids
        assert set(docs.columns) - {"text"} <= set(done.columns)
