"""Terms are counted where their document lies: its text is shuffled once, by id."""
import re

import pytest

from tessera.operators import index as IX, weighting as WT
from tests.conftest import rows

SCHEMA = "doc_id long, title string, text string, actors array<string>, directors array<string>, writer string"


@pytest.fixture(scope="module")
def docs(spark):
    data = [(i % 40, f"title {i % 3}", f"red green w{i} green", ["Nic Cage"], ["Ann Lee"], "Bo") for i in range(60)]
    return spark.createDataFrame(data + [(None, None, "red", None, None, None), (7, "x", None, None, None, None)], SCHEMA)


@pytest.mark.parametrize("count", [
    lambda d, n: IX.term_frequencies(d, spread=n), lambda d, n: IX.doc_terms(d, spread=n), lambda d, n: IX.postings(d, spread=n)])
def test_one_exchange_by_document(docs, count):
    plan = count(docs, 6)._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Exchange hashpartitioning\((\w+)#", plan) == ["doc_id"] and plan.count("Exchange ") == 1


def test_same_rows_with_and_without(docs):
    key = lambda r: tuple(str(x) for x in r)
    for count in (IX.term_frequencies, IX.doc_terms):
        got, want = count(docs, spread=6).collect(), count(docs).collect()
        assert sorted(got, key=key) == sorted(want, key=key)
    keyed = docs.where("doc_id IS NOT NULL")
    got, want = (rows(WT.boosted_tfidf(keyed, spread=n).selectExpr("doc_id", "term", "round(weight, 12) AS w")) for n in (6, None))
    assert got == want


def test_queries_spread_with_the_table(monkeypatch, spark):
    from tessera.plans import text_queries as T
    monkeypatch.setattr(T, "estimated_bytes", lambda df: 1000 * T.SPREAD_BYTES)
    assert T._spread(spark, "/root/testdata/sf0.001") == 1000


def test_texts_of_a_query_are_shuffled_once(spark):
    """Documents meet their part and credits where their terms are counted; no text is sorted."""
    from tessera.sources import bindings as B
    d = B.docs(spark, "/root/testdata/sf0.001", with_credits=False, spread=6)
    plan = IX.doc_terms(d)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 2 and "ShuffledHashJoin" in plan and "Sort " not in plan
    whole = B.docs(spark, "/root/testdata/sf0.001", spread=6)
    plan = IX.doc_terms(whole)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 3 and "Sort " not in plan
    assert rows(whole) == rows(B.docs(spark, "/root/testdata/sf0.001"))
