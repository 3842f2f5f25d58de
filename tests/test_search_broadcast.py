"""Result lists and queries are broadcast by their rows, not by the size of a compressed file."""
import pytest

from tessera.operators import search as SR
from tessera.session import written


@pytest.mark.parametrize("limit,hints", [(100, 2), (10, 0)])
def test_many_results_are_not_broadcast(spark, monkeypatch, limit, hints):
    monkeypatch.setattr(SR, "BROADCAST_TERMS", limit)
    queries = written(spark.range(50).selectExpr("id AS query_id", "'a b' AS q"), "t-queries")
    top = written(spark.range(50).selectExpr("id AS query_id", "id AS doc_id", "1L AS rank"), "t-top")
    store = spark.range(60).selectExpr("0 AS shard", "id AS doc_id", "'t' AS title")
    got = SR._fetched(top, store, queries)
    assert got._jdf.queryExecution().analyzed().toString().count("ResolvedHint") == hints
    assert got.count() == 50


def test_at_most_100000_rows_are_broadcast(spark):
    few, many = (SR._counted(spark.range(n))._jdf.queryExecution().analyzed().toString() for n in (1000, 300_000))
    assert "ResolvedHint" in few and "ResolvedHint" not in many
