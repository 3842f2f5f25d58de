"""Verbatim copies of items that templates leave out."""

import corpus_pipeline as C
from tessera.llm import decontaminate as D

BENCH = [(1, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15"), (2, "Who wrote this old book?"),
         (3, "on 3 May 1907 and 4 June 1911 and 5 July 1915 and 6 August 1919")]
DOCS = [(11, "count 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 now"), (12, "count 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 now"),
        (13, "he asked: WHO wrote this old book? nobody knew"), (14, "who wrote this old letter"),
        (15, f"born {BENCH[2][1]} there"), (16, "on 8 May 1807 and 9 June 1811 and 3 July 1815 and 2 August 1819"), (17, None)]


def test_query_and_pipeline_find_verbatim_copies(spark, tmp_path):
    spark.createDataFrame(DOCS, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = D.op2(spark, str(tmp_path))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r.doc_id, r.item_id): r for r in out.collect()}
    assert set(got) == {(11, 1), (12, 1), (13, 2), (15, 3)}
    assert got[11, 1].n_covered == 15 and got[13, 2].n_covered == got[13, 2].n_tokens == 5 and not got[11, 1].reworded
    kept = C.benchmark_leaks(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert {r.doc_id for r in kept.collect()} == {14, 16, 17}
