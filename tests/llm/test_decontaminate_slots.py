"""Copies with one slot that disagrees."""

from tessera.llm import decontaminate as D

HEAD = "in the old market the farmer told Alice that every basket of green apples had been sold before noon"
TAIL = "so the children walked home along the river and later thanked Alice for it"


def found(spark, docs, bench, **more):
    out = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                       spark.createDataFrame(bench, "item_id long, text string"), **more)
    return {(r.doc_id, r.item_id): r for r in out.collect()}


def test_disagreeing_slot_drops_its_windows_only(spark):
    docs = [(1, f"{HEAD}, {TAIL}"), (2, f"{HEAD}, {TAIL}".replace("thanked Alice", "thanked Bruno")),
            (3, "so Alice sold 5 big apples and then Clara sold 6 big apples to him")]
    bench = [(7, f"{HEAD}, {TAIL}"), (8, "so Alice sold 5 big apples and then Alice sold 5 big apples to him")]
    got = found(spark, docs, bench)
    assert set(got) == {(1, 7), (2, 7)}
    assert got[1, 7].n_covered == got[1, 7].n_tokens > got[2, 7].n_covered >= D.MIN_COVERED
