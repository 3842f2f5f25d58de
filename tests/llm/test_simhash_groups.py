"""One row of each group is kept where ids are null or repeated."""

from tessera.llm import simhash_dedup as S

TEXTS = ["a red fox ran over the long wooden bridge at night", "seven old sailors counted all their copper coins twice",
         "the mill wheel stood still since water froze in the brook", "her letters came by boat and smelled of salt and tar"]


def kept(spark, rows):
    return sorted(((r.doc_id, r.text) for r in S.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)


def test_unrelated_texts_without_ids_stay(spark):
    rows = [(None, t) for t in TEXTS[:3]] + [(5, TEXTS[3])]
    assert kept(spark, rows) == sorted(rows, key=str)


def test_one_id_with_two_texts_keeps_both(spark):
    rows = [(1, TEXTS[0]), (1, TEXTS[1]), (2, TEXTS[2])]
    assert kept(spark, rows) == sorted(rows, key=str)


def test_null_id_comes_last_in_a_group_of_several_fingerprints(spark):
    one = " ".join(f"w{i}" for i in range(400))
    near = one.replace("w399", "other")
    a, b = S.fingerprint(one), S.fingerprint(near)
    assert 0 < (a ^ b).bit_count() <= S.BITS
    assert kept(spark, [(None, one), (7, near)]) == [(7, near)]
    assert kept(spark, [(7, one), (None, near)]) == [(7, one)]
