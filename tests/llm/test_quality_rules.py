import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tessera.llm import quality_rules as Q


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    tri = Counter(zip(words, words[1:], words[2:]))
    cover = {p + k for p, t in enumerate(zip(words, words[1:], words[2:])) if tri[t] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(cover))


def texts():
    r = random.Random(1)
    out = [None, "", " \n\t", "a", "a b", "a b c a b c", "x " * 70, "##%% <a>|b&", "l\n\nl\n l\nl", "é\x0b日本\x0c🙂 \xa0b\x00", "a\r\nb\r\nb\r\n"]
    for _ in range(60):
        out.append("".join(r.choice(["a", "bb", "é", "c#"]) + r.choice([" ", "\n", "  ", "\t"]) for _ in range(r.randint(0, 400))))
    return out + ["word%d " % i * 2 for i in range(3)] + [" ".join(f"w{i}" for i in range(30_000))]


def test_measures_equal_brute_force(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(3, "a", "y"), (None, "a b c", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bits string").select("doc_id", "text")
    got = Q.ledger(df).select("doc_id", "measures.*").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((d, *slow(t)) for d, t, _ in rows), key=str)
    assert "Python" not in Q.ledger(df)._jdf.queryExecution().executedPlan().toString()


def test_policies_and_ablation(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    book = Q.ledger(spark.createDataFrame(rows, "doc_id long, text string")).cache()
    m = {r.doc_id: r.bits for r in book.collect()}
    for policy, rules in Q.POLICIES.items():
        mask = Q.mask(rules)
        kept = {r.doc_id for r in book.where(Q.kept(F.col("bits"), policy)).collect()}
        assert kept == {d for d, b in m.items() if not b & mask}
        got = {r.rule: (r.n_failed, r.n_only) for r in Q.ablation(book, policy).collect()}
        for rule in rules:
            bit = Q.mask((rule,))
            assert got[rule] == (sum(1 for b in m.values() if b & bit), sum(1 for b in m.values() if b & mask == bit))


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([("a b", 1, "m")], "text string, bits int, measures string")
    assert Q.ledger(df).columns == ["measures", "bits"]
    assert Q.ledger(df.limit(0)).count() == 0
