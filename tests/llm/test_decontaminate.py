import random
import re
import unicodedata
from collections import defaultdict

from pyspark.sql import functions as F

from tessera.llm import decontaminate as D


def slow_tokens(text):
    """[(type, value)] by walking the text's characters."""
    text = (text or "").replace(D.NAME, "")
    letter = lambda c: unicodedata.category(c).startswith("L")
    digit = lambda c: unicodedata.category(c) == "Nd"
    out, i = [], 0
    while i < len(text):
        m = re.compile(r"[$€£]?\d+(?:[.,:/]\d+)*%?").match(text, i)
        if m:
            out.append(("#", m[0]))
            i = m.end()
        elif letter(text[i]):
            j = i + 1
            while j < len(text) and (letter(text[j]) or unicodedata.category(text[j]).startswith("M")):
                j += 1
            name = (unicodedata.category(text[i]) == "Lu" and i >= 2 and text[i - 1] in " \t\n\x0b\x0c\r"
                    and (letter(text[i - 2]) or digit(text[i - 2]) or text[i - 2] in ",;") and i + 1 < len(text) and unicodedata.category(text[i + 1]) == "Ll")
            word = text[i:j].lower()
            if name:
                out.append(("@", word))
            elif word in D.UNITS and out and out[-1][0] == "#":
                out.append(("~", word))
            else:
                out.append((word, word))
            i = j
        else:
            i += 1
    return out


def slow(docs, bench, width=8, cover=12, literals=4):
    index = defaultdict(set)
    items = {}
    for item, text in bench:
        toks = slow_tokens(text)
        items[item] = toks
        for p in range(len(toks) - width + 1):
            w = tuple(t for t, _ in toks[p:p + width])
            if sum(t not in "#@~" for t in w) >= literals:
                index[w].add((item, p))
    out = set()
    for doc, text in docs:
        toks = slow_tokens(text)
        found = defaultdict(set)
        for p in range(len(toks) - width + 1):
            for item, b in index.get(tuple(t for t, _ in toks[p:p + width]), ()):
                found[item, p - b].update(range(b, b + width))
        for (item, shift), at in found.items():
            if len(at) < min(cover, len(items[item])):
                continue
            pairs = {(items[item][b][1], toks[b + shift][1]) for b in at if items[item][b][0] in "#@~"}
            if len({a for a, _ in pairs}) == len(pairs):
                out.add((doc, item))
    return out


FILL = "we counted every red apple and then gave away those that were left in the old basket near a wide green door".split()


def made():
    r = random.Random(4)
    word = lambda: r.choice(FILL) + r.choice(["", "s", "ing", "ed"])
    text = lambda n: " ".join(word() for _ in range(n))
    bench = [(i, text(r.randint(9, 30))) for i in range(12)]
    bench += [(20, "Yesterday the farmer Alice bought 12 apples and 30 km of rope, and Alice paid $4.50 for 12 of them today."),
              (21, "short one here"), (22, None), (23, ""), (24, "exactly eight plain words stand in here now"), (25, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15")]
    docs = [(i, text(r.randint(0, 200))) for i in range(40)]
    docs += [(100 + i, f"{text(9)}. {t} {text(5)}") for i, t in bench if t]
    docs += [
        (200, "Yesterday the farmer Bruno bought 7 apples and 99 miles of rope, and Bruno paid £3 for 7 of them today."),
        (201, "Yesterday the farmer Bruno bought 7 apples and 99 miles of rope, and Clara paid £3 for 8 of them today."),  # slots disagree
        (202, text(4) + "\n\n" + bench[3][1].upper() + "!"), (203, bench[4][1].replace(" ", " | ")), (204, None), (205, ""),
        (206, " ".join(bench[5][1].split()[:-2])), (207, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15"), (200, "Yesterday the farmer Bruno bought"),
        (208, text(20_000) + " " + bench[6][1]), (209, "nothing " + D.NAME + "here")]
    return docs, bench


def test_tokens(spark):
    rows = [(t,) for t in ["He met Ann, Bob; Cy. Dan $5.50 and 3,000 km 10% é Éa", "", None, "a\nB Cd 5km 5 km", "x1y2 1:30 p.m.", "€5 ok", "éA é"]]
    df = spark.createDataFrame(rows, "t string")
    got = df.select("t", D.tokens(F.col("t")).alias("a")).select("t", "a", D.template(F.col("a")).alias("b")).collect()
    for r in got:
        assert [(b, a.replace(D.NAME, "").lower()) for a, b in zip(r.a, r.b)] == slow_tokens(r.t)


def test_equals_brute_force(spark):
    docs, bench = made()
    df = spark.createDataFrame([(*d, "s", 1) for d in docs], "doc_id long, text string, item_id string, h int")
    out = D.find_leaks(df.drop("h"), spark.createDataFrame(bench, "item_id long, text string"))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    rows = out.collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    assert got == slow(docs, bench)
    assert {(200, 20), (120, 20), (202, 3), (203, 4), (208, 6)} <= got and (201, 20) not in got and not [g for g in got if g[0] == 207]
    assert {r.reworded for r in rows if (r.doc_id, r.item_id) == (200, 20)} == {True}
    kept = D.keep_uncontaminated(df, spark.createDataFrame(bench, "item_id long, text string"))
    assert kept.columns == df.columns
    bad = {g[0] for g in got}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, t in docs if not (d in bad and (d, t) != docs[-3]))


def test_shuffle_join_gives_the_same(spark, monkeypatch):
    docs, bench = made()
    monkeypatch.setattr(D, "BROADCAST_WINDOWS", 0)
    out = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in out.collect()} == slow(docs, bench)


def test_empty(spark):
    docs, bench = (spark.createDataFrame([], f"{c} long, text string") for c in ("doc_id", "item_id"))
    assert D.find_leaks(docs, bench).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert D.keep_uncontaminated(one, bench).count() == 1
