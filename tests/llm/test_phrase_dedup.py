import hashlib
import random
import re

import pytest

from tessera.llm.phrase_dedup import phrase_report


def brute(rows, length):
    first = {}
    split = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, (_, t) in enumerate(rows)}
    for i, (doc_id, _) in enumerate(rows):
        for p in range(len(split[i]) - length + 1):
            key = tuple(split[i][p:p + length])
            place = (-1 if doc_id is None else doc_id, p)
            first[key] = min(first.get(key, place), place)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        keep = [True] * len(split[i])
        for p in range(len(keep) - length + 1):
            if first[tuple(split[i][p:p + length])] != (-1 if doc_id is None else doc_id, p):
                keep[p:p + length] = [False] * length
        kept = [w for w, k in zip(split[i], keep) if k]
        out.append((doc_id, len(keep), len(keep) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed, n=60):
    r = random.Random(seed)
    word = lambda: r.choice(["a", "bé", "c", "dd", "e.", " x", "日本"]) + r.choice(["", "1", "2", "33"])
    text = lambda k: [word() for _ in range(k)]
    shared = [text(60) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = text(r.randint(0, 40))
        for _ in range(r.randint(0, 3)):
            s = r.choice(shared)
            a = r.randint(0, 30)
            at = r.randint(0, len(parts))
            parts[at:at] = s[a:a + r.randint(10, 45)]
        rows.append((i, "".join(w + r.choice([" ", "\n", " \t", "\x0b"]) for w in parts)))
    rows += [(n, rows[3][1]), (n + 1, None), (n + 2, ""), (n + 3, "x " * 90), (n + 4, "x y " * 40), (-5, rows[4][1]),
             (None, rows[5][1]), (6, rows[6][1])]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("length,gram", [(20, 6), (8, 3)])
def test_equals_brute_force(spark, seed, length, gram):
    rows = made(seed)
    got = phrase_report(spark.createDataFrame(rows, "doc_id long, text string"), length, gram)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, length)


def test_many_shards_and_salts(spark, monkeypatch):
    import tessera.llm.phrase_dedup as P
    monkeypatch.setattr(P, "SHARD_PHRASES", 7)
    monkeypatch.setattr(P, "SALT_BYTES", 300)
    rows = made(3)
    got = phrase_report(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 20)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, rid string")
    assert phrase_report(df).count() == 0
    one = spark.createDataFrame([(1, "short text")], "doc_id long, text string")
    assert phrase_report(one, keep_text=True).collect()[0].kept_text == "short text"
