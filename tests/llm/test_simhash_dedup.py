import random
import re
from collections import defaultdict

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import simhash_dedup as S
from tessera.llm.components import connected_components


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@settings(max_examples=80, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="aB É\t\nİ\x0b\xa0", max_size=60)))
def test_fingerprint(text):
    assert S.fingerprint(text) == slow_fingerprint(text)


def classes(edges, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5)]
    edges += [(2000, 2000 + i) for i in range(1, 200)]
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    got = dict(map(tuple, connected_components(spark.createDataFrame([*edges, (None, 3)], "u long, v long")).collect()))
    assert got == classes([e for e in edges if e[0] != e[1]], nodes)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_links_equal_brute_force(spark):
    r = random.Random(2)
    base = [r.getrandbits(64) for _ in range(40)]
    fps = set(base) | {0, (1 << 64) - 1, 1 << 63, 15}
    for _ in range(900):
        x = r.choice(base)
        for b in r.sample(range(64), r.randint(1, 6)):
            x ^= 1 << b
        fps.add(x)
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    got = [tuple(x) for x in S.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()]
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 4}
    assert len(got) == len(set(got)) and set(got) == want


@settings(max_examples=50, deadline=None)
@given(st.integers(0, (1 << 64) - 1), st.integers(0, (1 << 64) - 1))
def test_embedding_bound(a, b):
    c = lambda x: [bin(x >> 2 * i & 3).count("1") for i in range(32)]
    assert sum(abs(x - y) for x, y in zip(c(a), c(b))) <= bin(a ^ b).count("1")


def test_manhattan_column(spark):
    r = random.Random(4)
    rows = [(r.getrandbits(63), r.getrandbits(63)) for _ in range(50)]
    c = lambda x: [bin(x >> 2 * i & 3).count("1") for i in range(32)]
    out = spark.createDataFrame(rows, "a long, b long").select("a", "b", S.manhattan(S.counts(F.col("a")), S.counts(F.col("b"))).alias("d"))
    for row in out.collect():
        assert row.d == sum(abs(x - y) for x, y in zip(c(row.a), c(row.b)))


def documents(seed=5):
    r = random.Random(seed)
    words = ["the", "of", "Ant", "bee", "cat", "dog", "é", "x1"] + [f"w{i}" for i in range(200)]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(3, 200))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    for i in range(60, 110):
        t = r.choice(texts).split()
        t[r.randrange(len(t))] = "changed"
        rows.append((i, "\n".join(t)))
    return rows + [(200, None), (201, ""), (202, " \n"), (203, "ONE two"), (204, "one TWO"), (3, texts[3]), (None, texts[4]), (None, "alone here")]


def test_groups_equal_brute_force(spark):
    rows = documents()
    fp = [slow_fingerprint(t) for _, t in rows]
    edges = [(a, b) for i, a in enumerate(fp) for b in fp[i + 1:] if bin(a ^ b).count("1") <= 4]
    root = classes(edges, set(fp))
    ids = defaultdict(list)
    for (d, _), f in zip(rows, fp):
        if d is not None:
            ids[root[f]].append(d)
    want = sorted(((d, f"{f:016x}", min(ids[root[f]], default=None)) for (d, _), f in zip(rows, fp)), key=str)
    df = S.groups(spark.createDataFrame(rows, "doc_id long, text string"))
    got = df.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id").collect()
    assert sorted(map(tuple, got), key=str) == want
    assert len(set(root.values())) < len(set(fp))
    kept = S.keep_one(spark.createDataFrame([(*x, "m") for x in rows], "doc_id long, text string, fp string"))
    assert kept.columns == ["doc_id", "text", "fp"]
    kept = kept.collect()
    assert len(kept) == len(set(root.values()))
    assert {r.doc_id for r in kept} == {min(v) for v in ids.values() if v} | {None}


def test_empty(spark):
    assert S.groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
