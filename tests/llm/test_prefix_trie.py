import hashlib
import random
import zlib

import duckdb
import pytest

from conftest import SF001
from tessera.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, shard string, pos int"


def brute(rows):
    own = {}
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "")):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, save = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            save[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], save[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest())
                   for p, m in members.items()), key=str)


def conversations(seed=1, n=160):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-150, 900), n):
        for t in range(r.choice([1, 1, 2, 3, 5, 8, 13])):
            rows.append((c, t, r.choice(["user", "assistant"]) if t > 2 else "user", r.choice(["a", "é b", "long text here", "c"]), "s", 9))
    rows += [(c, t, "user", "same", "s", 9) for c in range(901, 960) for t in range(9)]            # copies
    rows += [(1001, t, "user", f"t{t}", "s", 9) for t in range(40)] + [(1002, t, "user", f"t{t}", "s", 9) for t in range(33)]
    rows += [(2007, None, None, None, "s", 9), (2007, 0, "user", "x", "s", 9), (2007, None, "user", "", "s", 9), (2011, 5, "", "", "s", 9),
             (2011, 5, "", "", "s", 9), (None, 1, "user", "nobody's", "s", 9), (2100, 1, None, "q" * 5000, "s", 9), (2103, 1, "user", None, "s", 9)]
    r.shuffle(rows)
    return rows


def got(spark, rows, **kw):
    out = T.trie(spark.createDataFrame(rows, SCHEMA).repartition(3), **kw).drop("k1", "k2", "p1", "p2")
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("kw", [{}, {"shard_turns": 60, "block": 4}, {"shard_turns": 7, "block": 1}])
def test_equals_brute_force(spark, kw):
    rows = conversations()
    assert got(spark, rows, **kw) == brute(rows)


def test_empty_and_small(spark):
    assert got(spark, []) == [] == got(spark, [(None, 1, "user", "x", "", 0)])
    rows = [(7, 0, "user", "hi", "", 0)]
    assert got(spark, rows) == brute(rows)
    # nothing left of a conversation: its few turns are replaced by those of one that is absent
    bare = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(bare, t, "user", "hi", "", 0) for t in range(3)]
    assert got(spark, rows) == brute(rows) and len(brute(rows)) == 1


def test_deep_chain(spark):
    rows = [(c, t, "user", str(t), "", 0) for c in (100, 105) for t in range(1500)]
    assert got(spark, rows) == brute(rows)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF001}/conversations.parquet')")
    want = sorted(con.execute(T.SQL).fetchall(), key=str)
    have = T.op11(spark, SF001)
    assert have.columns == [d[0] for d in con.description]
    assert sorted(map(tuple, have.collect()), key=str) == want and len(want) > 30
