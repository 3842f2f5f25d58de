import hashlib
import math
import random

import duckdb
import numpy as np

from conftest import SF001
from tessera.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int, code string, x int"


def brute(rows, parts, entries, rounds):
    """(codes and errors by row, label sums, digest) by a full scan in Python integers."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = [[math.floor(256 * float(np.float32(x))) for x in r[1]] for r in kept]
    w = len(whole[0]) // parts
    first = {}
    for r, x in sorted(zip(kept, whole), key=lambda z: (z[0][0], z[1])):
        first.setdefault(r[0], x)
    books = [[first[i][p * w:p * w + w] for i in sorted(first)[:entries]] for p in range(parts)]

    def nearest(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(x[p * w:p * w + w], e)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        sums = [[[0] * (w + 1) for _ in book] for book in books]
        for x in whole:
            for p in range(parts):
                s = sums[p][nearest(x, p)[1]]
                for i in range(w):
                    s[i] += x[p * w + i]
                s[w] += 1
        books = [[[s[i] // s[w] for i in range(w)] if s[w] else e for s, e in zip(sums[p], books[p])] for p in range(parts)]
    out, labels = [], {}
    for r, x in zip(kept, whole):
        best = [nearest(x, p) for p in range(parts)]
        out.append([r[0], "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), r[2]])
        labels[r[2]] = labels.get(r[2], 0) + out[-1][2]
    digest = hashlib.sha256(",".join(str(v) for book in books for e in book for v in e).encode()).hexdigest()
    return sorted((str(i), c, e, labels[g]) for i, c, e, g in out), digest


def rows_of(seed, n, dim, scale=0.3):
    r = random.Random(seed)
    centres = [[r.gauss(0, scale) for _ in range(dim)] for _ in range(5)]
    rows = []
    for i in range(n):
        c = r.choice(centres)
        rows.append((i * 3 - 20, [x + r.gauss(0, scale / 3) for x in c], r.choice([0, 1, None]), "c", 1))
    return rows


def got(spark, rows, parts, entries, rounds, **kw):
    codes, books = V.compress(spark.createDataFrame(rows, SCHEMA).repartition(3), parts, entries, rounds)
    out = V.with_label_error(codes, **kw).collect()
    return sorted((str(r.id), bytes(r.code).hex(), r.error, r.label_error) for r in out), books.sha256(), codes


def test_equals_full_scan(spark):
    odd = [(5000, None, 1, "", 0), (5001, [], 1, "", 0), (5002, [0.1] * 7 + [None], 1, "", 0), (5003, [0.1] * 7 + [float("nan")], 1, "", 0),
           (5004, [float("-inf")] + [0.1] * 7, 1, "", 0)]
    rows = rows_of(1, 150, 8) + odd
    rows += [rows[7], rows[7], (rows[9][0], rows[8][1], 0, "", 0), (4000, [0.0] * 8, None, "", 0), (4001, [-0.001] * 8, 2, "", 0)]
    for parts, entries, rounds in ((4, 20, 2), (2, 64, 5), (8, 1, 1), (1, 17, 0)):
        want, digest = brute(rows, parts, entries, rounds)
        assert got(spark, rows, parts, entries, rounds)[:2] == (want, digest)
    assert got(spark, rows, 8, 1, 1, broadcast_labels=0, salts=3)[0] == brute(rows, 8, 1, 1)[0]


def test_large_values_and_ties_are_exact(spark):
    rows = [(i, [float(x) for x in (i % 4, i // 4 % 2, 500000.0 * (i % 2), -500000.0)], 0, "", 0) for i in range(40)]
    want, digest = brute(rows, 2, 6, 3)
    assert got(spark, rows, 2, 6, 3)[:2] == (want, digest)
    assert V.compress(spark.createDataFrame(rows + [(99, [3e38, 0.0, 0.0, 0.0], 0, "", 0)], SCHEMA), 2, 6, 1)[0].count() == 40


def test_bounds_are_sound_and_save_distances():
    r = np.random.default_rng(3)
    centres = r.normal(0, 60, (40, 4))
    x = np.round(centres[r.integers(0, 40, 3000)] + r.normal(0, 9, (3000, 4))).astype(np.int64)
    history = [x[:32].copy()]
    groups = V.groups_of(history[0])
    assert sorted(np.concatenate(groups).tolist()) == list(range(32))
    code, low, stamp, _ = V.first_round(x, history[0], groups)
    spent, stamps = 0, set()
    for _ in range(8):
        before = history[-1]
        history.append(np.array([x[code == k].sum(0) // max(1, (code == k).sum()) if (code == k).any() else before[k] for k in range(32)]))
        code, low, stamp, best, n = V.next_round(x, history, groups, code, low, stamp)
        full = ((x[:, None] - history[-1][None]) ** 2).sum(2)
        assert (code == full.argmin(1)).all() and (best == full.min(1)).all()
        full[np.arange(len(x)), code] = V.FAR
        drift = V.net_moves(history, groups)
        for g, members in enumerate(groups):
            assert (low[:, g] - drift[stamp[:, g], g] <= np.sqrt(full[:, members].min(1).astype(float))).all()
        # the net move of an entry is at most the sum of its moves
        summed = sum(np.sqrt(((b - a) ** 2).sum(1)) for a, b in zip(history, history[1:]))
        assert (np.sqrt(((history[-1] - history[0]) ** 2).sum(1)) <= summed + 1e-9).all()
        spent += n.sum()
        stamps |= set(stamp.ravel().tolist())
    assert spent < 0.5 * 8 * 32 * len(x)
    assert len(stamps) > 2


def test_unusable_tables(spark):
    for rows in ([], [(1, None, 1, "", 0), (2, [], None, "", 0), (3, [None], 1, "", 0)]):
        codes, books = V.compress(spark.createDataFrame(rows, SCHEMA))
        assert codes.count() == 0 and not books.history
        assert V.with_label_error(codes).columns == ["id", "label", "code", "error", "n_distances", "label_error"]
    # one vector, a null id, a length that the parts do not divide, another length
    rows = [(None, [0.5, 0.25, -0.1], None, "", 0), (None, [0.5, 0.25, -0.1], None, "", 0), (1, [1.0, 2.0], 1, "", 0)]
    codes, books = V.compress(spark.createDataFrame(rows, SCHEMA), parts=2, entries=4)
    assert [(r.id, bytes(r.code), r.error) for r in codes.collect()] == [(None, b"\0\0", 0)] * 2
    back = V.decoded(codes, books).collect()
    assert [round(x, 2) for x in back[0].vector] == [0.5, 0.25, -0.1]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF001}/embeddings.parquet')")
    want = sorted(con.execute(V.REGISTRY.oracle["op12_vector_codes"]).fetchall())
    have = V.op12(spark, SF001)
    assert have.columns == [d[0] for d in con.description]
    assert sorted(map(tuple, have.collect())) == want
