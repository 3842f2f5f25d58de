import hashlib
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.llm import windows as W
from tessera.llm.suffix_dedup import remove_repeats, repeat_report


def brute(rows, length):
    seen = Counter()
    for _, text in rows:
        b = (text or "").encode()
        seen.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for doc_id, text in rows:
        b = (text or "").encode()
        keep = [True] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                keep[i:i + length] = [False] * length
        spans = sum(1 for i, k in enumerate(keep) if not k and (i == 0 or keep[i - 1]))
        kept = bytes(c for c, k in zip(b, keep) if k)
        out.append((doc_id, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(seed, n=40):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcé \n") for _ in range(r.randint(1, 6)))
    text = lambda k: " ".join(word() for _ in range(k))
    shared = [text(30) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = [text(r.randint(0, 30)) for _ in range(3)]
        for _ in range(r.randint(0, 2)):
            s = r.choice(shared)
            a = r.randint(0, 40)
            parts.insert(r.randint(0, 3), s[a:a + r.randint(20, 90)])
        rows.append((i, "".join(parts)))
    rows += [(n, rows[0][1]), (n + 1, None), (n + 2, ""), (n + 3, "a" * 150), (n + 4, "ab" * 90),
             (n + 5, rows[1][1][:-1]), (1, rows[1][1]), (None, rows[2][1])]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = made(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in repeat_report(df, 40, 16).collect()), key=str)
    assert got == brute(rows, 40)


def test_production_length(spark):
    r = random.Random(3)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    a, b = text(900), text(700)
    rows = [(1, a), (2, b), (3, text(500) + a[100:520] + text(20)), (4, text(300) + b[:399]),
            (5, a[:500] + "#" + a[501:]), (6, text(3000) + b[100:600] + text(5) + b[100:600])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in repeat_report(df).collect()), key=str) == brute(rows, 400)


def test_pieces_of_long_texts_cover_every_window_once(monkeypatch):
    sizes = [5, 0, 130, 17, 400, 39, 40]
    import numpy as np
    seen = Counter()
    for block in W.pieces(np.array(sizes), 40, limit=100):
        for i, a, n in block:
            seen.update((i, p) for p in range(a, a + n - 39))
    assert seen == Counter((i, p) for i, n in enumerate(sizes) for p in range(n - 39))


@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(alphabet="ab", max_size=120), st.integers(3, 12))
def test_runs_cover_windows_and_anchors_agree(text, length):
    import numpy as np
    values = W.mix64(np.frombuffer(text.encode(), np.uint8).astype(np.uint64))
    if len(values) < length:
        return
    _, anchor, first, last, _ = W.window_runs(values, np.array([0]), np.array([len(values)]), length, 2)
    place = {}
    for a, f, z in zip(anchor, first, last):
        for p in range(f, z + 1):
            assert p <= a <= p + length - 2
            assert place.setdefault(text[p:p + length], a - p) == a - p
    assert sum(last - first + 1) == len(values) - length + 1


def test_filter_keeps_columns_and_handles_empty(spark):
    rows = [(1, "x" * 50, "s"), (2, "x" * 50, "t"), (3, "abc", "u"), (4, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, rid string").withColumnRenamed("rid", "spans")
    out = remove_repeats(df, 40, 16)
    assert out.columns == ["doc_id", "text", "spans"]
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "", "s"), (2, "", "t"), (3, "abc", "u"), (4, None, None)]
    assert repeat_report(df.limit(0)).count() == 0
