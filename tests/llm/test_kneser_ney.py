import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import kneser_ney as K
from tests.conftest import SF001


def tokens(text):
    low = re.sub("[A-Z]", lambda c: c[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["</s>"]


def slow(train, texts):
    """(n_tokens, n_known, base, score) by the formulas, with exact counts."""
    big, uni = Counter(), Counter()
    for t in train:
        w = tokens(t)
        uni.update(w)
        big.update(zip(["<s>", *w], w))
    kinds = Counter(w for _, w in big)
    d = K.discounts([sum(1 for c in big.values() if c == k) for k in (1, 2, 3, 4)])
    e = K.discounts([sum(1 for c in kinds.values() if c == k) for k in (1, 2, 3, 4)])
    total, left = Counter(), defaultdict(float)
    for (v, _), c in big.items():
        total[v] += c
        left[v] += d[min(c, 3)]
    n, vocab = sum(uni.values()), len(uni)
    rest = sum(e[min(c, 3)] for c in kinds.values()) / len(big) if big else 1.0
    out = []

    def low(w):
        return ((kinds[w] - e[min(kinds[w], 3)]) / len(big) if kinds[w] else 0.0) + rest / (vocab + 1)
    for t in texts:
        w = tokens(t)
        score = 0.0
        for v, x in zip(["<s>", *w], w):
            c = big[v, x]
            score += math.log10(((c - d[min(c, 3)]) / total[v] if c else 0) + (left[v] / total[v] if total[v] else 1.0) * low(x))
        out.append((len(w), sum(uni[x] > 0 for x in w), sum(math.log10((uni[x] + 1) / (n + vocab + 1)) for x in w), score))
    if big:  # the distribution after a word sums to one over the vocabulary and the unknown word
        v = next(iter(total))
        mass = sum((big[v, x] - d[min(big[v, x], 3)]) / total[v] if big[v, x] else 0 for x in uni)
        assert mass + left[v] / total[v] * (sum(low(x) for x in uni) + rest / (vocab + 1)) == pytest.approx(1)
    return out, n


def made(seed=1, n=80):
    r = random.Random(seed)
    words = ["the", "The", "of", "é", "日本", "x.", "y"] + [f"w{i}" for i in range(60)]
    texts = ["".join(r.choice(words[:r.choice((3, 67))]) + r.choice([" ", "\n", "\t "]) for _ in range(r.randint(0, 80))) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)] + [(n, None), (n + 1, ""), (n + 2, " "), (None, "the of"), (3, texts[3]), (n + 3, "the of " * 9000)]


@pytest.mark.parametrize("shard,block", [(8 << 20, 6 << 20), (300, 500)])
def test_equals_formulas(spark, monkeypatch, shard, block):
    monkeypatch.setattr(K, "SHARD_BYTES", shard)
    monkeypatch.setattr(K, "BLOCK_BYTES", block)
    rows = made()
    df = spark.createDataFrame([(*x, "s") for x in rows], "doc_id long, text string, score string")
    test = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    model = K.train(df.where(~K.held_out(F.col("doc_id"), 7, 2)))
    want, n = slow([t for d, t in rows if not test(d)], [t for _, t in rows])
    assert model.tokens == n
    got = sorted(K.score(df, model).collect(), key=lambda r: (str(r.doc_id), r.n_tokens))
    for r, (d, w) in zip(got, sorted(zip([d for d, _ in rows], want), key=lambda x: (str(x[0]), x[1][0]))):
        assert (r.doc_id, r.n_tokens, r.n_known) == (d, w[0], w[1])
        assert r.base_score == pytest.approx(w[2], rel=1e-9) and r.score == pytest.approx(w[3], rel=1e-5)


def test_no_training_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = K.train(df.limit(0))
    assert sorted((r.n_tokens, r.n_known, r.base_score, r.score) for r in K.score(df, model).collect()) == [(1, 0, 0, 0), (3, 0, 0, 0)]
    assert K.score(df.limit(0), model).count() == 0


def test_held_out_perplexity_beats_base(spark):
    rows = K.op10(spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert len(rows) > 100 and sum(r.score for r in rows) > sum(r.base_score for r in rows)
