import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import piece_codec as P

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=MODEL)
CODEC = P.Codec(MODEL)
HARD = ["", " ", "  ", "   a", "a  ", "a b", " a\n b\t c ", "▁", "a▁b ▁▁ c", "<s> </s> <unk>", "日本 語", "\x00 \x00a", "é" * 300, "a" * 5000,
        "tab\tend", "\n\n", "  \n  x", "  a　b", "ﬁ Å ½", "🙂 🙂🙂 "]


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(text):
    assert CODEC.encode([text])[0] == SP.encode(text, add_bos=True, add_eos=True)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" ▁\nabthein<s>é"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=4))
def test_random_texts(texts):
    assert CODEC.encode(texts) == [SP.encode(t, add_bos=True, add_eos=True) for t in texts]


def test_small_table(monkeypatch):
    monkeypatch.setattr(P, "TABLE_CHUNKS", 3)
    codec = P.Codec(MODEL)
    for t in HARD + ["one two three four five six one two"]:
        assert codec.encode([t, t]) == [SP.encode(t, add_bos=True, add_eos=True)] * 2


def test_query_form(spark):
    rows = [(i, t, "s") for i, t in enumerate(HARD)] + [(99, None, None), (None, "x y", "s"), (0, "", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = P.encode_texts(df, ("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    want = []
    for d, t, _ in rows:
        ids = SP.encode(t or "", add_bos=True, add_eos=True)
        back = SP.decode(ids)
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), ids, back))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert P.encode_texts(df.limit(0)).count() == 0
