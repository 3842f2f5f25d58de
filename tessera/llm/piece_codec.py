"""SentencePiece encoding and decoding through a distinct-chunk table.

Method: a text is marked as the library does (a marker in front, one for each
space) and cut before each run of markers.  Where no piece holds a marker after
another character (checked when the model is loaded), no merge crosses a cut,
so the ids of a text are the ids of its chunks in order.  Each task keeps a
table of distinct chunks: a chunk is segmented once, and the ids of a batch of
texts are joined back by position.  The table is cleared at ``TABLE_CHUNKS``
entries, which bounds memory and changes no result.

The table is kept by task, not shuffled: positions of all words would be a
shuffle of several times the input.

Defined cases: a null text counts as empty (begin and end id only); any text
round-trips as the library's own ``decode`` gives it; other columns stay.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import REGISTRY, slices, table

MARK = "▁"
CHUNK = re.compile("[ ▁]?[^ ▁]+|[ ▁]")
TABLE_CHUNKS = 200_000
#: Longer chunks are segmented where they stand and not kept.
LONGEST_KEPT = 64


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, model: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece holds a marker after another character: chunks would not be independent")
        self.table: dict[str, list[int]] = {}

    def chunks(self, text: str) -> list[str]:
        """Chunks without their first marker, which the library puts in front of each."""
        return [c[1:] for c in re.findall(r" +[^ ]*", " " + text.replace(MARK, " "))] if text else []

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, with begin and end ids."""
        cut = [self.chunks(t) for t in texts]
        known = self.table
        fresh = list({c for cs in cut for c in cs} - known.keys())
        if len(known) + len(fresh) > TABLE_CHUNKS:
            known.clear()
            fresh = list({c for cs in cut for c in cs})
        here = dict(zip(fresh, self.sp.encode(fresh, num_threads=1)))
        for c in fresh:
            # the library gives no id for an empty chunk; alone it is one marker
            if not c:
                here[c] = self.marker()
        known.update((c, ids) for c, ids in here.items() if len(c) <= LONGEST_KEPT)
        get = known.get
        begin, end = [self.sp.bos_id()], [self.sp.eos_id()]
        return [begin + list(chain.from_iterable(get(c) or here[c] for c in cs)) + end for cs in cut]

    def marker(self) -> list[int]:
        return [self.sp.piece_to_id(MARK)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return [self.sp.decode(i) for i in ids]


def _run(model: str | None, outputs: tuple[str, ...]):
    def run(batches):
        import public_tokenizers
        codec = Codec(model or public_tokenizers.path("piece_bpe_32k.model"))
        for batch in slices(batches, "text", 1 << 20):
            ids = codec.encode([t or "" for t in batch.column("text").to_pylist()])
            names = [n for n in batch.schema.names if n not in ("text", *outputs)]
            arrays = [batch.column(n) for n in names]
            packed = [np.array(i, "<u4") for i in ids]
            back = codec.decode(ids) if {"decoded", "decoded_sha256"} & {*outputs} else []
            make = {
                "n_tokens": lambda: pa.array([len(i) for i in ids], pa.int64()),
                "ids": lambda: pa.array(packed, pa.list_(pa.int32())),
                "ids_sha256": lambda: pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in packed], pa.string()),
                "decoded": lambda: pa.array(back, pa.string()),
                "decoded_sha256": lambda: pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back], pa.string()),
            }
            yield pa.RecordBatch.from_arrays(arrays + [make[o]() for o in outputs], names + list(outputs))
    return run


KINDS = {"n_tokens": "long", "ids": "array<int>", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}


def encode_texts(docs: DataFrame, outputs: tuple[str, ...] = ("n_tokens", "ids"), model: str | None = None) -> DataFrame:
    """``docs`` without ``text`` but with the ``outputs`` (keys of ``KINDS``; they replace columns of their names).

    ``model`` is a path every executor can open; by default the public 32k model.
    """
    rest = [c for c in docs.columns if c not in ("text", *outputs)]
    safe = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], F.col("text"))
    kinds = [(f"c{i}", docs.schema[c].dataType.simpleString()) for i, c in enumerate(rest)] + [(o, KINDS[o]) for o in outputs]
    out = safe.mapInArrow(_run(model, outputs), ", ".join(f"`{n}` {k}" for n, k in kinds))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], *outputs)


@REGISTRY("op8_sentencepiece_codec")
def op8(spark, sf_dir):
    """Ids of every document with the public 32k model, and what they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_texts(docs, ("n_tokens", "ids_sha256", "decoded_sha256"))
