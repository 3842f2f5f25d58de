"""Removal of byte strings that start at more than one place of a corpus.

Method: bucket refinement of suffixes.  A full suffix array holds every byte
offset; here only the suffixes at sampled offsets (``windows.py``) are sorted
into buckets, which loses nothing, because each window of ``length`` bytes
owns one sampled suffix and equal windows own it at the same distance:

1. The initial bucket of a sampled suffix is its ``gram``-byte gram.  Buckets
   with one member are settled: nothing in them repeats.
2. The others are refined by the bucket identifiers of the grams that follow
   at later offsets and precede at earlier ones.  A node is a range of window
   starts of one suffix.  Its *hull* bucket (all bytes of its windows) with
   two members settles it: each window repeats.  Its *core* bucket (the bytes
   its windows share) with one member settles it too: none repeats.
3. Open nodes split into ranges of ``widths[k]`` starts, whose cores are
   longer, and are refined in the same way, down to single windows.

Identifiers are 64-bit hashes of gram sequences, so each refinement is one
pre-aggregated count by identifier and one join, both shuffles that AQE can
split; no bucket is gathered.  Only the bytes around open nodes travel between
the rounds; texts are shuffled twice (to cut those out and to apply the cuts).

Defined cases: a null text counts as empty; repeated rows (also with one
doc_id) repeat each other and are both removed; texts below ``length`` bytes
keep everything; extra columns are kept by :func:`remove_repeats`; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import windows as W
from tessera.llm.common import REGISTRY, drop_saved, saved, slices, table, texts_of

LENGTH = 400
GRAM = 128
#: Window starts in a node of each later refinement.
WIDTHS = (64, 8, 1)
#: Bytes in one value of the sequences that windows.py handles.
REACH = 8

NODES = pa.schema([("rid", pa.int64()), ("anchor", pa.int64()), ("first", pa.int64()),
                   ("last", pa.int64()), ("core", pa.int64()), ("hull", pa.int64())])
NODE_DDL = "rid long, anchor long, first long, last long, core long, hull long"


def _node_batch(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], schema=NODES)


def _sampled(length: int, gram: int):
    """Sampled suffixes of each text with the run of windows that own them."""
    units, grams = length - REACH + 1, gram - REACH + 1

    def run(batches):
        for batch in slices(batches, "text"):
            rid = batch.column("rid").to_numpy(zero_copy_only=False)
            data, offsets = texts_of(batch.column("text"))
            for block in W.pieces(np.diff(offsets), length):
                row, at, size = (np.array(x, np.int64) for x in zip(*block))
                part = np.concatenate([data[offsets[i] + a:offsets[i] + a + n] for i, a, n in block])
                starts = np.cumsum(size) - size
                piece, anchor, first, last, prefix = W.window_runs(
                    W.byte_values(part), starts, size - REACH + 1, units, grams)
                shift = at[piece] - starts[piece]
                core = W.span_hash(prefix, anchor, anchor + grams)
                hull = W.span_hash(prefix, first, last + units)
                yield _node_batch(rid[row[piece]], anchor + shift, first + shift, last + shift,
                                  core.view(np.int64), hull.view(np.int64))
    return run


def _cut(length: int):
    """Bytes around open nodes, as one fragment for nodes that touch."""
    def run(batches):
        for batch in slices(batches, "text"):
            data, offsets = texts_of(batch.column("text"))
            out = {"rid": [], "base": [], "bytes": [], "nodes": []}
            for i, (rid, nodes) in enumerate(zip(batch.column("rid").to_pylist(), batch.column("nodes").to_pylist())):
                low = top = None
                for n in sorted({(x["first"], x["last"], x["anchor"]) for x in nodes}) + [None]:
                    if low is not None and (n is None or n[0] > top):
                        out["rid"].append(rid)
                        out["base"].append(low)
                        out["bytes"].append(data[offsets[i] + low:offsets[i] + top].tobytes())
                        out["nodes"].append(held)
                        low = None
                    if n is not None:
                        if low is None:
                            low, top, held = n[0], n[1] + length, []
                        top = max(top, n[1] + length)
                        held.append({"anchor": n[2], "first": n[0], "last": n[1]})
            yield pa.RecordBatch.from_pydict(out, schema=FRAGMENTS)
    return run


NODE = pa.struct([("anchor", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])
FRAGMENTS = pa.schema([("rid", pa.int64()), ("base", pa.int64()), ("bytes", pa.binary()), ("nodes", pa.list_(NODE))])
FRAGMENT_DDL = "rid long, base long, bytes binary, nodes array<struct<anchor long, first long, last long>>"


def _split(length: int, gram: int, width: int):
    """Nodes of ``width`` starts (counted from the anchor) with core and hull identifiers."""
    units, grams = length - REACH + 1, gram - REACH + 1

    def run(batches):
        for batch in slices(batches, "bytes", 1 << 20):
            for rid, base, content, nodes in zip(*(batch.column(c).to_pylist() for c in ("rid", "base", "bytes", "nodes"))):
                prefix = W.prefix_hash(W.byte_values(np.frombuffer(content, np.uint8)))
                anchor, first, last = (np.array([n[k] for n in nodes], np.int64) for k in ("anchor", "first", "last"))
                # cell of a start: its distance before the anchor over the width, so that equal windows share cells
                low, high = (anchor - last) // width, (anchor - first) // width
                cells = W.ranges(low, high - low + 1)
                of = np.repeat(np.arange(len(nodes)), high - low + 1)
                a, f, z = anchor[of], first[of], last[of]
                f, z = np.maximum(f, a - (cells + 1) * width + 1), np.minimum(z, a - cells * width)
                # the core: bytes common to all windows the cell can hold, whatever part of it is here
                far = np.minimum((cells + 1) * width - 1, units - grams)
                c0, c1 = a - cells * width - base, a - far + units - base
                tag = W.mix64(cells.astype(np.uint64) + np.uint64(width << 20))
                core = W.span_hash(prefix, c0, c1) ^ tag
                hull = W.mix64(W.span_hash(prefix, f - base, z - base + units) ^ tag
                               ^ W.mix64((a - f).astype(np.uint64)))
                yield _node_batch(np.full(len(of), rid), a, f, z, core.view(np.int64), hull.view(np.int64))
    return run


def _settle(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repeated spans, open nodes by text) after one refinement.

    Nodes whose core is alone drop out.  The others form classes by core and
    hull: all members of a class with two or more repeat.  One member of each
    class stays open if its core has another class, since parts of it may
    repeat there; what its fellow members repeat is settled already.
    """
    # written tables on both sides: a join of plain scans, whose skewed partitions AQE splits
    cores = saved(nodes.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core"), "op4-cores")
    shared = saved(nodes.join(cores, "core"), "op4-shared")
    drop_saved(cores)
    classes = saved(shared.groupBy("core", "hull").agg(
        F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("rid", "anchor", "first", "last")]), "op4-classes")
    repeats = saved(shared.join(classes.where("n > 1").select("core", "hull"), ["core", "hull"])
                    .select("rid", "first", "last"), "op4-repeats")
    drop_saved(shared)
    mixed = saved(classes.groupBy("core").agg(F.count("*").alias("m")).where("m > 1").select("core"), "op4-mixed")
    left = saved(classes.join(mixed, "core").groupBy("rid")
                 .agg(F.collect_list(F.struct("anchor", "first", "last")).alias("open")), "op4-open")
    drop_saved(classes, mixed)
    return repeats, left


def with_row_key(docs: DataFrame) -> DataFrame:
    """(rid, text): the key follows from the row alone, so repeated rows share it."""
    return docs.select(F.xxhash64(F.col("doc_id").cast("string"), "text").alias("rid"), "text")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """(rid, spans): the window starts [first, last] of each text that repeat.

    ``rid`` is the row key of :func:`with_row_key`; only texts with a repeat
    have a row.
    """
    if gram < REACH or length < gram or list(widths) != sorted(widths, reverse=True) or widths[-1] != 1:
        raise ValueError("need 8 <= gram <= length and falling widths that end with 1")
    texts = with_row_key(docs)
    sampled = saved(texts.mapInArrow(_sampled(length, gram), NODE_DDL), "op4-sampled")
    repeats, left = _settle(sampled)
    drop_saved(sampled)
    found = [repeats]
    fragments = saved(texts.join(left.hint("shuffle_hash"), "rid").select("rid", "text", F.col("open").alias("nodes"))
                      .mapInArrow(_cut(length), FRAGMENT_DDL), "op4-fragments")
    for width in widths:
        nodes = saved(fragments.mapInArrow(_split(length, gram, width), NODE_DDL), "op4-nodes")
        repeats, left = _settle(nodes)
        drop_saved(nodes)
        found.append(repeats)
        if width > 1:
            rest = saved(fragments.join(left, "rid").select(
                "rid", "base", "bytes", F.expr(
                    "filter(open, n -> n.first >= base AND n.last < base + length(bytes))").alias("nodes"))
                .where("size(nodes) > 0"), "op4-fragments")
            drop_saved(fragments)
            fragments = rest
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy("rid").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def _apply(length: int, keep_text: bool):
    def run(batches):
        for batch in slices(batches, "text"):
            data, offsets = texts_of(batch.column("text"))
            out = []
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                content = data[offsets[i]:offsets[i + 1]]
                merged = []
                for a, z in sorted((s["first"], s["last"] + length) for s in spans or ()):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], z)
                    else:
                        merged.append([a, z])
                keep = np.ones(len(content), bool)
                for a, z in merged:
                    keep[a:z] = False
                kept = content[keep].tobytes()
                out.append((len(content), int(len(content) - keep.sum()), len(merged), hashlib.sha256(kept).hexdigest(),
                            kept.decode("utf-8", "replace") if keep_text else None))
            add = dict(zip(("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"), zip(*out)))
            names = [n for n in batch.schema.names if n != "spans" and (keep_text or n != "text")]
            arrays = [batch.column(n) for n in names]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            for (n, v), kind in zip(list(add.items())[:5 if keep_text else 4], kinds):
                names.append(n)
                arrays.append(pa.array(v, kind))
            yield pa.RecordBatch.from_arrays(arrays, names)
    return run


def repeat_report(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept_text)."""
    spans = repeated_spans(docs, length, gram)
    rows = docs.select("doc_id", F.xxhash64(F.col("doc_id").cast("string"), "text").alias("rid"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    joined = rows.join(spans.hint("shuffle_hash"), "rid", "left").select("doc_id", "text", "spans")
    ddl = f"doc_id {kind}, " + "text string, " * keep_text + \
        "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * keep_text
    return joined.mapInArrow(_apply(length, keep_text), ddl)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with repeated bytes cut from ``text``; all other columns stay.

    Every row stays, as an empty text where all of it repeats.  A cut inside a
    multi-byte character leaves U+FFFD for its remaining bytes.  A null text
    stays null.
    """
    spans = repeated_spans(docs, length, gram)
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    packed = docs.select(row.alias("doc"), F.xxhash64(F.col("doc_id").cast("string"), "text").alias("rid"), "text")
    kind = packed.schema["doc"].dataType.simpleString()
    cut = (packed.join(spans.hint("shuffle_hash"), "rid", "left")
           .select("doc", "text", "spans").mapInArrow(
               _apply(length, True), f"doc {kind}, text string, n_bytes long, n_removed long, "
               "n_spans long, kept_sha256 string, kept_text string"))
    return cut.select(*[
        (F.when(F.col("text").isNotNull(), F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text")))
         if c == "text" else F.col(f"doc.c{i}")).alias(c) for i, c in enumerate(docs.columns)])


@REGISTRY("op4_suffix_array_dedup")
def op4(spark, sf_dir):
    """Bytes of `documents` covered by a 400-byte string that starts elsewhere too."""
    return repeat_report(table(spark, sf_dir, "documents"))
