"""Removal of word windows that occur earlier in a corpus, by phrase automata.

Method:

1. *Recurring phrases.*  Every window of ``length`` words owns an anchor phrase
   of ``gram`` words (``windows.py``); equal windows own equal phrases at equal
   distances.  Phrases that occur once are settled: none of their windows
   recurs.  The count by phrase identifier is pre-aggregated.
2. *Sharded automata.*  Each recurring phrase belongs to the shard of the
   document that holds it first, so that passages copied together stay in one
   shard.  Documents send the stretches around their recurring phrases to the
   shards concerned; large shards are split by salt, with their phrases
   repeated.  A task compiles a shard's phrases to one Aho-Corasick automaton
   and streams the shard's stretches through it; each hit is an occurrence,
   confirmed letter by letter.
3. *First occurrences.*  Runs with equal words (hull) form a class; all but its
   first member go.  Where a phrase has more than one class, the windows of
   the classes' first members are compared one by one.

A shard holds at most ``SHARD_PHRASES`` phrases on average, whatever the size
of the corpus: their number grows, and no document meets a shard it shares
nothing with.

Defined cases: a null text has no words; rows with one doc_id count as one
document for the order (equal windows at one start are then both kept); a null
doc_id sorts first; doc_ids that are no integers count in their sort order; an
empty table gives an empty result; separators inside a
document do not matter, words are compared unchanged.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import windows as W
from tessera.llm.common import REGISTRY, drop_saved, saved, slices, table, texts_of
from tessera.operators.ratings import dense_index

LENGTH = 20
GRAM = 5
SHARD_PHRASES = 50_000
SALT_BYTES = 8 << 20

#: A run is kept as first * SPAN + (last - first), with its anchor as that * SPAN + (anchor - first):
#: its order is that of first.
SPAN = 64


def _documents(docs: DataFrame) -> DataFrame:
    """(rid, ord, text): the row key, and the document's place in the order."""
    rid = F.xxhash64(F.col("doc_id").cast("string"), "text").alias("rid")
    first = F.lit(-(1 << 63))
    if isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        return docs.select(rid, F.coalesce(F.col("doc_id").cast("long"), first).alias("ord"), "text")
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
    rows = docs.select("doc_id", rid, "text").join(dense_index(ids, ["doc_id"], "ord"), "doc_id", "left")
    return rows.select("rid", F.coalesce("ord", first).alias("ord"), "text")


def _runs(data, offsets, length, gram):
    """(row, anchor, first, last, core) of each text's runs."""
    begin, end = W.word_bounds_by_text(data, offsets)
    values = W.word_values(data, begin, end)
    row_of = np.searchsorted(offsets, begin, side="right") - 1
    sizes = np.bincount(row_of, minlength=len(offsets) - 1)[:len(offsets) - 1] if len(begin) else np.zeros(len(offsets) - 1, np.int64)
    base = np.cumsum(sizes) - sizes
    out = []
    for block in W.pieces(sizes, length, 1 << 19):
        row, at, size = (np.array(x, np.int64) for x in zip(*block))
        part = np.concatenate([values[base[i] + a:base[i] + a + n] for i, a, n in block])
        starts = np.cumsum(size) - size
        piece, anchor, first, last, prefix = W.window_runs(part, starts, size, length, gram)
        shift = at[piece] - starts[piece]
        out.append((row[piece], anchor + shift, first + shift, last + shift,
                    W.span_hash(prefix, anchor, anchor + gram).view(np.int64)))
    return [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 5


def _phrases(length: int, gram: int):
    def run(batches):
        for batch in slices(batches, "text", 2 << 20):
            data, offsets = texts_of(batch.column("text"))
            row, anchor, first, last, core = _runs(data, offsets, length, gram)
            if len(row):
                rid = batch.column("rid").to_numpy(zero_copy_only=False)
                packed = (first * SPAN + last - first) * SPAN + anchor - first
                yield pa.RecordBatch.from_arrays([pa.array(core), pa.array(rid[row]), pa.array(packed)], ["core", "rid", "run"])
    return run


STRETCH_DDL = "shard long, tag int, rid long, ord long, base long, size long, words string, runs binary"
STRETCH = pa.schema([("shard", pa.int64()), ("tag", pa.int32()), ("rid", pa.int64()), ("ord", pa.int64()), ("base", pa.int64()),
                     ("size", pa.int64()), ("words", pa.string()), ("runs", pa.binary())])


def _stretches(length: int, gram: int):
    """Tag 0: a phrase, from the document that owns it.  Tag 1: a stretch to search, with its runs
    (anchor, first, last) as positions in the document."""
    def run(batches):
        for batch in slices(batches, "text", 1 << 20):
            lists = [batch.column(c) for c in ("runs", "cores", "places")]
            edge = np.concatenate([[0], np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False))])
            lists = [x.flatten().to_numpy(zero_copy_only=False) for x in lists]
            out = []
            for i, (rid, ord_, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("rid", "ord", "text")))):
                packed, core, place = (x[edge[i]:edge[i + 1]] for x in lists)
                order = np.argsort(packed)  # by first start
                packed, core, place = packed[order], core[order], place[order]
                first = packed // (SPAN * SPAN)
                last, anchor = first + packed // SPAN % SPAN, first + packed % SPAN
                shard, own = place >> 1, (place & 1).astype(bool)
                words = text.encode().split()
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
                text = b" ".join(words)
                word = lambda a, z: text[(ends[a - 1] + 1 if a else 0):ends[z - 1]].decode()
                _, which = np.unique(core, return_index=True)
                for k in which[own[which]].tolist():
                    out.append((int(shard[k]), 0, rid, ord_, 0, gram, word(anchor[k], anchor[k] + gram), b""))
                for s in np.unique(shard).tolist():
                    runs = np.flatnonzero(shard == s)
                    f, z = first[runs], last[runs] + length
                    cut = np.flatnonzero(np.concatenate([[True], f[1:] > np.maximum.accumulate(z)[:-1]]))
                    for j, k in zip(cut.tolist(), [*cut[1:].tolist(), len(runs)]):
                        part = np.stack([anchor[runs[j:k]], f[j:k], last[runs[j:k]]])
                        a, n = int(f[j]), int(z[j:k].max() - f[j])
                        out.append((s, 1, rid, ord_, a, n, word(a, a + n), part.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), STRETCH)], schema=STRETCH)
    return run


NODES = pa.schema([(c, pa.int64()) for c in ("rid", "ord", "span", "core", "hull")])
NODE_DDL = ", ".join(f"{f.name} long" for f in NODES)


def _laid_out(words: list[str]):
    """Stretches in one text, a line each with a space around every word; each one's first word; the hashes."""
    joined = b" " + b" \n ".join(w.encode() for w in words) + b" "
    data = np.frombuffer(joined, np.uint8)
    begin, end = W.word_bounds(data)
    lines = np.concatenate([[0], np.flatnonzero(data == 10)])
    return joined, begin, np.searchsorted(begin, lines), W.prefix_hash(W.word_values(data, begin, end))


def _search(length: int, gram: int):
    """Compile each shard's phrases, then stream its stretches (rows come sorted by shard, salt, tag).

    The automaton reads bytes as characters, so its positions are byte offsets.
    """
    def found(automaton, rows):
        rid, ord_, base, words, runs = zip(*rows)
        joined, begin, head, prefix = _laid_out(words)
        hits = np.array([e - n + 2 for e, n in automaton.iter(joined.decode("latin-1"))], np.int64)
        hits = np.unique(np.searchsorted(begin, hits))
        runs = [np.frombuffer(r, np.int64).reshape(3, -1) for r in runs]
        of = np.repeat(np.arange(len(runs)), [r.shape[1] for r in runs])
        anchor, first, last = np.concatenate(runs, axis=1)
        shift = (head - np.array(base))[of]
        there = np.minimum(np.searchsorted(hits, anchor + shift), len(hits) - 1) if len(hits) else np.zeros(len(of), np.int64)
        sure = hits[there] == anchor + shift if len(hits) else np.zeros(len(of), bool)
        anchor, first, last, shift, of = (x[sure] for x in (anchor, first, last, shift, of))
        core = W.span_hash(prefix, anchor + shift, anchor + shift + gram)
        hull = W.span_hash(prefix, first + shift, last + shift + length) ^ W.mix64((anchor - first).astype(np.uint64))
        columns = (np.array(rid)[of], np.array(ord_)[of], first * SPAN + last - first, core.view(np.int64), hull.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=NODES)

    def run(batches):
        shard, automaton, ready, rows, size = None, None, False, [], 0
        for batch in batches:
            for here, salt, tag, rid, ord_, base, words, runs in zip(
                    *(batch.column(c).to_pylist() for c in ("shard", "salt", "tag", "rid", "ord", "base", "words", "runs"))):
                if (here, salt) != shard:
                    if rows:
                        yield found(automaton, rows)
                    shard, automaton, ready, rows, size = (here, salt), ahocorasick.Automaton(), False, [], 0
                if tag == 0:
                    pattern = f" {words} ".encode().decode("latin-1")
                    automaton.add_word(pattern, len(pattern))
                    continue
                if not ready:
                    automaton.make_automaton()
                    ready = True
                rows.append((rid, ord_, base, words, runs))
                size += len(words)
                if size >= 1 << 20:
                    yield found(automaton, rows)
                    rows, size = [], 0
        if rows:
            yield found(automaton, rows)
    return run


def _windows(length: int):
    """One row for each window of the open nodes of a stretch."""
    def run(batches):
        for batch in slices(batches, "words", 1 << 20):
            _, _, head, prefix = _laid_out(batch.column("words").to_pylist())
            spans = [np.array(x, np.int64) for x in batch.column("open").to_pylist()]
            of = np.repeat(np.arange(len(spans)), [len(x) for x in spans])
            base, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("base", "size"))
            span = np.concatenate(spans)
            first, more = span // SPAN, span % SPAN
            inside = (first >= base[of]) & (first + more + length <= (base + size)[of])
            first, more, of = first[inside], more[inside], of[inside]
            start = W.ranges(first, more + 1)
            of = np.repeat(of, more + 1)
            at = start + (head - base)[of]
            key = W.span_hash(prefix, at, at + length)
            rid, ord_ = (batch.column(c).to_numpy(zero_copy_only=False)[of] for c in ("rid", "ord"))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (rid, ord_, start, key.view(np.int64))], ["rid", "ord", "first", "key"])
    return run


def occurrences(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(nodes, stretches): every run whose phrase recurs, found by the automata."""
    rows = _documents(docs)
    phrases = saved(rows.select("rid", "text").mapInArrow(_phrases(length, gram), "core long, rid long, run long"), "op6-phrases")
    recurring = saved(phrases.groupBy("core").agg(F.count("*").alias("n"), F.min("rid").alias("owner"))
                      .where("n > 1").select("core", "owner"), "op6-recurring")
    shards = max(1, -(-recurring.count() // SHARD_PHRASES))
    place = F.pmod(F.xxhash64("owner"), F.lit(shards)) * 2 + (F.col("owner") == F.col("rid")).cast("long")
    # repeated rows share a key, so their list holds each run once
    keys = saved(phrases.join(recurring, "core").select("rid", F.struct("run", "core", place.alias("place")).alias("key"))
                 .groupBy("rid").agg(F.collect_set("key").alias("keys"))
                 .select("rid", *[F.col(f"keys.{c}").alias(f"{c}s") for c in ("run", "core", "place")]), "op6-keys")
    drop_saved(phrases, recurring)
    stretches = saved(rows.join(keys.hint("shuffle_hash"), "rid").select("rid", "ord", "text", "runs", "cores", "places")
                      .mapInArrow(_stretches(length, gram), STRETCH_DDL), "op6-stretches")
    drop_saved(keys)
    salts = (stretches.groupBy("shard").agg(F.sum(F.length("words")).alias("size"))
             .select("shard", F.ceil(F.col("size") / SALT_BYTES).cast("int").alias("salts")))
    dealt = (stretches.join(salts, "shard").withColumn("salt", F.explode(F.expr(
        "CASE WHEN tag = 0 THEN sequence(0, salts - 1) ELSE array(cast(pmod(xxhash64(rid, base), salts) AS int)) END")))
        .drop("salts"))
    nodes = saved(dealt.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "tag")
                  .mapInArrow(_search(length, gram), NODE_DDL), "op6-nodes")
    return nodes, stretches


def _check(length: int, gram: int) -> None:
    if not 1 <= gram <= length or length - gram >= SPAN:
        raise ValueError(f"need 1 <= gram <= length < gram + {SPAN}")


def later_windows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(rid, spans): runs of window starts of each text that occur earlier, packed by ``SPAN``."""
    _check(length, gram)
    nodes, stretches = occurrences(docs, length, gram)
    classes = saved(nodes.groupBy("core", "hull").agg(
        F.count("*").alias("n"), F.min(F.struct("ord", "span", "rid")).alias("least")), "op6-classes")
    whole = saved(nodes.join(classes.where("n > 1").select("core", "hull", F.col("least.ord").alias("o"), F.col("least.span").alias("s")),
                             ["core", "hull"])
                  .where("ord <> o OR span <> s").select("rid", "span"), "op6-whole")
    drop_saved(nodes)
    mixed = saved(classes.groupBy("core").agg(F.count("*").alias("m")).where("m > 1").select("core"), "op6-mixed")
    left = saved(classes.join(mixed, "core").groupBy(F.col("least.rid").alias("rid"))
                 .agg(F.collect_set("least.span").alias("open")), "op6-open")
    drop_saved(classes, mixed)
    singles = saved(stretches.where("tag = 1").select("rid", "ord", "base", "size", "words").join(left.hint("shuffle_hash"), "rid")
                    .where(f"exists(open, n -> n div {SPAN} >= base AND n div {SPAN} < base + size)")
                    .mapInArrow(_windows(length), "rid long, ord long, first long, key long"), "op6-windows")
    drop_saved(stretches, left)
    least = (singles.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("ord", "first")).alias("least"))
             .where("n > 1").select("key", F.col("least.ord").alias("o"), F.col("least.first").alias("f")))
    single = singles.join(least, "key").where("ord <> o OR first <> f").select("rid", (F.col("first") * SPAN).alias("span"))
    return whole.unionByName(single).groupBy("rid").agg(F.collect_set("span").alias("spans"))


def _apply(length: int, keep_text: bool):
    def run(batches):
        for batch in slices(batches, "text"):
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = (text or "").encode().split()
                keep = np.ones(len(words), bool)
                for s in spans or ():
                    keep[s // SPAN:s // SPAN + s % SPAN + length] = False
                kept = b" ".join(w for w, k in zip(words, keep.tolist()) if k) if spans else b" ".join(words)
                out.append((len(words), int(len(words) - keep.sum()), hashlib.sha256(kept).hexdigest()) + (kept.decode(),) * keep_text)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            names = ["n_words", "n_removed", "kept_sha256", "kept_text"][:3 + keep_text]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")] + [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                             ["doc_id"] + names)
    return run


def phrase_report(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (and kept_text)."""
    spans = later_windows(docs, length, gram)
    rows = docs.select("doc_id", F.xxhash64(F.col("doc_id").cast("string"), "text").alias("rid"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return (rows.join(spans.hint("shuffle_hash"), "rid", "left").select("doc_id", "text", "spans")
            .mapInArrow(_apply(length, keep_text), f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string"
                        + ", kept_text string" * keep_text))


@REGISTRY("op6_phrase_automata")
def op6(spark, sf_dir):
    """Words of `documents` covered by a 20-word window that also starts earlier."""
    return phrase_report(table(spark, sf_dir, "documents"))
