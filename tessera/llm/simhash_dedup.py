"""Near-duplicate groups by SimHash and a segment-popcount grid.

Method: a fingerprint's 64 bits form 32 segments of two; its embedding is the
vector of their bit counts, packed in a long.  The Manhattan distance of two
embeddings is at most the bit distance.  The grid splits the segments into
``links + 2`` groups: fingerprints within ``links`` bits have equal counts in
at least two groups, so one cell for each pair of groups finds every link, and
the join keeps a pair in the first such cell only.  The join's condition tests
the Manhattan bound and then the exact bit distance, so only true links leave
it.  Equal fingerprints are one node.

Defined cases: a null text counts as empty; texts without a word have
fingerprint zero and link like any other; repeated rows share a fingerprint;
null doc_ids take part but are a component's id only where it has no other;
an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import REGISTRY, saved, slices, table
from tessera.llm.components import connected_components

SHINGLE = 4
BITS = 4
SEED = 42
LOW = 0x5555555555555555


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of lower-cased (A-Z) word shingles, bit set if in over half of them."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(joined)][min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    total, n = np.zeros(64, np.int64), len(ends)
    for at in range(0, n, 1 << 16):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[at:at + (1 << 16)], ends[at:at + (1 << 16)])], ">u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches):
        for batch in slices(batches, "text"):
            f = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("rid"), pa.array(f.view(np.int64))],
                                             ["doc_id", "rid", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, rid, fp): rid is a key of the row's content."""
    rows = docs.select("doc_id", F.xxhash64(F.col("doc_id").cast("string"), "text").alias("rid"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_fingerprints(shingle), f"doc_id {kind}, rid long, fp long")


def _signed(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


def counts(fp: Column) -> Column:
    """The embedding: a two-bit count for each two-bit segment."""
    high, low = F.shiftrightunsigned(fp, 1), fp
    both = high.bitwiseAND(low).bitwiseAND(_signed(LOW))
    return high.bitwiseXOR(low).bitwiseAND(_signed(LOW)).bitwiseOR(F.shiftleft(both, 1))


def manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance of two embeddings (counts 0, 1, 2 in two bits each)."""
    d = a.bitwiseXOR(b)
    high = F.shiftrightunsigned(d, 1)
    return (F.bit_count(high.bitwiseAND(_signed(LOW))) * 2 + F.bit_count(d.bitwiseAND(_signed(LOW)))
            - F.bit_count(high.bitwiseAND(d).bitwiseAND(_signed(LOW))) * 2)


def _groups(n: int) -> list[int]:
    """Masks of ``n`` groups of whole segments."""
    edges = [32 * i // n for i in range(n + 1)]
    return [sum(3 << (2 * s) for s in range(a, z)) for a, z in zip(edges, edges[1:])]


def links(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """(u, v) with u < v for all fingerprints (column fp, distinct) within ``bits`` bits."""
    masks = _groups(bits + 2)
    cells = list(combinations(range(len(masks)), 2))
    count = counts(F.col("fp"))
    keys = F.array(*[F.struct(F.lit(k).alias("cell"), count.bitwiseAND(_signed(masks[i] | masks[j])).alias("at"))
                     for k, (i, j) in enumerate(cells)])
    grid = nodes.select("fp", F.explode(keys).alias("key")).select("fp", "key.cell", "key.at")
    a, b = grid.alias("a"), grid.alias("b")
    u, v = F.col("a.fp"), F.col("b.fp")
    differ = counts(u).bitwiseXOR(counts(v))
    first = reduce(lambda acc, k: acc.when(F.col("a.cell") == k, reduce(
        Column.__and__, [differ.bitwiseAND(_signed(masks[g])) != 0 for g in range(cells[k][1]) if g != cells[k][0]],
        F.lit(True))), range(1, len(cells)), F.when(F.col("a.cell") == 0, F.lit(True)))
    near = (F.bit_count(u.bitwiseXOR(v)) <= bits)
    return a.join(b, (F.col("a.cell") == F.col("b.cell")) & (F.col("a.at") == F.col("b.at")) & (u < v)
                  & (manhattan(counts(u), counts(v)) <= bits) & near & first).select(u.alias("u"), v.alias("v"))


def members(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """(fp, root, component_id, n_links) of each distinct fingerprint of :func:`fingerprints`.

    ``root`` is the group's least fingerprint; ``component_id`` may be null or shared by groups.
    """
    nodes = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "op7-nodes")
    pairs = saved(links(nodes, bits), "op7-links")
    degree = pairs.select("u").unionByName(pairs.select(F.col("v").alias("u"))).groupBy("u").agg(F.count("*").alias("n_links"))
    roots = connected_components(pairs).withColumnRenamed("node", "fp")
    member = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = member.groupBy("root").agg(F.min("least").alias("component_id"))
    return saved(member.join(ids, "root").join(degree.withColumnRenamed("u", "fp"), "fp", "left")
                 .select("fp", "root", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")), "op7-members")


def groups(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """(doc_id, rid, fp, root, component_id, n_links): the fingerprint's group and its links to others."""
    rows = saved(fingerprints(docs, shingle), "op7-fingerprints")
    return rows.join(members(rows, bits), "fp")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One document of each group: that with the smallest doc_id (null last; repeated rows: one)."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    rows = saved(fingerprints(docs, shingle), "op7-fingerprints")
    # the least row of a fingerprint is known before the join, so a hot fingerprint sends one row to it
    least = rows.groupBy("fp").agg(F.min(order).alias("first"))
    kept = (least.join(members(rows, bits).select("fp", "root"), "fp")
            .groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.rid").alias("_rid")))
    return _only(docs, kept)


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    packed = docs.select(row.alias("doc"), F.xxhash64(F.col("doc_id").cast("string"), "text").alias("rid"))
    once = (packed.join(kept.select(F.col("_rid").alias("rid")).hint("shuffle_hash"), "rid", "left_semi")
            .dropDuplicates(["rid"]))
    return once.select(*[F.col(f"doc.c{i}").alias(c) for i, c in enumerate(docs.columns)])


@REGISTRY("op7_simhash_near_dedup")
def op7(spark, sf_dir):
    """Fingerprint and group of every document."""
    return groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links")
