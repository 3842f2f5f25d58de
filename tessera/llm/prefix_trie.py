"""Trie of conversations that share their first turns, by vertical bitmaps.

A node of depth d is a distinct sequence of first d turns (role, text); its
members are the conversations that start with it.

Method: conversations are cut into shards of consecutive ids and their
positions into blocks.  In a shard's block every (position, turn) has a bitset
of the conversations that hold it.  The walk goes depth first: from a node's
bitset it takes the first conversation left, intersects the bitset with the
posting of that conversation's next turn, which gives a child, and goes on with
the rest.  Popcounts, least members and lists of members that end at the node
come from the bitsets.  Nodes of different shards meet by the 128-bit XOR of the
hashes of (position, turn) on their path, which names a node wherever it is
found.  Sums over subtrees take a node's share in the shard of its least member
only: a shard lists its nodes in preorder, so that a subtree is a range, and a
node's sums over all shards are added up.

A shard holds at most ``shard_turns`` turns of conversations that begin in it
and one more, a block ``block`` positions, so no task holds more than that of a
hot conversation, first turn or prefix.  Members are never collected: end lists
are hashed as a stream, shard after shard, which is in order of the ids.

Defined cases: turns are ordered by turn (null first), then role, then a hash of
the text; a null role or text is empty.  Rows without a conv_id belong to no
conversation.  Repeated rows are repeated turns.  conv_id is any integer (the
remainder of a negative one is negative, as in SQL).  An empty table gives no
node.  Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import REGISTRY, drop_saved, saved, table
from tessera.operators.ratings import dense_index

SHARD_TURNS = 4096
BLOCK = 512
#: Conversations of a hundred take their first turns (at most 5) from the first of them.
SHARED, MOST = 100, 5

NODES = ("shard long, block long, pre long, post long, k1 long, k2 long, p1 long, p2 long, depth long, "
         "n long, first long, len long, ends string")


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, ix, a1, a2, len): turns numbered by conversation and order, hashed; written."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        F.xxhash64(role, text).alias("a1"), F.xxhash64(F.lit(11), text, role).alias("a2"), F.length(text).cast("long").alias("len"))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "a1", "a2"]
    return saved(dense_index(rows, order, "ix").select("conv_id", "ix", "a1", "a2", "len"), "op11-turns")


def rebuilt(turns: DataFrame, shared: int = SHARED, most: int = MOST):
    """((conv_id, first, total), (conv_id, first, pos, a1, a2, len)) of the rebuilt conversations.

    Conversation c takes h = crc32(c) % (most + 1) turns from conversation
    c - c % shared, then its own after its first h.  ``first`` is its place in
    the numbering.
    """
    heads = turns.groupBy("conv_id").agg(F.min("ix").alias("first"), F.count("*").alias("n"))
    heads = heads.select("conv_id", "first", "n", (F.col("conv_id") - F.col("conv_id") % shared).alias("base"),
                         F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most + 1)).alias("h"))
    has = heads.where("conv_id = base").select("base", F.least("n", F.lit(most)).alias("has"))
    heads = saved(heads.join(has, "base", "left").withColumn("taken", F.least("h", F.coalesce("has", F.lit(0)))), "op11-heads")
    own = turns.join(heads, "conv_id").withColumn("o", F.col("ix") - F.col("first") + 1)
    lent = own.where((F.col("conv_id") == F.col("base")) & (F.col("o") <= most)).select("base", "o", "a1", "a2", "len")
    taken = heads.select("conv_id", "base", "first", "h").join(lent, "base").where("o <= h")
    rows = (own.where("o > h").select("conv_id", "first", (F.col("taken") + F.col("o") - F.col("h")).alias("pos"), "a1", "a2", "len")
            .unionByName(taken.select("conv_id", "first", F.col("o").alias("pos"), "a1", "a2", "len")))
    total = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return heads.select("conv_id", "first", total.alias("total")), rows


def postings(heads: DataFrame, rows: DataFrame, shard_turns: int, block: int) -> DataFrame:
    """(shard, block, conv_id, pos, h1, h2, len), written.

    A conversation's entry in a block is the row with the block's first depth as
    ``pos``, the hash of its path so far and, as ``len``, its number of turns.
    """
    shard = F.floor(F.col("first") / F.lit(shard_turns)).cast("long").alias("shard")
    own = rows.select(shard, F.floor((F.col("pos") - 1) / F.lit(block)).cast("long").alias("block"), "conv_id", "pos",
                      F.xxhash64("a1", "pos").alias("h1"), F.xxhash64("a2", "pos").alias("h2"), "len")
    start = heads.select(shard, F.lit(0).cast("long").alias("block"), "conv_id", F.lit(0).cast("long").alias("pos"),
                         F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"), F.col("total").alias("len"))
    long = heads.where(F.col("total") > block).select("conv_id", "total")
    parts = own.join(long, "conv_id").groupBy("shard", "conv_id", "block", "total").agg(F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
    before = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    entries = (parts.select("shard", "block", "conv_id", (F.col("block") * block).alias("pos"), F.bit_xor("h1").over(before).alias("h1"),
                            F.bit_xor("h2").over(before).alias("h2"), F.col("total").alias("len")).where("block > 0"))
    return saved(own.unionByName(start).unionByName(entries), "op11-postings")


def _walk(block: int):
    """Nodes of one shard's block, in preorder."""
    def run(t: pa.Table) -> pa.Table:
        shard, base = t.column("shard")[0].as_py(), t.column("block")[0].as_py() * block
        conv, pos, h1, h2, size = (t.column(c).to_numpy() for c in ("conv_id", "pos", "h1", "h2", "len"))
        ids = np.unique(conv)
        at = np.searchsorted(ids, conv).tolist()
        ids = ids.tolist()
        turn = {}                           # (conversation, position) -> turn
        holds = defaultdict(int)            # (position, turn) -> bitset
        length, entry = {}, defaultdict(int)
        end = defaultdict(int)              # depth -> bitset of conversations that end there
        for c, p, x, y, n in zip(at, pos.tolist(), h1.tolist(), h2.tolist(), size.tolist()):
            if p == base:
                entry[x, y] |= 1 << c
                end[n] |= 1 << c
            else:
                turn[c, p] = x, y
                holds[p, x, y] |= 1 << c
                length[p, x, y] = n
        out: list[list] = []

        def emit(depth, key, parent, members, n):
            here, ends = members & end.get(depth, 0), []
            while here:
                low = here & -here
                ends.append(str(ids[low.bit_length() - 1]))
                here ^= low
            out.append([len(out), 0, *key, *parent, depth, members.bit_count(), ids[(members & -members).bit_length() - 1], n, ",".join(ends)])
            return len(out) - 1

        for key, members in entry.items():
            place = -1 if base else emit(0, key, (0, 0), members, 0)
            stack = [(base, key, members, place)]  # (depth, key, members whose next turn is to be followed, row)
            while stack:
                depth, key, left, place = stack.pop()
                left &= ~end.get(depth, 0)
                if not left or depth == base + block:
                    if place >= 0:
                        out[place][1] = len(out)
                    continue
                x, y = turn[(left & -left).bit_length() - 1, depth + 1]
                child = left & holds[depth + 1, x, y]
                stack.append((depth, key, left ^ child, place))
                path = key[0] ^ x, key[1] ^ y
                stack.append((depth + 1, path, child, emit(depth + 1, path, key, child, length[depth + 1, x, y])))
        names = ["pre", "post", "k1", "k2", "p1", "p2", "depth", "n", "first", "len", "ends"]
        columns = list(zip(*out)) or [()] * len(names)
        found = {c: pa.array(v, pa.string() if c == "ends" else pa.int64()) for c, v in zip(names, columns)}
        same = {"shard": pa.array([shard] * len(out), pa.int64()), "block": pa.array([base // block] * len(out), pa.int64())}
        return pa.table(same | found)
    return run


def _ranges(t: pa.Table) -> pa.Table:
    """Sums over each node's range of one shard's block."""
    pre, post = t.column("pre").to_numpy(), t.column("post").to_numpy()
    order = np.argsort(pre)
    sums = []
    for c in ("leaf", "save"):
        run = np.r_[0, np.cumsum(t.column(c).to_numpy()[order])]
        sums.append(run[post] - run[pre])
    return pa.table({"k1": t.column("k1"), "k2": t.column("k2"), "leaves": sums[0], "saved": sums[1]})


def _digests(batches):
    """SHA-256 of the joined end lists of each node, rows sorted by (k1, k2, shard)."""
    now, digest = None, None
    done: list[tuple] = []

    def batch():
        k1, k2, sha = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(sha)], ["k1", "k2", "ends_sha256"])
    for b in batches:
        for k1, k2, ends in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "ends"))):
            if (k1, k2) != now:
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest, glue = (k1, k2), hashlib.sha256(), b""
            digest.update(glue + ends.encode())
            glue = b","
        if len(done) > 10_000:
            yield batch()
            done = []
    if now is not None:
        done.append((*now, digest.hexdigest()))
        yield batch()


def trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS, block: int = BLOCK) -> DataFrame:
    """A row for each node: conv_id (least member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, and the node's and its parent's
    keys (k1, k2, p1, p2)."""
    key, group = ["k1", "k2"], ["shard", "block"]
    heads, rows = rebuilt(numbered(conversations))
    lists = postings(heads, rows, shard_turns, block)
    found = saved(lists.groupBy(*group).applyInArrow(_walk(block), NODES), "op11-found")
    merged = found.groupBy(*key).agg(F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("depth").alias("depth"),
                                     F.sum("n").alias("n"), F.min("first").alias("conv_id"), F.first("len").alias("len"))
    children = found.where("depth > 0").select("p1", "p2", *key).distinct().groupBy("p1", "p2").agg(F.count("*").alias("n_children"))
    nodes = saved(merged.join(children.toDF(*key, "n_children"), key, "left")
                  .withColumn("n_children", F.coalesce("n_children", F.lit(0))), "op11-nodes")
    # a node's share counts where its least member is
    share = nodes.select(*key, "conv_id", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n") - 1) * F.col("len")).alias("save"))
    here = F.col("first") == F.col("conv_id")
    ranged = saved(found.select(*group, *key, "pre", "post", "depth", "first").join(share, key)
                   .select(*group, *key, "pre", "post", "depth", "first", *[F.when(here, F.col(c)).otherwise(0).alias(c) for c in ("leaf", "save")]), "op11-shares")
    # what a conversation owns in later blocks counts from its last node of a block
    entries = lists.where((F.col("block") > 0) & (F.col("pos") == F.col("block") * block))
    owned = ranged.where("block > 0").groupBy("block", F.col("first").alias("conv_id")).agg(F.sum("leaf").alias("leaf"), F.sum("save").alias("save"))
    later = W.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, 0)
    carried = (entries.join(owned, ["block", "conv_id"], "left").select("shard", (F.col("block") - 1).alias("block"), F.col("h1").alias("k1"), F.col("h2").alias("k2"),
               *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias("more_" + c) for c in ("leaf", "save")])
               .groupBy(*group, *key).agg(F.sum("more_leaf").alias("more_leaf"), F.sum("more_save").alias("more_save")))
    summed = (ranged.join(carried, [*group, *key], "left")
              .select(*group, *key, "pre", "post", *[(F.col(c) + F.coalesce("more_" + c, F.lit(0))).alias(c) for c in ("leaf", "save")])
              .groupBy(*group).applyInArrow(_ranges, "k1 long, k2 long, leaves long, saved long")
              .groupBy(*key).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")))
    ends = (found.where("ends <> ''").select(*key, "shard", "ends").repartition(*key).sortWithinPartitions(*key, "shard")
            .mapInArrow(_digests, "k1 long, k2 long, ends_sha256 string"))
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    root = nodes.where("depth = 0").join(summed, key).join(ends, key, "left").withColumn("parent_conv_id", F.lit(None).cast("long"))
    rest = nodes.where("depth > 0").join(summed, key).join(ends, key, "left").join(parents, ["p1", "p2"])
    cols = ["conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"), "k1", "k2", "p1", "p2"]
    out = saved(root.select(*cols).unionByName(rest.select(*cols)), "op11-trie")
    drop_saved(found, nodes, ranged, lists)
    return out


CRC = "list_reduce(list_prepend(4294967295, list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i, 1)))), lambda c, b: " \
      "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384)))"

SQL = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, '')) AS o FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % {SHARED} AS base, xor({CRC}, 4294967295) % {MOST + 1} AS h FROM (
    SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM t)),
r AS (SELECT c.conv_id, t.role, t.text, t.o FROM c JOIN t ON t.conv_id = c.base AND t.o <= c.h
    UNION ALL SELECT c.conv_id, t.role, t.text, t.o FROM c JOIN t ON t.conv_id = c.conv_id AND t.o > c.h),
k AS MATERIALIZED (SELECT conv_id, row_number() OVER w AS depth, length(text) AS len,
    md5(string_agg(md5(role) || md5(text), '' ) OVER w) AS key FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY o)
    UNION ALL SELECT conv_id, 0, 0, '' FROM c),
total AS (SELECT conv_id, max(depth) AS depth FROM k GROUP BY conv_id),
n AS MATERIALIZED (SELECT key, min(k.depth) AS depth, min(k.conv_id) AS conv_id, count(*) AS n, min(len) AS len,
    coalesce(string_agg(CAST(k.conv_id AS VARCHAR), ',' ORDER BY k.conv_id) FILTER (k.depth = total.depth), '') AS ends
    FROM k JOIN total USING (conv_id) GROUP BY key),
up AS MATERIALIZED (SELECT a.key, b.key AS parent FROM n a JOIN k b ON b.conv_id = a.conv_id AND b.depth = a.depth - 1),
kids AS MATERIALIZED (SELECT parent AS key, count(*) AS n FROM up GROUP BY parent),
below AS (SELECT k.key, sum(CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END) AS leaves, sum((d.n - 1) * d.len) AS saved
    FROM n d LEFT JOIN kids ON kids.key = d.key JOIN k ON k.conv_id = d.conv_id AND k.depth <= d.depth GROUP BY k.key)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(n.n AS BIGINT) AS n_convs, CAST(coalesce(kids.n, 0) AS BIGINT) AS n_children,
    CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN below USING (key) LEFT JOIN kids ON kids.key = n.key LEFT JOIN up ON up.key = n.key LEFT JOIN n p ON p.key = up.parent"""


@REGISTRY("op11_prefix_trie", SQL)
def op11(spark, sf_dir):
    """Every node of the trie of the rebuilt conversations."""
    return trie(table(spark, sf_dir, "conversations")).drop("k1", "k2", "p1", "p2")
