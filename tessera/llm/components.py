"""Connected components of an edge table, by alternating large and small stars.

Each round joins every node to the least node among its neighbours (large star:
for the neighbours above it; small star: for those below it).  Rounds end when
the edges no longer change, after about the logarithm of the longest path.
Every round is DataFrame work over the edges, written to the shared folder;
only two numbers a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import drop_saved, saved


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).collect()[0]
    return row.n, row.x


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger node to the smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the least node reachable.

    Loops, repeated edges and nulls in ``u`` or ``v`` are ignored; nodes that
    have no other node as neighbour have no row.  Nodes are any orderable type.
    """
    now = saved(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                "edges")
    state = _state(now)
    while state[0]:
        after = saved(_small_star(_large_star(now).distinct()).distinct(), "edges")
        drop_saved(now)
        now, before, state = after, state, _state(after)
        if state == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
