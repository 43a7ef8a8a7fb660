"""Connected components of an edge list, by alternating stars.

Each round hangs a node's larger neighbours on the least node it knows
(large star) and then its smaller ones (small star), until nothing changes;
the number of rounds grows with the logarithm of the longest path.  The rows
of a round are no more than the edges, a node's neighbours are only ever
reduced by ``min`` (a partial aggregate), and the tables between rounds are
reliable checkpoints, so neither a hub nor a lost executor starts it anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from risingtide.session import materialize


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The distinct edges, materialised, and a fingerprint of them."""
    seen = Observation()
    h = F.xxhash64("u", "v")
    out = materialize(edges.where("u != v").distinct().observe(
        seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("x"),
        F.coalesce(F.sum(h % 1_000_003), F.lit(0)).alias("s")))
    r = seen.get
    return out, (r["n"], r["x"], r["s"])


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (columns ``u``, ``v`` of
    one ordered type): the root is the least node of its component."""
    e, mark = _kept(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    while mark[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large, _ = _kept(both.join(least, "u").select(F.greatest("u", "v").alias("u"), F.col("m").alias("v")))
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(m, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                         F.col("m").alias("v"))
        e, now = _kept(hung)
        if now == mark:
            break
        mark = now
    leaves = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return leaves.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
                              .join(leaves, "node", "left_anti"))
