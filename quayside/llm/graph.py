"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import stored

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node reachable.

    Each round hangs every node's larger neighbours, then its smaller ones, on the smallest
    neighbour it knows. Minima combine before they are shuffled and adaptive execution splits
    the join on a node with many edges, so no node's neighbours are gathered. The table of each
    round is written to the shared folder. Rounds grow with the logarithm of the edges.
    """
    now = stored(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct(), "stars"
    )
    before = None
    for _ in range(MAX_ROUNDS):
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
        if not mark[0] or mark == before:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
                now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
            )
        before = mark
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi")
        now = stored(
            small.select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionByName(small.select("hi", F.col("m").alias("lo")))
            .where("hi <> lo")
            .distinct(),
            "stars",
        )
    raise RuntimeError("components did not settle")
