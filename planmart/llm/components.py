"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planmart.llm.common import written

MAX_ROUNDS = 60


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b: bigint); component = smallest node.

    Each round hangs a node's larger neighbours on its smallest neighbour
    (large star), then its smaller neighbours as well (small star).  Both are a
    minimum per node (combined before the shuffle) and a join back to the
    links, so a node with very many links is never gathered in one task.  The
    rounds grow with the logarithm of the longest path.  Links from a node to
    itself and links holding NULL are left out; no links give no rows.
    """
    a, b = F.col("a"), F.col("b")
    edges = written(links.where(a != b)
                    .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    mark = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(b.alias("a"), a.alias("b")))
        least = (both.groupBy("a").agg(F.min("b").alias("m"))
                     .select("a", F.least("a", "m").alias("m")))
        large = (both.where(b > a).join(least, "a")
                     .select(b.alias("a"), F.col("m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = written(small.where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
                        .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                        F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    stars = edges.select(a.alias("node"), b.alias("component"))
    return stars.unionByName(stars.select("component", F.col("component").alias("x")).distinct()
                             .toDF("node", "component"))
