"""Connected components of an edge table, for graphs of any size and shape.

Alternating large-star and small-star steps hang every node under the smallest
node known; a hub with many edges is aggregated by partial minima and met again
by an equi-join, which skew handling can split. Each round is cut off by a
written table, and the number of rounds grows with the logarithm of the size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commgraph.runtime import cut

#: Far beyond the logarithm of any size; reaching it is an error.
ROUNDS = 200


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node of ``edges``, ``root`` the smallest node of
    its component. Nulls and loops are left out, repeated edges don't matter;
    an empty table has no nodes. Rounds go on until every node hangs under one
    that hangs under none; unfinished roots are never returned."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    e = cut(e, "edges")
    for _ in range(ROUNDS):
        one = e.groupBy("u").agg(F.min("v").alias("v"), F.max("v").alias("other"))
        tops = one.select("u").join(e.select(F.col("v").alias("u")), "u", "left_semi").select(F.lit(1))
        if one.where("v != other").select(F.lit(1)).unionAll(tops).isEmpty():
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(least, "u")
        small = star.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        e = cut(small.distinct(), "edges")
    else:
        raise RuntimeError(f"no end after {ROUNDS} rounds")
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
