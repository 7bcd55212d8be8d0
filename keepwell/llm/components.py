"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from keepwell.llm.shared import release, stored


def _step(links: DataFrame) -> DataFrame:
    """One large-star step, then one small-star step, over stored links ``(a, b)`` with ``a > b``; stored, the links released.

    The least neighbour of a hub is an aggregate combined before its shuffle. It is stored before it joins the links, so that
    the join reads plain rows and adaptive execution can split a hub with very many of them.
    """
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    lifted = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = stored(lifted.distinct(), "large")
    low = stored(large.groupBy("a").agg(F.min("b").alias("m")), "low")
    onto = large.join(low, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    out = stored(onto.union(low.select("a", F.col("m").alias("b"))).distinct(), "links")
    release(links, least, large, low)
    return out


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``: root is the least node that is reachable.

    Steps repeat until nothing changes; each is stored, so no lineage grows. Nodes without a link, links of a
    node to itself and repeated links are allowed; the first do not appear in the result.
    """
    oriented = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, seen = stored(oriented, "links"), None
    while True:
        now = _step(now)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b"), F.col("b")).distinct()
    )
