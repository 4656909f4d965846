"""Connected components by alternating large-star and small-star rounds
(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankforge.llm.common import settle


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(u, v) links to (node, root): root is the smallest node that can be reached.

    Nodes without a link to another node get no row.  Every round is two
    aggregations and two joins on the node, whose large keys adaptive
    execution splits; its result is written to the shared folder.  The number
    of rounds grows with the logarithm of the longest chain.  Raises
    RuntimeError if ``max_rounds`` do not suffice.
    """
    a, b = F.greatest("u", "v"), F.least("u", "v")
    now = settle(edges.filter(F.col("u") != F.col("v")).select(a.alias("a"), b.alias("b"))
                 .distinct(), "components")
    before = None
    for _ in range(max_rounds):
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = mark
        both = now.select(F.col("a").alias("x"), F.col("b").alias("y")).union(
            now.select(F.col("b").alias("x"), F.col("a").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select(
            "x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").filter(F.col("y") > F.col("x")).select(
            F.col("y").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").filter(F.col("b") != F.col("m"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        now = settle(small, "components")
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
