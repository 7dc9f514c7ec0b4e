"""Connected components over DataFrames of links, by alternating stars (Kiveris and others, 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.common import checkpointed


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step over links (u, v) with u > v: larger (or smaller) neighbours move to the least neighbour."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("m", "u").alias("m"))
    joined = both.join(least, F.col("u") == F.col("k"))
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("k").alias("u"), F.col("m").alias("v")))
    return out.filter("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (u, v), root being the component's least node.

    Ends when a round changes nothing. Each round is a few shuffles of links, pre-aggregated by node, and
    is cut from its lineage in the shared folder. Loops and repeated links do no harm; no links give no rows.
    """
    now = checkpointed(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct())
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        now = checkpointed(_star(_star(now, True), False))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v"), F.col("v")).distinct())
