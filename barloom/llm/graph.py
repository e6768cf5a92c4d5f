"""Connected components of a table of links, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, stored


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (bigint columns a, b); root is the least node reached.

    Alternates two steps until nothing changes: every node points its larger neighbours
    to the least node it knows (large star), then its smaller ones (small star). Each
    round is written below the checkpoint folder; the number of rounds grows with the
    logarithm of the links. Only one count and one checksum per round reach the driver.
    Null ends and loops are left out.
    """
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = stored(links.where("a <> b").select(high, low).distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # Here every edge goes from the larger node u to a smaller one.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        newer = stored(small.where("u <> v").distinct())
        release(edges)
        edges = newer
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            break
        before = state
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    own = edges.select(F.col("v").alias("node")).distinct().join(roots, "node", "left_anti")
    return roots.union(own.select("node", F.col("node").alias("root")))
