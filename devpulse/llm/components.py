"""Connected components by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devpulse.llm.common import sent, stored


def nearest(edges: DataFrame) -> DataFrame:
    """The smallest of each node and its neighbours.  Stored, so that the join back reads a plain
    table: one that is sent to all tasks if it is small, and else adaptive execution can split hot
    nodes."""
    return sent(stored(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b: long), root being the smallest node reachable.

    A round takes each node's larger neighbours to its smallest one, then each node's neighbours
    to the smallest below; rounds end when nothing moves, after a number that is logarithmic in
    the longest path.  Nothing but a count comes to the driver.  Loops are ignored."""
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    sign = None
    while True:
        both = now.union(now.select("b", "a"))
        large = both.join(nearest(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # edges that are there twice do no harm until the round ends
        large = stored(large.where("a <> b"))
        joined = large.join(nearest(large), "a")
        small = joined.select("a", F.col("m").alias("b")).union(joined.select("b", "m"))
        now = stored(small.where("a <> b").distinct())
        # equal tables have equal counts and sums of hashes
        found = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == sign:
            break
        sign = tuple(found)
    return now.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.col("b").alias("root")
    ).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
