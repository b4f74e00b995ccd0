"""Connected components over an edge table, without gathering a node's neighbours anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settleflow.llm.common import dropped, stored


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (``a``, ``b``, whole numbers); the root is the smallest node reachable.

    Large-star and small-star steps by turns: every node hooks its neighbours to the smallest one, so
    the depth of a chain shrinks by a factor in each round. A round is two aggregates and two joins on the node;
    a node with many neighbours is reduced before the shuffle and its join is split by adaptive
    execution. Each round's edges are written to the shared folder. Stops when a round changes nothing.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    before = None
    last = None
    while True:
        now = stored(now, "edges")
        if last is not None:
            dropped(last)  # the round before is no longer read
        last = now
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = small.union(low.select("a", F.col("m").alias("b"))).distinct()
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
