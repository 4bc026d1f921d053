"""Connected components of long-valued nodes by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.ranges import stored


def smallest_reachable(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b): the smallest node it reaches.

    Large-star and small-star steps in turn. A node with very many neighbours is
    no single group: each step is a minimum by node and a join back, both of
    which combine or split large keys. Each round is written to the shared work
    folder; only two sums of it reach the driver.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        # large star: neighbours above a node are tied to its smallest neighbour
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # small star: a node and its neighbours below are tied to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(low, "a")
        small = tied.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        small = small.select("e.a", "e.b").where("a <> b").distinct()
        edges = stored(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
