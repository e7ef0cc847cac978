"""Connected components by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges ``(a, b)``; the root is the least node
    of the component.  Each step aggregates with partial sums before it shuffles and
    is written out; a node of a third of all edges is joined back by a join that Spark
    can split.  An empty edge table gives an empty result.
    """
    now = edges.filter("a <> b").select("a", "b")
    while True:
        now = stored(_small_star(_large_star(now)).filter("a <> b").distinct(), "stars")
        # done when every node is either a root or points to one root, and never both
        ends = now.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(now.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        if ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).filter("out > 1 or out = 1 and into = 1").isEmpty():
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
