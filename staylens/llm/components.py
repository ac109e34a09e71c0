"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm import common


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b); root is the smallest node it reaches.

    Large-star and small-star rounds in turn: edges move to ever smaller neighbours until
    they stand still. A round costs two aggregations of the edges, the number of rounds grows
    with the logarithm of the largest component. Each round is written to the shared folder,
    so lineage stays short and a lost executor costs one round. Null ends are left out."""
    edges = links.select("a", "b").where("a != b").distinct()
    edges = common.written(spark, edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # a node's larger neighbours (and the node itself) hang on its smallest one
        large = both.join(smallest, "a").select(
            F.when(F.col("b") > F.col("a"), F.col("b")).otherwise(F.col("a")).alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select("a", F.col("m").alias("b")).union(
            small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))).where("a != b").distinct()
        after = common.written(spark, small, "links")
        if after.exceptAll(edges).isEmpty() and edges.exceptAll(after).isEmpty():
            break
        edges = after
    tree = after.distinct().select(F.col("a").alias("node"), F.col("b").alias("root"))
    return tree.unionByName(tree.select("root").distinct().select(F.col("root").alias("node"), "root"))
