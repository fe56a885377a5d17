"""Connected components of an edge list by alternating star contractions, each step a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b) that is not the smallest of its component.

    Ids are longs; null ends are ignored, loops and repeated edges harmless. Every round hangs neighbours onto the
    smallest one known, so the number of rounds grows with the logarithm of the longest path. Hot nodes meet their
    neighbours in joins, which Spark can split.
    """
    spark = edges.sparkSession
    folder, before, step = shared_path(spark, "components"), None, 0
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        hung = edges.join(least, "a")  # smaller neighbours and the node itself go to the smallest of them
        small = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(
            least.select("a", F.col("m").alias("b"))
        ).distinct()
        both = small.unionByName(small.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(around, "a").filter(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.col("m").alias("b")
        ).filter("a <> b").distinct()
        large.write.parquet(f"{folder}/{step}")
        edges = spark.read.parquet(f"{folder}/{step}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before, step = now, step + 1
