"""Connected components of a graph given by edges, by alternating large and small stars.

Every round is a pre-aggregated minimum per vertex and a join, written to the shared folder; nothing
about the graph comes to the driver but whether a round changed it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobloom.sources.storage import shared_folder


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is linked to the least vertex around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a vertex, and the vertex itself, is linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def connected(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(vertex, component) from edges (a, b) of longs; the component is its least vertex.

    Vertices without an edge to another one are not listed.
    """
    spark = edges.sparkSession

    def written(df: DataFrame) -> DataFrame:
        path = shared_folder(spark, "components")
        df.where(F.col("a") != F.col("b")).distinct().write.parquet(path)
        return spark.read.parquet(path)

    now, state = written(edges), None
    for _ in range(most_rounds):
        now = written(_small_star(_large_star(now)))
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == (seen["n"], seen["h"]):
            break
        state = (seen["n"], seen["h"])
    else:
        raise RuntimeError("the components did not settle")
    roots = now.select(F.col("b").alias("vertex")).distinct().withColumn("component", F.col("vertex"))
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("component")).unionByName(roots)
