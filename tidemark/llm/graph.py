"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.zones import scratch


def stored(frame: DataFrame, *folders: str) -> DataFrame:
    """The frame, written to the shared folder and read again; cuts the lineage.

    Rows may be put in a folder for each value of some columns.
    """
    path = scratch(frame.sparkSession)
    frame.write.partitionBy(*folders).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Links the neighbours of every node to the least of them and itself."""
    if large:
        ends = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        ends = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = ends.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = ends.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where("a != b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every edge leads from a node that has no other to the least of a component."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    sums = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return sums.where("out + into > 1 and out > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node reachable) for every node of an edge.

    Rounds are logarithmic in the number of nodes; each is written out, and only
    whether it was the last comes to the driver. The given edges are read once.
    """
    a, b = edges.columns
    edges = stored(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .distinct()
    )
    while not _settled(edges):
        edges = stored(_stars(_stars(edges, True), False))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
