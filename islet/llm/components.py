"""Connected components by alternating stars, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from islet.llm.common import free_shuffles, stage

#: Links that a task of a round holds.
TASK_LINKS = 1 << 18


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links(a, b)``; component is the
    smallest id that can be reached.

    Each round links every larger neighbour of a node to the smallest one
    (large star), then every smaller (small star).  Rounds end once the links
    stay the same: logarithmic in the longest path.  A node with very many
    neighbours is an aggregate with partial sums and the large side of a join,
    which AQE splits.  A round has a task for each ``TASK_LINKS`` of its links
    (at most; the last rounds of many small ones would be all overhead), so few
    links need no shuffle at all.  Null ids and loops are ignored.
    """
    spark = links.sparkSession
    edges = stage(links.select("a", "b").filter("a <> b").distinct(), "links")
    mark = None
    while True:
        new = _mark(edges)
        if new == mark or not new[0]:
            break
        mark = new
        tasks = -(-new[0] // TASK_LINKS)
        edges = edges.coalesce(tasks)
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(tasks)
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").coalesce(tasks).distinct()
        # every link now points from a larger to a smaller id
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = stage(small.filter("a <> b").coalesce(tasks).distinct(), "links")
        free_shuffles(spark)
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots).groupBy("id").agg(F.min("component").alias("component"))


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of links: their number and two sums of hashes."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.hash("b", "a").cast("long"))).first())
