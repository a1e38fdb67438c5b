"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import written


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b"), F.col("a")))


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its smallest neighbour."""
    ways = _both_ways(links)
    # Written, here and below, so that the join deals both sides out and can split a hub.
    least = written(ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    return (ways.join(least, "a").where("b > a")
            .select(F.col("m").alias("a"), "b").where("a < b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    least = written(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = down.join(least, "a").select(F.col("m").alias("a"), "b").where("a < b")
    kept = least.select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.union(kept).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; the root is the smallest node reached.

    Each round is written to the shared folder, so the lineage stays short; the number of
    rounds grows with the logarithm of the longest chain. Self links and repeated links are
    ignored, a null end drops its link. No table leaves the executors.
    """
    links = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .where("a < b").distinct(), "links")
    while True:
        links = written(_small_star(_large_star(links)), "star")
        # Done when every larger end has one link and no smaller end is itself a larger one.
        roots = links.select("a").distinct()
        chained = links.select("b").join(roots, F.col("b") == F.col("a"), "left_semi")
        twice = links.groupBy("b").count().where("count > 1").select("b")
        if not chained.union(twice).limit(1).count():
            break
    return links.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
