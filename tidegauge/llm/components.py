"""Connected components of a table of links, by joins and minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import Folders, stored


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of every node in `links` (a, b: long, without nulls); root is the smallest node
    reachable. Repeated links and links of a node with itself are allowed; a node with the latter only
    is not returned, and a table without links has no nodes. Other columns are not read.

    Alternating stars: every node hangs its larger neighbours on its smallest neighbour, then its
    smaller ones. Minima are aggregated before they are shuffled, joins leave hot nodes to
    Spark's skew handling, and each round is written to the shared folder. The number of rounds
    grows with the logarithm of the longest path.
    """
    folders = Folders(links.sparkSession)
    edges = folders.store(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "links")
    before = None
    while True:
        edges = folders.store(_small_star(_large_star(edges)), "links")
        # The state in a few numbers: equal sums mean equal links but for chance below 2^-60.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = stored(roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()), "roots")
    folders.close()
    return found


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = both.where("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # `a` is the larger end of every link here.
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
