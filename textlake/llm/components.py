"""Connected components of a table of links, on DataFrames alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scratch import written


def components(links: DataFrame, most_rounds: int = 60, broadcast_links: int = 100_000) -> DataFrame:
    """(node, root) of every node in ``links(a, b)``; root is the least node that can be reached.

    Large-star and small-star in turn (Kiveris et al. 2014): each round joins nodes to the least
    neighbour's, the number of rounds grows with the logarithm of the longest path. A node's
    neighbours are never gathered, only their minimum is; the minima are broadcast where there are at
    most ``broadcast_links`` links, else joined as a table, so that AQE splits a node that a third of
    all links have. Each round is written to the shared folder; rounds end when the links stay as they
    are. Links of a node to itself are passed over.
    """
    meet = lambda rows, least: rows.join(F.broadcast(least) if mark.n <= broadcast_links else written(least, "least"), "u")
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, "links")
    seen = None
    for _ in range(most_rounds):
        mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if not mark.n or mark == seen:
            break
        seen = mark
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = meet(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = meet(large, least).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = written(small.where("u <> v").distinct(), "links")
    else:
        raise RuntimeError("components didn't settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
