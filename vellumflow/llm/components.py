"""Connected components of a table of links, by joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumflow.llm.common import written

# Each round at least halves what is left of paths, so this many rounds reach any component.
MOST_ROUNDS = 80


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links(a, b)``; root is the smallest node reachable.

    Rounds of two steps: each node's links all go to the smallest node known to
    it, first those to larger nodes, then those to smaller ones, until nothing
    changes. Links end as stars. A node's neighbours are never gathered: minima
    are aggregated before the shuffle, and joins on a node with very many links
    can be split by adaptive execution. Each round is a table in the shared
    folder. Nulls and links of a node to itself do nothing.
    """
    edges = written(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(MOST_ROUNDS):
        # a > b in every edge. Larger nodes move to the smallest neighbour of the other end.
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("mid"), F.least("a", "least").alias("least"))
        large = edges.join(least, edges.b == least.mid).select("a", F.col("least").alias("b")).distinct()
        # Every node keeps a link to its smallest neighbour, and its other neighbours get linked to that.
        small = large.groupBy("a").agg(F.min("b").alias("least"))
        moved = large.join(small, "a").select(F.greatest("b", "least").alias("a"), F.least("b", "least").alias("b")).where("a != b")
        following = written(small.select("a", F.col("least").alias("b")).union(moved).distinct(), "links")
        stars = following.count() == following.select("a").distinct().count()
        if stars and not following.join(following.select(F.col("a").alias("b")), "b", "left_semi").take(1):
            edges = following
            break
        edges = following
    else:
        raise RuntimeError("links did not come to rest")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
