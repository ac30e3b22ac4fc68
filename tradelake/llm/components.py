"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import checkpointed


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the least of u and all its v.

    Both sides of the join are stored tables, so that adaptive execution can
    split the edges of a node that has very many.
    """
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
    return edges.join(checkpointed(least), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = checkpointed(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    found = _with_least(checkpointed(edges))
    others = found.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return others.union(found.select("u", F.col("least").alias("v")))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root``: every node of a link and the least node it can reach.

    Rounds of large and small stars, each stored in the checkpoint folder, until
    none changes an edge; their number grows with the logarithm of the longest
    path.  Links and components stay on the executors.
    """
    edges = checkpointed(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    state = None
    while True:
        edges = checkpointed(_small_star(_large_star(edges).distinct()).distinct())
        now = edges.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
