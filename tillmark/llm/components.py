"""Connected components of links between long ids, as alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.session import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    below = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.unionByName(least.withColumnRenamed("m", "v")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every linked node, the root being the smallest id it can reach.

    ``links`` has long columns ``a`` and ``b``. Each round joins the links with the smallest neighbour
    of every node (a grouped minimum, so a node with many links is no large group) and is written to
    the checkpoint folder; a forest of stars is reached in a logarithmic number of rounds. Nulls and
    links of a node to itself are left out, repeated links count once, no links give no rows.
    """
    pairs = links.where("a is not null and b is not null and a != b")
    edges = checkpointed(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _state(edges)
    while state[0]:
        edges = checkpointed(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
