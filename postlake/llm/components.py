"""Connected components by alternating star contractions.

Large-star links every larger neighbour of a node to the node's smallest
neighbour; small-star does so for the smaller neighbours.  In a few rounds each
component becomes one star around its smallest node.  A round is group-bys
and joins on narrow rows; nothing but two numbers a round comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from postlake.llm.common import materialised


def _star(edges: DataFrame) -> DataFrame:
    """Per node its smallest neighbour, joined back to the neighbours.

    The join has the constant column ``one`` of the aggregate as a further
    key, so both of its sides come straight from an exchange and AQE can split
    a hub whose neighbours fill a partition.
    """
    low = edges.groupBy("u").agg(F.min("v").alias("m"), F.max("one").alias("one"))
    return edges.join(low, ["u", "one"])


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"), "one"))
    s = _star(both).withColumn("m", F.least("u", "m"))
    return s.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"), "one").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    s = _star(e)
    down = s.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"), "one")
    return down.unionByName(s.select("u", F.col("m").alias("v"), "one")).distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``edges`` (u, v), in any direction, repeated or not.  Returns one row
    (node, component) per node that has an edge to another node; component is
    the smallest node reachable.  Rows with a NULL end and self-loops are
    ignored."""
    e = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"),
                                     F.lit(1).alias("one")).distinct()
    e = materialised(e)
    seen = None
    for _ in range(max_rounds):
        now = e.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen or not now[0]:
            break
        seen = tuple(now)
        e = materialised(_small_star(_large_star(e)))
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
