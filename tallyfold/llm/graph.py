"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _state(edges: DataFrame) -> tuple[int, int]:
    """Count and an order-free digest of the edges."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return int(row["n"]), int(row["h"] or 0)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node
    of ``edges`` (long ``u``, ``v``); no rows for an empty list.

    Alternating large-star and small-star steps: every node points its larger,
    then its smaller neighbours to the smallest one around it, until all edges
    lead to a root.  A step is a hash aggregate (combined map-side, so a node
    with very many neighbours is no burden) and a join on the node, whose large
    side AQE may split.  Each round is written to the shared folder.
    """
    stars = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .distinct(), "links")
    before = _state(stars)
    while before[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        merged = small.unionByName(least.select("u", F.col("m").alias("v"))).select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        stars = materialize(merged, "stars")
        after = _state(stars)
        if after == before:
            break
        before = after
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
