"""Connected components by alternating star rounds, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import shared_table


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` to ``(node, root)``: for every node with a link, the
    smallest node it can reach (a root is its own root).  Links may repeat, run
    either way or join a node to itself; an empty input gives no rows.

    Each round links every node's larger neighbours to its smallest one (large
    star), then every node and its smaller neighbours to the smallest (small
    star).  Both keep the components and end with each node linked to its root,
    after a number of rounds that grows with the logarithm of the diameter.  Every
    round is written to the shared folder.  A hub's links meet only in joins
    with one row per node, which adaptive execution splits.
    """
    links = shared_table(
        edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        "links",
    )
    while True:
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = shared_table(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = shared_table(
            both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), "large"
        )
        low = shared_table(large.groupBy("hi").agg(F.min("lo").alias("m")), "low")
        small = large.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        links = shared_table(small.unionByName(low.select("hi", F.col("m").alias("lo"))).distinct(), "links")
        # Done when every node has one link and no root has one.
        ends = links.select(F.col("hi").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            links.select(F.col("lo").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        )
        open_ = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)")
        if open_.isEmpty():
            break
    nodes = links.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return nodes.unionByName(links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
