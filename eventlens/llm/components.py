"""Connected components of a sparse link table as Spark joins.

State is one row per linked node; every round takes the least node among the
neighbours, then follows nodes one step, so they travel in doubling strides.
Each round is a written table, and only a count comes to the driver.  The least
label of a component is taken once, at the end, so labels may repeat or be null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import stage_table


def smallest_reachable(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, label)`` for nodes that have links: the least ``label`` in each node's component.

    ``edges`` has columns ``a, b`` (either direction once); ``nodes`` has a
    unique, non-null ``node`` and a ``label``; a null label counts only where a
    component has no other.  Empty links give an empty table.
    """
    spark = edges.sparkSession
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stage_table(spark, both, "links")
    state = stage_table(spark, both.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node")), "roots")
    while True:
        near = (
            both.join(state.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        hooked = state.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        hooked = stage_table(spark, hooked, "roots")
        if hooked.where(F.col("root") < F.col("was")).isEmpty():
            break
        jump = hooked.select(F.col("node").alias("root"), F.col("root").alias("far"))
        state = hooked.join(jump, "root").select("node", F.least("root", "far").alias("root"))
        state = stage_table(spark, state, "roots")
    least = hooked.join(nodes.select("node", "label"), "node").groupBy("root").agg(F.min("label").alias("label"))
    return hooked.join(least, "root").select("node", "label")
