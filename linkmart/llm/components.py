"""Connected components of an edge table by label propagation with pointer jumping.

Every round is two joins and one partial aggregate over tables in the shared scratch
folder. A hub's edges sit on the probe side of a join whose other side holds one row per
node, so AQE can split them. No side is broadcast: all of them grow with the edges, and nothing
but one row of a look for changes reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmart.llm.common import merging, stored


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(node, root)``: each node of an edge and the smallest node it
    reaches. Self-loops, repeated edges and NULL ends add nothing; no edges give no rows.
    """
    both = edges.where("a <> b")
    both = stored(spark, both.select("a", "b").union(both.select("b", "a")).distinct(), "cc-edges")
    labels = stored(
        spark,
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        .select("node", F.least("node", "m").alias("root")),
        "cc-labels",
    )
    while True:
        near = (
            both.join(merging(labels.select(F.col("node").alias("b"), "root")), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("m"))
        )
        hooked = stored(
            spark,
            labels.join(merging(near), "node").select("node", F.least("root", "m").alias("root"), F.col("root").alias("was")),
            "cc-hook",
        )
        jump = hooked.select(F.col("node").alias("root"), F.col("root").alias("top"))
        nxt = stored(spark, hooked.join(merging(jump), "root").select("node", F.col("top").alias("root"), "was"), "cc-labels")
        labels = nxt.select("node", "root")
        if nxt.where("root <> was").isEmpty():
            return labels
