"""Connected components by Spark joins, for graphs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyroll.llm.common import written


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Columns node and component (the smallest node that it is linked with), for all nodes of the edges.

    Each round takes the smallest label among the neighbours and then the
    label's own label, so labels travel twice as far each round. Rounds end
    when no label changes. Labels are written each round, so that their size is known.
    """
    both = written(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v")).union(edges.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct()
    )
    labels = both.groupBy(F.col("u").alias("node")).agg(F.min(F.least("u", "v")).alias("component"))
    labels = written(labels)
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), F.col("component").alias("_l")), "v")
        least = near.groupBy(F.col("u").alias("node")).agg(F.min("_l").alias("_l"))
        moved = labels.join(least, "node").select("node", "component", F.least("component", "_l").alias("_to"))
        jump = moved.select(F.col("node").alias("_to"), F.col("_to").alias("_further"))
        after = moved.join(jump, "_to", "left").select(
            "node", F.coalesce(F.least("_further", "_to"), F.col("_to")).alias("component"), F.col("component").alias("_before")
        )
        after = written(after)
        changed = after.where("component <> _before").limit(1).count()
        labels = after.drop("_before")
        if not changed:
            return labels
