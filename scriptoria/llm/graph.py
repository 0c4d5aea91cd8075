"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.llm.common import dropped, saved


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges(src, dst): the smallest node reachable.

    Each round takes the least label among the neighbours, then jumps to that label's own
    label, so that chains shorten by half. Every round is a written table; the driver sees
    one count a round. An edge table without rows gives no rows; self loops are harmless.
    """
    both = edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src != dst").distinct()
    both = saved(both, "edges")
    labels = saved(both.groupBy(F.col("src").alias("node")).agg(F.least(F.first("src"), F.min("dst")).alias("label")), "labels")
    for _ in range(rounds):
        near = both.join(labels.withColumnRenamed("node", "dst"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("label").alias("near"))
        moved = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("via"))
        target = labels.select(F.col("node").alias("via"), F.col("label").alias("next"))
        after = saved(moved.join(target, "via", "left").select("node", "was", F.least("via", F.coalesce("next", "via")).alias("label")), "labels")
        changed = after.where("label != was").limit(1).count()
        dropped(labels)
        labels = after.select("node", "label")
        if not changed:
            break
    else:
        raise RuntimeError(f"no fixed point in {rounds} rounds")
    return labels.withColumnRenamed("label", "component")
