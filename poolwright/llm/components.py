"""Connected components of an undirected graph, by least labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FEW_ROWS, checkpointed, tasks_for


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b): comp is the least node that is reachable.

    A round takes the least label among the neighbours (summed up map-side, so a hot node's edges needn't
    meet in one task) and then the label of that label, so paths shrink by half or better; the number of
    rounds grows with the logarithm of the longest path. Only the count of changed rows reaches the driver.
    """
    both = checkpointed(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    tasks = tasks_for(both.count())
    both = both.coalesce(tasks)
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("comp")).select(F.col("a").alias("node"), "comp")
    labels = checkpointed(labels.coalesce(tasks))
    small = F.broadcast if labels.count() <= FEW_ROWS else lambda df: df  # as many nodes in every round
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("comp").alias("other"))
        near = both.join(small(of), "b").coalesce(tasks).groupBy(F.col("a").alias("node")).agg(F.min("other").alias("near")).coalesce(tasks)
        step = near.join(small(labels), "node").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("comp").alias("comp"))
        # label of the label; taken from before this round, which is never too small
        new = checkpointed(step.join(small(jump), "via").select("node", "was", F.least("via", "comp").alias("comp")).coalesce(tasks))
        changed = new.where(F.col("comp") != F.col("was")).limit(1).count()
        labels = new.select("node", "comp")
        if changed == 0:
            return labels
