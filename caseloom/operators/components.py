"""Connected components as a loop of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.sources.scratch import written


def linked(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes that edges (a, b) link to another one: root is the smallest node that they reach.

    Minimum labels spread along edges and jump to their label's label, so rounds are few; each is written to the shared
    folder. A hot node's edges are pre-aggregated by the partial minimum, and its join is one that adaptive execution can split. An empty
    edge table gives no rows.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("m"))
        step = labels.join(near, "node", "left").select("node", F.col("root").alias("was"), F.least("root", "m").alias("root"))
        far = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        step = written(step.join(far, "root", "left").select("node", "was", F.least("root", "far").alias("root")))
        changed = step.where("root <> was").limit(1).count()
        labels = step.select("node", "root")
        if not changed:
            return labels


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of nodes (column node); those without edges are their own root."""
    return nodes.select("node").join(linked(edges), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
