"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmart.scratch import materialise


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: for every node of ``edges`` (``a, b``) the least node that it is connected to.

    Every round takes the least label among the neighbours, then the label of that label, so distances
    halve.  Each round is written to the shared folder; the driver only learns how many labels changed.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u != v")
    both = materialise(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = materialise(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select("node", F.least("node", "m").alias("root")))
    while True:
        near = both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("root").alias("m"))
        step = labels.join(near, labels.node == near.u).select("node", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("further"))
        new = materialise(step.join(jump, "root").select("node", "old", F.least("root", "further").alias("root")))
        labels = new.select("node", "root")
        if new.filter("old != root").isEmpty():
            return labels
