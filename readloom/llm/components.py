"""Connected components of a table of links, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.llm.scratch import Scratch


def connected_components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label): the smallest node reachable over links (a, b), for each node that has a link.

    Each round takes the smallest label among a node and its neighbours, combined before it is
    moved, then the label of that label; stars settle in two rounds and paths in about the
    logarithm of their length.  Labels are written and read again each round; the driver sees a
    count.  Links of a hub sit on the probe side of shuffled joins, which Spark can split.
    """
    both = scratch.save(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), f"{name}-both")
    labels = scratch.save(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")), f"{name}-0")
    for round_ in range(1, 100):
        heard = both.join(labels, both.a == labels.node).groupBy(F.col("b").alias("node")).agg(F.min("label").alias("heard"))
        nearer = labels.join(heard, "node").select("node", F.col("label").alias("old"), F.least("label", "heard").alias("near"))
        far = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        new = nearer.join(far, "near").select("node", F.least("near", "far").alias("label"), (F.least("near", "far") < F.col("old")).alias("changed"))
        saved = scratch.save(new, f"{name}-{round_}")
        scratch.drop(f"{name}-{round_ - 1}")
        labels = saved.select("node", "label")
        if saved.filter("changed").isEmpty():
            break
    scratch.drop(f"{name}-both")
    return labels
