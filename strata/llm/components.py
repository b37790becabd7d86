"""Connected components of an edge list by minimum labels and shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import durable


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (u, v: long); the label is the
    smallest node of the component.

    Each round lets every node take the smallest label among its neighbours and
    itself, then follows that label's own label, so paths halve. Rounds end when
    no label changes. Labels are checkpointed after each round; only the number
    of changed labels reaches the driver.
    """
    both = durable(edges.where("u <> v").select("u", "v").union(
        edges.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = durable(both.groupBy(F.col("u").alias("node")).agg(
        F.least(F.col("node"), F.min("v")).alias("label")))
    while True:
        near = both.join(labels, F.col("v") == F.col("node")).groupBy("u").agg(
            F.min("label").alias("low"))
        step = labels.join(near, F.col("node") == F.col("u")).select(
            "node", F.col("label").alias("old"), F.least("label", "low").alias("mid"))
        jump = step.select(F.col("node").alias("at"), F.col("mid").alias("to"))
        new = durable(step.join(jump, F.col("mid") == F.col("at")).select(
            "node", "old", F.col("to").alias("label")))
        changed = new.where("label <> old").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
