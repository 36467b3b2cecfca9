"""Connected components of links, as rounds of joins; nothing is gathered anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fleetlens.llm.common import materialize


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of a link; a component is named by its smallest node.

    Each round a node takes the smallest label among its neighbours' and then its label's label, so that labels travel
    twice as far with every round. NULL ends are ignored.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = materialize(pairs.union(pairs.select("b", "a")).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label"))
    labels = materialize(labels, "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        seen = labels.join(near, labels.node == near.a).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        above = labels.select(F.col("node").alias("_at"), F.col("label").alias("_above"))
        round_ = Observation()
        new = seen.join(above, seen.label == above._at).select("node", F.least("label", "_above").alias("label"), "old").observe(
            round_, F.count(F.when(F.col("label") != F.col("old"), 1)).alias("changed"))
        labels = materialize(new.select("node", "label", "old"), "labels").select("node", "label")
        if not round_.get["changed"]:
            return labels.withColumnRenamed("label", "component")
