"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatlens.session import discard, materialize


def components(links: DataFrame) -> DataFrame:
    """A stored table with ``node, component`` (its smallest node) for all nodes of the links ``a, b``.

    Each round takes the smallest component among the neighbours and then that
    component's own, so paths shrink by doubling. Rounds are written tables; they
    end when no label changes.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.filter("a <> b").distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("component")), "labels")
    while True:
        near = (
            both.join(labels.select("node", "component"), both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("near"))
            .select(F.col("a").alias("node"), "near")
        )
        lower = labels.select("node", "component").join(near, "node").select("node", "component", F.least("component", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("jumped"))
        step = materialize(lower.join(jump, "next").select("node", F.col("component").alias("old"), F.col("jumped").alias("component")), "labels")
        discard(labels)
        labels, changed = step, step.filter("old <> component").limit(1).count()
        if not changed:
            discard(both)
            return labels
