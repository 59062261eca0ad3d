"""Connected components of a link table, without gathering a component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b long); the
    component is its smallest node. Each round a node takes the smallest
    label among its own, its neighbours' and its label's own label, so a path
    shortens as fast as pointers double. Rounds sum up with map-side combine
    and are written; a hub's rows are never gathered."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.where("a <> b").distinct(), "cc-links")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("component")), "cc-labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("far"))
        step = (labels.join(near, "node").join(jump, "component", "left")
                .select("node", F.least("component", "near", "far").alias("component"),
                        (F.least("near", F.coalesce("far", "near")) < F.col("component")).alias("moved")))
        step = materialize(step, "cc-labels")
        labels = step.select("node", "component")
        if step.where("moved").limit(1).count() == 0:
            return labels
