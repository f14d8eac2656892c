"""Connected components of a table of links, by joins and aggregations alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label) for all nodes of the links (a, b): the smallest node that is reachable.

    Each round takes the smallest label among the neighbours and then the label of that
    label, so that long chains shorten by doubling. A hub's links are reduced by partial
    aggregation before the exchange; the loop ends when no label changes.
    """
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    edges = scratch.put(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "edges")
    labels = scratch.put(
        edges.groupBy(F.col("u").alias("node")).agg(F.least(F.col("node"), F.min("v")).alias("label")), "labels"
    )
    while True:
        near = (
            edges.join(labels, edges.v == labels.node).select(F.col("u").alias("node"), "label")
            .unionByName(labels).groupBy("node").agg(F.min("label").alias("label"))
        )
        near = scratch.put(near, "labels")
        jump = near.alias("x").join(near.alias("y"), F.col("x.label") == F.col("y.node"), "left").select(
            "x.node", F.least(F.col("x.label"), F.col("y.label")).alias("label")
        )
        jumped = scratch.put(jump, "labels")
        changed = jumped.alias("x").join(labels.alias("y"), "node").filter("x.label <> y.label").limit(1).count()
        scratch.drop(near, labels)
        labels = jumped
        if not changed:
            scratch.drop(edges)
            return labels
