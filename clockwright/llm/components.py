"""Connected components of a table of links, by minimum labels that jump along themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clockwright.scratch import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); the label is the smallest node of its component.

    Each round a node takes the smallest label among its neighbours, and then
    the label of that label, so that chains shorten by half.  Nodes without
    links are not listed.  Links reach the driver only as a count of changes.
    """
    both = materialize(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links")
    labels = materialize(
        both.groupBy("a").agg(F.min("b").alias("b"))
        .select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near")))
        stepped = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        target = labels.select(F.col("node").alias("at"), F.col("label").alias("further"))
        new = materialize(
            stepped.join(target, F.col("label") == F.col("at"), "left")
            .select("node", "old", F.least("label", "further").alias("label")), "labels")
        changed = new.where(F.col("old") != F.col("label")).limit(1).count()
        labels = new.drop("old")
        if not changed:
            return labels
