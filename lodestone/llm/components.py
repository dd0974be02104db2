"""Connected components by repeated contraction; nothing but counts comes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import materialise


def relabel(rows: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """``column`` replaced by its label, if it has one.  labels: node, label."""
    found = labels.select(F.col("node").alias(column), F.col("label").alias("_label"))
    return rows.join(found, column, "left").withColumn(column, F.coalesce("_label", column)).drop("_label")


def contract(links: DataFrame, labels: DataFrame | None = None) -> DataFrame | None:
    """The labels (node, label: the smallest node of its component) after adding links (a, b); None while there is no link.

    In a round every node takes its smallest neighbour or itself as parent, a
    parent's parent twice over, and the links are drawn between the parents
    that are left, so chains shrink by a multiple and stars at once.
    """
    for column in ("a", "b"):
        links = links if labels is None else relabel(links, column, labels)
    links = materialise(links.filter("a <> b").distinct(), "links")
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("a").alias("b"), F.col("b").alias("a")))
        parents = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_low")).select("node", F.least("node", "_low").alias("label")), "parents")
        for _ in range(2):
            parents = materialise(relabel(parents, "label", parents), "parents")
        if labels is None:
            labels = parents
        else:  # nodes that had no label so far are new
            known = relabel(labels, "label", parents)
            labels = materialise(known.unionByName(parents.join(labels, "node", "left_anti")), "labels")
        for column in ("a", "b"):
            links = relabel(links, column, parents)
        links = materialise(links.filter("a <> b").distinct(), "links")
    return labels
