"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _jumped(labels: DataFrame) -> DataFrame:
    """Every node with the label of its label."""
    above = labels.select(F.col("node").alias("label"), F.col("label").alias("top"))
    return labels.join(above, "label").select("node", F.col("top").alias("label"))


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of the edges (x, y).

    Every round each node takes its smallest neighbour's name, twice the name of that name, and edges are drawn between
    the names; edges within a name are done. The smallest node of a component keeps its name, so it names the component
    in the end. What a round finds is written to the shared folder; the driver only learns whether edges are left.
    Minima are combined before the shuffle, so the centre of a large star is one row per task.
    """
    edges, found = stored(edges.select("x", "y").distinct(), "edges"), None
    while True:
        both = edges.union(edges.select("y", "x"))
        labels = both.groupBy("x").agg(F.min("y").alias("y")).select(F.col("x").alias("node"), F.least("x", "y").alias("label"))
        labels = stored(_jumped(stored(_jumped(stored(labels, "labels")), "labels")), "labels")
        if found is None:
            found = labels
        else:
            later = labels.select(F.col("node").alias("label"), F.col("label").alias("top"))
            found = stored(found.join(later, "label", "left").select("node", F.coalesce("top", "label").alias("label")), "labels")
        drawn = edges.join(labels.select(F.col("node").alias("x"), F.col("label").alias("a")), "x")
        drawn = drawn.join(labels.select(F.col("node").alias("y"), F.col("label").alias("b")), "y").filter("a <> b")
        edges = stored(drawn.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct(), "edges")
        if edges.isEmpty():
            return found.select("node", F.col("label").alias("component"))
