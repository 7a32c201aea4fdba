"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftmark.sources.scratch import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); a component is named by its least node.

    In each round every node takes the least of itself and its neighbours as its label, and edges
    between nodes become edges between their labels; edges inside a label vanish. What is left
    shrinks quickly, and nothing but the question whether any edge is left reaches the driver. Labels
    and edges of a round are written to the shared folder, so lineage stays short.
    """
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    found = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(edges.select("b", "a"))
        labels = written(both.groupBy("node").agg(F.min("other").alias("other"))
                         .select("node", F.least("node", "other").alias("label")))
        near = edges.join(labels.withColumnsRenamed({"node": "a", "label": "la"}), "a")
        near = near.join(labels.withColumnsRenamed({"node": "b", "label": "lb"}), "b").where("la <> lb")
        edges = written(near.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct())
        if found is None:
            found = labels
        else:
            step = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
            found = written(found.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label")))
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.withColumnRenamed("label", "component")
