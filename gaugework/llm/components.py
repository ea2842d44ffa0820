"""Connected components of a graph given by its edges, in rounds over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugework.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (columns x, y, longs): label is the smallest node reachable.

    Each round takes the smallest label among neighbours and then the label of that label, so long
    chains shrink geometrically. Hot nodes are met by joins and minima only, never gathered.
    """
    both = written(edges.select("x", "y").unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("x")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["y"] == labels["node"]).groupBy(F.col("x").alias("node")).agg(F.min("label").alias("near"))
        joined = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("lower"))
        found = written(joined.join(up, "low").select("node", F.col("lower").alias("label"), (F.col("lower") < F.col("label")).alias("moved")), "labels")
        labels = found.select("node", "label")
        if found.filter("moved").isEmpty():
            return labels
