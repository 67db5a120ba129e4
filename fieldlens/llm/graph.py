"""Connected components as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(node, root)``: root is the smallest node reachable. Nodes without edges are not listed.

    Each round takes the smallest label among the neighbours, then the label of that label, so paths halve.
    A round is a written table; the loop ends with the first round that changes nothing.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy(both["a"].alias("n")).agg(F.min("root").alias("low")))
        step = labels.join(near, labels["node"] == near["n"]).select("node", "root", F.least("root", "low").alias("low"))
        up = labels.select(F.col("node").alias("at"), F.col("root").alias("top"))
        new = written(step.join(up, step["low"] == up["at"], "left").select(
            "node", F.least("low", "top").alias("root"), (F.least("low", "top") < F.col("root")).alias("moved")), "labels")
        if not new.where("moved").limit(1).count():
            return new.select("node", "root")
        labels = new.select("node", "root")
