"""Connected components by repeated joins, without gathering any edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.words import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an undirected edge list; the smallest node names it.

    Every round lets each node take the smallest label around it and then the label of its label,
    and lets the node that a label names take the smallest label that any of its members sees. So
    whole trees join, not only their nodes: chains of 100,000 nodes settle in 18 to 30 rounds,
    depending on their order. Labels only become smaller, and rounds go on until none changes,
    however many that takes. A round is written to the shared folder, which cuts the
    lineage and makes the test for convergence one small aggregate. Minimum is combined before the
    shuffle, and a node with very many edges is split by Spark's skew join.
    """
    both = written(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .union(edges.select(F.col(b).alias("u"), F.col(a).alias("v")))
        .filter("u <> v"),
        "edges",
    )
    labels = written(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("component")), "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("v"), "component"), "v")
        best = around.groupBy(F.col("u").alias("node")).agg(F.min("component").alias("best"))
        # a label is itself a node, so its own label is one hop further
        hop = labels.select(F.col("node").alias("component"), F.col("component").alias("beyond"))
        seen = written(labels.join(hop, "component", "left").join(best, "node", "left"), "seen")
        hooked = seen.groupBy(F.col("component").alias("node")).agg(F.min("best").alias("hooked"))
        after = seen.join(hooked, "node", "left").select(
            "node", F.least("component", "beyond", "best", "hooked").alias("component"), F.col("component").alias("was")
        )
        after = written(after, "labels")
        settled = after.filter(F.col("component") != F.col("was")).isEmpty()
        labels = after.select("node", "component")
        if settled:
            return labels
