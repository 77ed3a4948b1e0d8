"""Connected components of an edge table by min-label propagation with pointer jumping, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.llm.texts import settled


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Each round takes the least label among a node's neighbours (combined before the shuffle, so a
    hub of many edges is summed up where its edges lie), then jumps to the label's label. Labels are
    written to the shared folder after each round; the driver sees one count a round.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = settled(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = settled(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label")), "labels")
    while True:
        seen = both.join(labels.select(F.col("u").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("near"))
        hooked = labels.join(seen, "u").select("u", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        roots = labels.select(F.col("u").alias("label"), F.col("label").alias("up"))
        jumped = hooked.join(roots, "label", "left").select("u", "old", F.least("label", "up").alias("label"))
        found = settled(jumped, "labels")
        labels = found.select("u", "label")
        if not found.where("label <> old").limit(1).count():
            return labels.select(F.col("u").alias("node"), F.col("label").alias("component"))
