"""Connected components of an edge table, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` (the smallest node reachable) of every node in ``edges
    (a, b)``. Each round takes the smallest label among neighbours and then the
    label of that label, so that rounds grow with the logarithm of a path's
    length; every round is stored, so lineage stays short and a lost executor
    costs one round."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.where("a <> b").distinct(), "llm-edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                         .select("node", F.least("node", "m").alias("comp")), "llm-labels")
    while True:
        seen = (both.join(labels.select(F.col("node").alias("b"), "comp"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near")))
        near = labels.join(seen, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        up = near.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        new = materialize(near.join(up, "comp").select("node", "old", F.least("comp", "up").alias("comp")), "llm-labels")
        if new.where("old <> comp").limit(1).count() == 0:
            return new.select("node", "comp")
        labels = new.select("node", "comp")
