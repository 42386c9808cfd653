"""Connected components of an edge table by minimum labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of ``edges`` (a, b); comp: its smallest reachable node.

    Each round takes the smallest label among a node's neighbours and then the
    label of its label; labels are written every round, so a lost executor
    costs a re-read.  Ends when no label changes.
    """
    both = written(edges.select(F.col("a").alias("node"), F.col("b").alias("to"))
                   .union(edges.select("b", "a")).distinct())
    labels = written(both.groupBy("node").agg(F.least(F.col("node"), F.min("to")).alias("comp")))
    while True:
        near = (both.join(labels.select(F.col("node").alias("to"), F.col("comp").alias("c")), "to")
                .groupBy("node").agg(F.min("c").alias("c")))
        step = labels.join(near, "node").select(
            "node", F.least("comp", "c").alias("comp"), F.col("comp").alias("was"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        new = written(step.join(jump, "comp", "left").select(
            "node", F.least("comp", "up").alias("comp"), "was"))
        if new.where("comp < was").isEmpty():
            return labels
        labels = new.select("node", "comp")
