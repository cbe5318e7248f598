"""Connected components of an edge table by min-label propagation.

Labels shrink over edges and are then shortened by looking up the label's own
label, so stars and long chains both settle in few rounds. Every step is a join
or a map-side aggregated minimum; each round's labels are written to the shared
folder. A node with very many edges is a hot join key, which adaptive execution
splits, and one partial minimum per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import is_empty, stage


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``a, b``); equal labels mean
    connected, and a label is the least node of its component."""
    both = stage(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))),
        "edges",
    )
    labels = stage(
        both.groupBy("a")
        .agg(F.min("b").alias("least"))
        .select(F.col("a").alias("node"), F.least("a", "least").alias("label")),
        "labels",
    )
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        lowered = labels.join(near, labels["node"] == near["a"]).select(
            "node", "label", F.least("label", "near").alias("low")
        )
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("up"))
        moved = stage(
            lowered.join(up, "low", "left").select(
                "node", F.col("label").alias("old"), F.least("low", "up").alias("label")
            ),
            "labels",
        )
        labels = moved.select("node", "label")
        if is_empty(moved.filter("label != old")):
            return labels
