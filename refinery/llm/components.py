"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node of ``edges``
    (columns ``a`` and ``b``, long; null ends and loops are left out).

    Each round gives a node the smallest label among its neighbours and then that label's own
    label, so distances shrink by jumps. Minima are formed in each task before the shuffle,
    and a node with very many neighbours is split by the joins. Every round is a stored
    table. Ends with the first round that changes nothing.
    """
    straight = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
    both = materialize(straight.union(straight.select("b", "a")).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    labels = materialize(labels.select("node", F.least("node", "near").alias("component"), F.lit(True).alias("moved")), "labels")
    while labels.filter("moved").limit(1).count():
        known = labels.select(F.col("node").alias("b"), F.col("component").alias("near"))
        offers = both.join(known, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lower = labels.join(offers, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("component").alias("further"))
        next_labels = lower.join(jump, "new").select(
            "node", F.least("new", "further").alias("component"), (F.least("new", "further") < F.col("old")).alias("moved")
        )
        labels = materialize(next_labels, "labels")
    return labels.select("node", "component")
