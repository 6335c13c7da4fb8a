"""Connected components of a table of links, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.session import written


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> (node, comp): the smallest node reachable, for all nodes with a link.

    Each round takes the smallest label among the neighbours and then the label of that label, so that a chain
    takes as many rounds as the logarithm of its length. A node's many links are combined before the shuffle.
    Rounds are written to the shared folder, so that no lineage grows and lost executors cost one round.
    """
    # Both ways from one row: a union of two selections would find all links twice.
    both = links.where("a <> b").selectExpr("inline(array(struct(a, b), struct(b as a, a as b)))")
    edges = written(both.distinct(), "edges")
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    labels = written(labels.select("node", F.least("node", "near").alias("comp")), "labels")
    while True:
        near = (
            edges.join(labels, edges["b"] == labels["node"])
            .groupBy(F.col("a").alias("at"))
            .agg(F.min("comp").alias("near"))
        )
        stepped = labels.join(near, labels["node"] == near["at"]).select(
            "node", F.col("comp").alias("old"), F.least("comp", "near").alias("mid")
        )
        heads = labels.select(F.col("node").alias("head"), F.col("comp").alias("beyond"))
        labels = stepped.join(heads, stepped["mid"] == heads["head"]).select(
            "node", "old", F.least("mid", "beyond").alias("comp")
        )
        labels = written(labels, "labels")
        moved = labels.where("old <> comp").limit(1).count()
        labels = labels.select("node", "comp")
        if not moved:
            return labels
