"""Connected components of a table of links, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingpanel.session import staged

#: Links, or labels, of one written file: rounds over few of them do not write many tiny files.
ROWS_A_FILE = 250_000


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a, b``); the label is the smallest node reachable.

    Each round gives every node the smallest label among its neighbours' and its own, and then the label
    of that label, so the distance covered doubles. Labels are written after every round; the driver
    sees one number a round. A node with very many links is reduced before the shuffle.
    """
    both = staged(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    files = max(4, both.count() // ROWS_A_FILE)
    firsts = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    labels = staged(firsts.coalesce(files), "labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node"))
        near = seen.agg(F.min("label").alias("near")).join(labels, "node").select("node", "label", F.least("near", "label").alias("near"))
        jump = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        moved = staged(near.join(jump, "near").select("node", "label", F.least("near", "far").alias("new")).coalesce(files), "labels")
        changed = moved.where("new <> label").limit(1).count()
        labels = moved.select("node", F.col("new").alias("label"))
        if not changed:
            return labels
