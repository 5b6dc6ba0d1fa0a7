"""Connected components as a Spark loop over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.session import ensure_checkpoint_dir


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every end of a link (a, b); root is the smallest node of the component.

    Each round takes the smallest label of all neighbours, then the label of that label (pointer jumping),
    so long chains shrink by half. Lineage is cut with checkpoint() every round.
    """
    ensure_checkpoint_dir(links.sparkSession)
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = both.unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct().checkpoint()
    labels = both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("root")).checkpoint()
    while True:
        near = both.join(labels.withColumnsRenamed({"node": "other", "root": "r"}), "other").groupBy("node").agg(F.min("r").alias("m"))
        step = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "m").alias("new"))
        far = labels.select(F.col("node").alias("new"), F.col("root").alias("far"))
        after = step.join(far, "new", "left").select("node", "old", F.least("new", "far").alias("root")).checkpoint()
        changed = after.where(F.col("root") != F.col("old")).limit(1).count()
        labels = after.select("node", "root")
        if not changed:
            return labels
