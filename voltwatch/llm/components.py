"""Connected components of a link table, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(v, comp) for every node of links (a, b): comp is the least node reachable.

    Each round every node takes the least label among its neighbours (partial
    aggregation, so a hub is one row per task) and then its label's own label,
    which halves the remaining distance.  Labels are written each round.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.where("a != b").distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("v")).agg(F.least("v", F.min("b")).alias("comp")), "labels")
    while True:
        near = edges.join(labels.select(F.col("v").alias("b"), "comp"), "b").groupBy(F.col("a").alias("v")).agg(F.min("comp").alias("near"))
        taken = written(labels.join(near, "v").select("v", "comp", F.least("comp", "near").alias("near")), "taken")
        up = taken.select(F.col("v").alias("near"), F.col("near").alias("up"))
        new = written(taken.join(up, "near", "left").select("v", "comp", F.least("near", "up").alias("new")), "labels")
        changed = not new.where("new != comp").isEmpty()
        labels = new.select("v", F.col("new").alias("comp"))
        if not changed:
            return labels
