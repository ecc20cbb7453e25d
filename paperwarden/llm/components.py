"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paperwarden.operators.scale import Workspace


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """Links (a, b) to a table (id, class_id): the smallest id reachable from every id in a link, itself included.

    Every round takes the smallest label among neighbours and then the label of that label, so the number of rounds
    follows the logarithm of the longest chain. Labels are written each round; nothing is gathered.
    """
    both = work.table(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = work.table(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("id"), F.least("a", "b").alias("class_id")))
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("class_id").alias("near"))
        lower = work.table(labels.join(near, labels["id"] == near["a"]).select(
            "id", F.col("class_id").alias("before"), F.least("class_id", "near").alias("class_id")))
        onward = lower.select(F.col("id").alias("_id"), F.col("class_id").alias("_class_id"))
        jumped = work.table(lower.join(onward, lower["class_id"] == onward["_id"]).select(
            "id", "before", F.least("class_id", "_class_id").alias("class_id")))
        work.drop(lower, labels)
        labels = jumped
        if labels.where("class_id < before").isEmpty():
            work.drop(both)
            return labels.select("id", "class_id")
