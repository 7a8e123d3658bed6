"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it is linked with over any number of links ``a``, ``b``.

    Each round takes the smallest label among the neighbours and then the label of that
    label, so that long chains halve; every round is written down. Rows with the same key
    are joined, never gathered.
    """
    both = stored(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        nearer = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("higher"))
        step = nearer.join(up, "label", "left").select("node", "old", F.least("label", "higher").alias("label"))
        step = stored(step, "labels")
        if step.filter("label <> old").isEmpty():
            return step.select("node", "label")
        labels = step.select("node", "label")
