"""Connected components of a table of links, by rounds of minimum and jump."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save(df: DataFrame, path: str) -> DataFrame:
    """Write and read back: the lineage ends in a table all executors share."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def components(spark: SparkSession, links: DataFrame, folder: str) -> DataFrame:
    """(node, label) for every node of ``links`` (a long, b long): the smallest node
    that can be reached.

    Each round takes the smallest label among the neighbours, then the label of that
    label.  Only two-column tables move; the minimum is taken on the map side first,
    so the links of a hub do not meet in one task unreduced.
    """
    both = save(
        links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct()
        .toDF("node", "other"),
        f"{folder}/links",
    )
    labels = save(
        both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")),
        f"{folder}/labels-0",
    )
    step = 0
    while True:
        step += 1
        heard = (
            both.join(labels.withColumnRenamed("node", "other"), "other")
            .groupBy("node").agg(F.min("label").alias("heard"))
        )
        nearer = labels.join(heard, "node").select(
            "node", F.col("label").alias("before"), F.least("label", "heard").alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("jumped"))
        moved = nearer.join(jump, "label", "left").select(
            "node", F.least("label", "jumped").alias("label"), "before"
        )
        moved = save(moved, f"{folder}/labels-{step}")
        labels = moved.select("node", "label")
        if moved.filter("label <> before").isEmpty():
            return labels
