"""Samples of labelled rows for the one task that learns, bounded in rows and bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.components import save


def bounded(rows: DataFrame, group: str, most_rows: int, most_bytes: int, folder: str) -> DataFrame:
    """The first rows of each group in hash order, as long as they are at most ``most_rows``
    and their texts at most ``most_bytes``: columns key, ``group`` and text.

    ``rows`` has one row per key and group.  Spark cuts to ``most_rows`` before the shuffle too;
    what is written between has that many rows, whose lengths alone are summed up.
    """
    turn = F.xxhash64("key", F.lit(1))
    first = Window.partitionBy(group).orderBy(turn, "key")
    taken = save(
        rows.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= most_rows),
        f"{folder}/first",
    )
    so_far = Window.partitionBy(group).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    sizes = taken.select(group, "place", F.octet_length("text").cast("long").alias("bytes"))
    kept = sizes.withColumn("bytes", F.sum("bytes").over(so_far)).filter(F.col("bytes") <= most_bytes)
    return taken.join(F.broadcast(kept.select(group, "place")), [group, "place"]).select("key", group, "text")
