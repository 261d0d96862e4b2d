"""Compare a listing of remote files with what was loaded before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEW, CHANGED, UNCHANGED = "new", "changed", "unchanged"


def diff(remote: DataFrame, local: DataFrame, key: str = "name") -> DataFrame:
    """Every remote file, in full, with its status.

    ``remote`` has (key, size) and may have ``readable``; a missing size counts
    as 0 and an unreadable file as changed.  ``local`` has (key, size), one row
    per key.  Repeated remote names stay repeated.
    """
    readable = F.col("readable") if "readable" in remote.columns else F.lit(True)
    known = local.select(key, F.col("size").alias("local_size"), F.lit(True).alias("__known"))
    size = F.coalesce("size", F.lit(0))
    status = (
        F.when(~readable, CHANGED)
        .when(F.col("__known").isNull(), NEW)
        .when(size != F.coalesce("local_size", F.lit(-1)), CHANGED)
        .otherwise(UNCHANGED)
    )
    return remote.join(known, key, "left").withColumn("status", status).drop("__known")


def to_load(remote: DataFrame, local: DataFrame, key: str = "name") -> DataFrame:
    """The files to fetch now: new and changed ones."""
    return diff(remote, local, key).filter(F.col("status") != UNCHANGED)
