"""Create, replace, append and read file tables.

A table folder is partitioned by ``snapshot``.  A replace is staged by Spark and
swaps just the snapshots in the data, so running a load again, or a task again
after an executor is lost, never doubles rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.schema import Table

SNAPSHOT = "snapshot"


def create_table(spark: SparkSession, table: Table, name: str, path: str | None = None,
                 recreate: bool = True) -> None:
    """An empty catalog table with the declared types.

    ``recreate`` drops an existing one first; otherwise it is kept with its rows.
    """
    if spark.catalog.tableExists(name):
        if not recreate:
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=path, source="parquet", schema=table.schema)


def append(df: DataFrame, path: str, *partition_by: str) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite(df: DataFrame, path: str, *partition_by: str) -> None:
    """Replace the whole table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        *partition_by
    ).parquet(path)


def replace_snapshot(df: DataFrame, path: str, snapshot: str) -> None:
    """Replace one snapshot of a table; the others stay.

    Rows go out where they were read: one snapshot needs no shuffle.
    """
    _write_one(df.withColumn(SNAPSHOT, F.lit(snapshot)), path, "overwrite")


def clear_snapshot(df: DataFrame, path: str, snapshot: str) -> None:
    """Leave a snapshot without rows: a dynamic overwrite by no rows replaces nothing."""
    df.limit(0).write.mode("overwrite").parquet(f"{path}/{SNAPSHOT}={snapshot}")


def append_snapshot(df: DataFrame, path: str, snapshot: str) -> None:
    _write_one(df.withColumn(SNAPSHOT, F.lit(snapshot)), path, "append")


def _write_one(df: DataFrame, path: str, mode: str) -> None:
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(
        SNAPSHOT
    ).parquet(path)


def write_snapshots(df: DataFrame, path: str, by: str = SNAPSHOT) -> None:
    """Replace every snapshot in the data.  Rows are gathered by snapshot first,
    or each task would open a file in each; AQE cuts a big snapshot into many
    tasks, so the file count follows the bytes."""
    df.hint("rebalance", F.col(by)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(by).parquet(path)


def read_snapshots(spark: SparkSession, path: str, schema: T.StructType,
                   snapshot: str | None = None) -> DataFrame:
    """A table with its declared types, also when it has no rows yet.  Choosing a
    snapshot, with its parts ``snapshot.number`` if it was streamed, prunes the other
    folders."""
    stored = T.StructType([*schema.fields, T.StructField(SNAPSHOT, T.StringType())])
    df = spark.read.schema(stored).parquet(path)
    if snapshot is None:
        return df
    return df.filter((F.col(SNAPSHOT) == snapshot) | F.col(SNAPSHOT).startswith(f"{snapshot}."))
