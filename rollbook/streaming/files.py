"""Load each new file of a folder once.

The checkpoint remembers the files, the Parquet sink commits each batch exactly
once, and ``AvailableNow`` works off everything that has arrived and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.operators.shape import REJECTED
from rollbook.plans.load import Inputs, load_table, stored_schema
from rollbook.schema import Table
from rollbook.sinks import versions
from rollbook.sinks.tables import SNAPSHOT
from rollbook.sources.delimited import SOURCE_FILE

COUNTS = "_counts"

#: The columns of Spark's binary file source; the content is never asked for.
FILES = "path string, modificationTime timestamp, length long, content binary"


def drain(stream: DataFrame, out_path: str, checkpoint: str,
          transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Write what is new since the last call with this checkpoint."""
    query = (
        transform(stream)
        .writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def new_parquet(spark: SparkSession, path: str, max_files: int = 10_000) -> DataFrame:
    """A stream over Parquet files; their schema is that of the files there now."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def new_files(spark: SparkSession, path: str, max_files: int = 1_000) -> DataFrame:
    """A stream of the paths of new files; nothing is read."""
    return (
        spark.readStream.format("binaryFile").schema(FILES)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(path)
        .select("path")
    )


def load_new(spark: SparkSession, table: Table, path: str, out_path: str, checkpoint: str,
             snapshot: str, max_files: int = 1_000, **scan: object) -> DataFrame:
    """Load what has arrived for one table of a month, as ``load.load_table`` does, and return
    the counts of the month so far.

    Each batch of new files is scanned by the batch reader, which splits big files, and
    replaces its own part of the month, ``snapshot.number``, and its own counts: a batch that is
    run again after a failure never doubles rows.  A primary key that another batch has stored
    is rejected.  ``load.read_table`` reads a month with all its parts; a month is either
    streamed or loaded whole.
    """

    def load_batch(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # at most max_files names
        if paths:
            part = f"{snapshot}.{number:06d}"
            load_table(spark, table, Inputs(paths), out_path, part, month=snapshot, **scan)
            count_part(spark, table, out_path, snapshot, part)

    query = (
        new_files(spark, path, max_files)
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return load_counts(spark, out_path, table, snapshot)


def count_part(spark: SparkSession, table: Table, out_path: str, month: str, part: str) -> None:
    """Store the rows per source file of a written part; two of its columns are read."""
    root = out_path.rstrip("/")
    rows = spark.read.schema(stored_schema(table)).parquet(f"{root}/{table.name}/{SNAPSHOT}={part}")
    counts = rows.groupBy(F.col(SOURCE_FILE).alias("file")).agg(
        F.count_if(~F.col(REJECTED)).alias("accepted"), F.count_if(REJECTED).alias("rejected")
    )
    counts.write.mode("overwrite").parquet(f"{root}/{COUNTS}/{table.name}/month={month}/part={part}")


def load_counts(spark: SparkSession, out_path: str, table: Table, month: str) -> DataFrame:
    """(table_name, file, accepted, rejected, part) of a streamed month, a row per source file."""
    folder = f"{out_path.rstrip('/')}/{COUNTS}/{table.name}/month={month}"
    schema = "file string, accepted long, rejected long, part string"
    rows = (
        spark.read.schema(schema).parquet(folder) if versions.exists(spark, folder)
        else spark.createDataFrame([], schema)
    )
    return rows.select(F.lit(table.name).alias("table_name"), "file", "accepted", "rejected", "part")
