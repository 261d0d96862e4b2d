"""Tables of a relational database, through Spark's JDBC source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

FETCH_ROWS = 10_000
BATCH_ROWS = 10_000  # rows per INSERT batch


@dataclass(frozen=True)
class Slices:
    """Read a table in parallel, by ranges of a numeric or date column."""

    column: str
    lower: str
    upper: str
    count: int


def read_options(url: str, table: str, slices: Slices | None = None, **extra: str) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(FETCH_ROWS), "pushDownPredicate": "true"}
    if slices:
        options |= {
            "partitionColumn": slices.column,
            "lowerBound": slices.lower,
            "upperBound": slices.upper,
            "numPartitions": str(slices.count),
        }
    return options | extra


def read_table(
    spark: SparkSession, url: str, table: str, slices: Slices | None = None, **extra: str
) -> DataFrame:
    """Filters and column choices on the result are sent to the database."""
    return spark.read.format("jdbc").options(**read_options(url, table, slices, **extra)).load()


def append_table(df: DataFrame, url: str, table: str, connections: int = 16, **extra: str) -> None:
    """Append in batches.  Rows of a retried task may arrive twice: a database
    without a staging table cannot undo another connection's commit, so load the
    Parquet tables first and append to an empty table."""
    options = {"url": url, "dbtable": table, "batchsize": str(BATCH_ROWS),
               "numPartitions": str(connections)}
    df.write.format("jdbc").mode("append").options(**(options | extra)).save()
