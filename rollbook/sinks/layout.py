"""Where rows lie, in place of database indexes.

Run on tables that have been written: the input is a plain file scan.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.sinks.tables import SNAPSHOT

log = logging.getLogger(__name__)

# A key with more than this share of an average bucket's rows makes the bucket a
# hot spot, which a bucketed join cannot split.
MAX_KEY_SHARE = 0.5
BUCKET_BYTES = 256 << 20  # of files of the largest table, by which buckets are counted


def cluster(df: DataFrame, path: str, by: list[str], partition_by: list[str] | None = None,
            bloom: list[str] | None = None) -> None:
    """Write rows gathered by ``by`` and sorted within each file.

    A lookup then skips folders (``partition_by``), row groups (min/max of the
    sorted columns) and, for point lookups, whole files (bloom filters).
    Gathering goes through a rebalance, so AQE cuts a hot value into as many
    tasks as its bytes need and joins small ones.
    """
    folders = partition_by or []
    gathered = df.hint("rebalance", *[F.col(c) for c in folders + by[:1]])
    writer = gathered.sortWithinPartitions(*folders, *by).write.mode("overwrite")
    for column in bloom or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.partitionBy(*folders).parquet(path)


def hottest_share(df: DataFrame, key: str) -> float:
    """The most frequent key's share of all rows; two numbers reach the driver."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    top, rows = counts.agg(F.max("n"), F.sum("n")).first()
    return top / rows if rows else 0.0


def bucket(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None,
           max_key_share: float = MAX_KEY_SHARE) -> bool:
    """Write a catalog table bucketed and sorted by its join key.

    Returns False, with the table clustered by the key instead, when one key is
    so frequent that its bucket would be a hot spot: joins then shuffle and AQE
    splits that key.
    """
    share = hottest_share(df, key)
    if share > max_key_share / buckets:
        log.warning("%s is not bucketed: one %s has %.2f %% of the rows", name, key, 100 * share)
        _save(df.hint("rebalance", F.col(key)).sortWithinPartitions(key), name, path)
        return False
    # As many tasks as buckets, on the same hash: one file per bucket.
    _save(df.repartition(buckets, key), name, path, buckets, key)
    return True


def _save(df: DataFrame, name: str, path: str | None, buckets: int | None = None,
          key: str | None = None) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    if buckets:
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(name)


def bucket_count(size: int) -> int:
    """A power of two, so that tables of other counts still meet without a shuffle."""
    return 1 << max(0, -(-size // BUCKET_BYTES) - 1).bit_length()


def keep_snapshot(df: DataFrame, name: str, path: str, snapshot: str, key: str | None = None,
                  buckets: int = 1, analyze: Sequence[str] = ()) -> str:
    """Replace one snapshot of a catalog table, made if it is not there; the others stay.

    With ``key`` a new table is bucketed and sorted by it; one in which a key is so frequent that
    its bucket would be a hot spot is made without buckets, with a log line.  A table
    keeps the buckets it was made with.  Statistics of the columns of ``analyze`` are taken for
    the optimizer.  Returns its name.
    """
    spark = df.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    if not spark.catalog.tableExists(name):
        spread = ""
        if key:
            share = hottest_share(df, key)
            if share > MAX_KEY_SHARE / buckets:
                log.warning("%s is not bucketed: one %s has %.2f %% of the rows", name, key, 100 * share)
            else:
                spread = f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS"
        spark.sql(f"CREATE TABLE {name} ({columns}, `{SNAPSHOT}` string) USING parquet "
                  f"PARTITIONED BY (`{SNAPSHOT}`) {spread} LOCATION '{path}'")
    made = int({r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
               .get("Num Buckets", 0))
    if made:
        # As many tasks as buckets, on the same hash: one file per bucket.
        df = df.repartition(made, key)
    elif key:
        df = df.hint("rebalance", F.col(key)).sortWithinPartitions(key)
    view = f"snapshot_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        names = ", ".join(f"`{c}`" for c in df.columns)
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (`{SNAPSHOT}` = '{snapshot}') SELECT {names} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
    if analyze:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(f'`{c}`' for c in analyze)}")
    return name
