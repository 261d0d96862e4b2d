"""Versions of a store: which parts hold the rows of each table, published all at once.

A part is a folder with the rows of one source file, written once and never changed.  A
version is the list of all live parts, as a small Parquet folder ``_versions/<number>``.  It is
written under another name and becomes a version by one rename that fails if the number is
taken, so readers see all tables of a load or none, a failed load leaves the version before,
and of two writers one is told to start again.  The rename is as atomic as the store's own;
readers also ask for the writer's ``_SUCCESS``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = "_versions"
#: ``part`` is a path below the store, null for a source without rows.
PARTS = ("table_name string, snapshot string, source string, size long, load string, part string, "
         "accepted long, rejected long, bytes long")


class Conflict(RuntimeError):
    """Another writer has published in the meantime; the load can be run again."""


def file_system(spark: SparkSession, path: str):
    """Spark's own file system for a path, and the path for it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is not there."""
    system, target = file_system(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(target)) if system.exists(target) else []


def exists(spark: SparkSession, path: str) -> bool:
    system, target = file_system(spark, path)
    return system.exists(target)


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Published versions, oldest first."""
    names = [n for n in children(spark, f"{root}/{FOLDER}") if n.isdigit()]
    return [int(n) for n in names if exists(spark, f"{root}/{FOLDER}/{n}/_SUCCESS")]


def path_of(root: str, number: int) -> str:
    return f"{root}/{FOLDER}/{number:012d}"


def parts(spark: SparkSession, root: str, number: int | None = None) -> tuple[int, DataFrame]:
    """The live parts of a version, the last one by default, and its number; 0 before the
    first."""
    if number is None:
        number = max(numbers(spark, root), default=0)
    if number == 0:
        return 0, spark.createDataFrame([], PARTS)
    return number, spark.read.schema(PARTS).parquet(path_of(root, number))


def publish(spark: SparkSession, root: str, after: int, live: DataFrame) -> int:
    """Make ``live`` the version after ``after``."""
    draft = f"{root}/{FOLDER}/draft-{uuid.uuid4().hex}"
    live.coalesce(1).write.parquet(draft)  # a row per source file
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs
    context = fs.FileContext.getFileContext(
        fs.Path(root).toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    ) if "://" in root else fs.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        context.rename(fs.Path(draft), fs.Path(path_of(root, after + 1)), plain)
    except Exception as error:
        if "FileAlreadyExists" not in str(error):
            raise
        raise Conflict(f"version {after + 1} of {root} is there already") from error
    return after + 1


def forget(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Delete all versions but the last ``keep``, and the loads that none of those holds.

    Not while a load is running: its folders are not in a version yet.  Returns the deleted
    folders' names below the store.
    """
    if keep < 1:
        raise ValueError("keep one version at least")
    known = numbers(spark, root)
    held: set[str] = set()
    for number in known[-keep:]:
        _, live = parts(spark, root, number)
        held |= {r["load"] for r in live.select(
            F.concat_ws("/", "table_name", "load").alias("load")).distinct().collect()}
    gone = [f"{FOLDER}/{n:012d}" for n in known[:-keep]]
    gone += [f"{FOLDER}/{n}" for n in children(spark, f"{root}/{FOLDER}") if n.startswith("draft-")]
    for table in (n for n in children(spark, root) if not n.startswith(("_", "."))):
        gone += [f"{table}/{n}" for n in children(spark, f"{root}/{table}") if f"{table}/{n}" not in held]
    for indexed in children(spark, f"{root}/_index"):
        gone += [f"_index/{indexed}/{n}" for n in children(spark, f"{root}/_index/{indexed}")
                 if f"{indexed}/{n}" not in held]
    for name in gone:
        system, target = file_system(spark, f"{root}/{name}")
        system.delete(target, True)
    return gone


def as_parts(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), PARTS)


