"""Which files there are, and which table each belongs to."""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.schema import REGISTRY

PATTERNS: dict[str, str] = {name: t.pattern for name, t in REGISTRY.items()}


def base_name(path: Column) -> Column:
    """A file's own name; for a part file that Spark wrote, the name of its folder."""
    last = F.substring_index(path, "/", -1)
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.when(last.rlike("^part-[0-9]"), folder).otherwise(last)


def empty_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the files without a byte, which no Spark scan lists as rows."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    full = {plain_path(r["path"]) for r in files.select("path").collect()}
    return sorted({plain_path(unquote(f)) for f in files.inputFiles()} - full)


def plain_path(uri: str) -> str:
    """One spelling for local paths: ``file:/a`` and ``file:///a`` are the same."""
    return "file:/" + uri[len("file:"):].lstrip("/") if uri.startswith("file:") else uri


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, size, modified) of every file with a byte below a folder.  ``content`` is pruned,
    so no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(
        "path", base_name(F.col("path")).alias("name"), F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def route(name: Column, patterns: Mapping[str, str] = PATTERNS) -> Column:
    """The first category whose pattern occurs in the upper-cased name, or NULL."""
    upper = F.upper(name)
    return F.coalesce(
        *[F.when(upper.contains(p), F.lit(category)) for category, p in patterns.items()]
    )


def count_routed(
    files: DataFrame, name: str = "name", patterns: Mapping[str, str] = PATTERNS
) -> DataFrame:
    """Files per category; a category without files is kept with 0.

    Unmatched files are the group '', which the join with the list of categories
    leaves out.  Being never NULL, the group column needs no filter ahead of the
    join, which would test every pattern a second time.
    """
    category = F.coalesce(route(F.col(name), patterns), F.lit(""))
    counts = files.groupBy(category.alias("category")).agg(F.count("*").alias("n_files"))
    categories = files.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(c) for c in patterns])).alias("category")
    )
    return categories.join(counts, "category", "left").select(
        "category", F.coalesce("n_files", F.lit(0).cast("bigint")).alias("n_files")
    )
