"""Shards along a Hilbert curve over several metadata dimensions.

Source, language and size are cut into cells in the order of their values, each with about
as many rows, every row gets its cell's place on the curve, rows are sorted by that place, and
the sorted table is cut into runs of equal length.  Neighbours on the curve are neighbours in every
dimension, so a shard, and each file in it, covers a narrow range of all of them and a reader that
filters by any can skip files by their least and greatest values.

Law ``rows``: shard s holds the places from ceil(s n / shards) on, so the counts are
at most one apart.  The order within a cell is by text checksum, doc_id and size, so
equal texts of one cell lie side by side; those of other sources or languages lie elsewhere.

Defined cases: a null text has size 1 and checksum 0; a null source or language is in
the first cell; a null doc_id comes first among equals; equal rows take
neighbouring slots; a long text is read for its size and checksum alone; an empty table
gives an empty result, and with fewer rows than shards some shards are empty.  Extra columns are carried and never read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollbook.llm.components import save
from rollbook.session import workspace

SHARDS = 8
BITS = 5  # of each dimension: 32 cells
LAW = "rows"


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Place on the curve of points given as one row of coordinates per dimension.

    The public method of Skilling (2004): undo the turns of each level, then Gray-encode,
    then interleave the bits, most significant first.
    """
    x = axes.astype(np.int64).copy()
    dims = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(dims):
            swap = np.where(x[i] & level, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(x[i] & level, low, swap)
            x[i] ^= swap if i else 0
        level >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turned = np.zeros(x.shape[1], np.int64)
    level = 1 << (bits - 1)
    while level > 1:
        turned ^= np.where(x[-1] & level, level - 1, 0)
        level >>= 1
    x ^= turned
    place = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            place = (place << 1) | ((x[i] >> bit) & 1)
    return place


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def numbered(rows: DataFrame, order: tuple[str, ...], folder: str) -> DataFrame:
    """The sorted rows, written, with the partition each was sorted in (part) and its place there
    (within); a lost executor repeats tasks, never the order."""
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return save(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id()).withColumn("within", within),
        f"{folder}/sorted",
    )


def starts(runs: DataFrame, weight: Column, folder: str) -> DataFrame:
    """(part, start, total): the weight before each sorted partition, and of all; a sum per
    partition is all that one task gets."""
    sums = runs.groupBy("part").agg(F.sum(weight).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return save(
        sums.select(
            "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
            F.sum("n").over(Window.partitionBy()).alias("total"),
        ),
        f"{folder}/starts",
    )


def quantile_cells(rows: DataFrame, column: str, folder: str) -> list[tuple[int, object]]:
    """(cell, least value) of the cells that have values: a value's cell is the 32nd of all rows
    that its middle row is in, in the order of values.  At most 32 rows reach the driver."""
    counts = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    runs = numbered(counts, (column,), folder)
    up_to = Window.partitionBy("part").orderBy("within").rowsBetween(Window.unboundedPreceding, 0)
    summed = runs.join(starts(runs, F.col("n"), folder), "part").withColumn("upto", F.col("start") + F.sum("n").over(up_to))
    cell = F.expr(f"((2 * upto - n) * {1 << BITS}) div (2 * total)")
    found = summed.groupBy(cell.alias("cell")).agg(F.min(column).alias("least")).collect()
    return sorted((r["cell"], r["least"]) for r in found)


def dimensions(rows: DataFrame, folder: str) -> list[Column]:
    """Cells of source, language and size, 0 to 31, in the order of their values, by quantiles of the
    rows; a null name is in cell 0."""

    def cell(column: str) -> Column:
        found = quantile_cells(rows, column, f"{folder}/{column}")
        return F.coalesce(*[F.when(F.col(column) >= F.lit(least), n) for n, least in reversed(found)], F.lit(0))

    return [cell(c) for c in ("source", "lang", "size")]


def on_curve(cells: list[Column]) -> Column:
    @F.pandas_udf("long")
    def place(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.array([a, b, c], np.int64), BITS))

    return place(*[c.cast("long") for c in cells])


def ordered(spark: SparkSession, docs: DataFrame, names: list[str]) -> DataFrame:
    """Rows with their place in curve order, counted from 0."""
    folder = workspace(spark, "shards")
    text = F.col("text").cast("string")
    read = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_size(text).alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).alias("text_crc32"),
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
    )
    cells = dimensions(read.select("source", "lang", "size"), folder)
    placed = read.select("row", "doc_id", "size", "text_crc32", on_curve(cells).alias("curve"))
    runs = numbered(placed, ("curve", "text_crc32", "doc_id", "size"), folder)
    return runs.join(starts(runs, F.lit(1), folder), "part").withColumn("place", F.col("start") + F.col("within"))


def shard(spark: SparkSession, docs: DataFrame, *keep: str, shards: int = SHARDS) -> DataFrame:
    """``row`` (a struct of the columns of ``keep``, all by default), doc_id, size,
    text_crc32, curve, shard and slot of every row."""
    rows = ordered(spark, docs, list(keep) or docs.columns)
    number = F.expr(f"place * {shards} div total")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return (
        rows.withColumn("shard", number).withColumn("slot", F.col("place") - first)
        .select("row", "doc_id", "size", "text_crc32", "curve", F.col("shard").cast("int").alias("shard"), "slot")
    )


def manifest(sharded: DataFrame) -> DataFrame:
    """What a reader needs to skip a shard: counts, bytes and the range of the curve."""
    return sharded.groupBy("shard").agg(
        F.count("*").alias("n_rows"), F.sum("size").alias("bytes"),
        F.min("curve").alias("first_curve"), F.max("curve").alias("last_curve"),
    )
