"""Counts and checks.  All aggregates combine map-side, so a hot key or file is
folded before anything is shuffled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions import clean
from rollbook.operators.relate import is_text, listed_codes
from rollbook.operators.shape import REASONS, REJECTED, typed_cell
from rollbook.schema import LINKS, TEXT, Link, Table


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def count_where(df: DataFrame, *conditions: Column, name: str = "n") -> DataFrame:
    for condition in conditions:
        df = df.filter(condition)
    return count_rows(df, name)


def load_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table and source file of freshly read file tables."""
    parts = [
        df.select(F.lit(name).alias("table_name"), F.col("_metadata.file_path").alias("file"))
        .groupBy("table_name", "file")
        .agg(F.count("*").alias("n"))
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def key_violations(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once or have a null part."""
    has_null = reduce(or_, [F.col(k).isNull() for k in key])
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | has_null)


def unpivot_counts(df: DataFrame, counts: Mapping[str, Column], name: str, value: str) -> DataFrame:
    """One aggregate over all columns, then one row per column."""
    row = df.agg(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for n, c in counts.items()])
    return row.unpivot([], list(counts), name, value)


def length_violations(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """(column_name, n): texts longer than their declared limit."""
    return unpivot_counts(
        df,
        {c: F.count_if(F.char_length(c) > limit) for c, limit in limits.items()},
        "column_name",
        "n",
    )


def cast_failures(raw: DataFrame, table: Table) -> DataFrame:
    """(column_name, n): cells with text in them whose typed value is missing.

    Text is looked at only where the value is missing; a text column loses nothing.
    """
    fields = [f for f in table.fields if f.name in raw.columns]
    lost = {
        f.name: F.lit(False) if f.kind == TEXT
        else typed_cell(f).isNull() & clean.clean_string(F.col(f.name)).isNotNull()
        for f in fields
    }
    staged = raw.select(*[c.alias(name) for name, c in lost.items()])
    return unpivot_counts(staged, {name: F.count_if(F.col(name)) for name in lost},
                          "column_name", "n")


def quarantine_report(checked: DataFrame) -> DataFrame:
    """(status, reason, n): accepted rows, and rejected rows once per reason."""
    status = F.when(F.col(REJECTED), F.lit("rejected")).otherwise(F.lit("accepted"))
    return (
        checked.select(status.alias("status"), F.explode_outer(REASONS).alias("reason"))
        .groupBy("status", "reason")
        .agg(F.count("*").alias("n"))
    )


def orphans(
    child: DataFrame, columns: str | Sequence[str], parent: DataFrame, keys: str | Sequence[str]
) -> DataFrame:
    """(key columns, n): referenced keys the parent lacks.  Nulls refer to nothing.

    The child is folded to its distinct keys first: the join then moves keys and
    counts instead of rows, and a hot key is one row of it.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    keys = [keys] if isinstance(keys, str) else list(keys)
    refers = reduce(and_, [F.col(c).isNotNull() for c in columns])
    used = child.filter(refers).groupBy(*columns).agg(F.count("*").alias("n"))
    known = parent.select(*[F.col(k).alias(f"__{k}") for k in keys])
    pairs = []
    for c, k in zip(columns, keys):
        left = F.col(c)
        if is_text(child, c) and not is_text(parent, k):
            # A reference kept as text ('05') still means the number 5.
            left = clean.to_whole(left, parent.schema[k].dataType)
        pairs.append(left == F.col(f"__{k}"))
    return used.join(known, reduce(and_, pairs), "left_anti")


def orphan_counts(
    links: Sequence[tuple[str, DataFrame, str, DataFrame, str]],
) -> DataFrame:
    """(link, keys, n_rows) for every (link, child, column, parent, key)."""
    out = None
    for link, child, column, parent, key in links:
        lost = orphans(child, column, parent, key).agg(
            F.count("*").alias("n_keys"),
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        ).select(F.lit(link).alias("link"), "n_keys", "n_rows")
        out = lost if out is None else out.unionAll(lost)
    return out


def check_links(tables: Mapping[str, DataFrame], links: Sequence[Link] = LINKS) -> DataFrame:
    """(link, n_keys, n_rows) of the references that lead nowhere, for every link between
    the given tables; ``link`` is child.column.  Listed codes refer one by one."""

    def child(k: Link) -> DataFrame:
        rows = tables[k.child]
        return rows.select(F.explode(listed_codes(F.col(k.column))).alias(k.column)) if k.listed else rows

    return orphan_counts([
        (f"{k.child}.{k.column}", child(k), k.column, tables[k.parent], k.key)
        for k in links
        if k.child in tables and k.parent in tables
    ])
