"""Load one snapshot of all tables from a folder of raw files."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.operators import keys
from rollbook.operators.relate import small_side
from rollbook.operators.shape import RAW, REASONS, REJECTED, duplicate_reason, typed_with_reasons
from rollbook.schema import LOAD_ORDER, REGISTRY, Table
from rollbook.session import workspace
from rollbook.sinks import tables as sink
from rollbook.sinks import versions
from rollbook.sources.archive import list_members, scan_members
from rollbook.sources.delimited import LONG_RECORD, OPEN_CELL, SOURCE_FILE, scan_delimited
from rollbook.sources.files import base_name, empty_files, list_files, route


def stored_schema(table: Table) -> T.StructType:
    """The typed columns, then where a row came from and why it was rejected."""
    return T.StructType(
        [
            *table.schema.fields,
            T.StructField(SOURCE_FILE, T.StringType()),
            T.StructField(LONG_RECORD, T.StringType()),
            T.StructField(RAW, table.raw_schema),
            T.StructField(REASONS, T.ArrayType(T.StringType())),
            T.StructField(REJECTED, T.BooleanType()),
        ]
    )


@dataclass
class Inputs:
    """What a table is loaded from: plain files and (archive, member) pairs."""

    paths: list[str] = field(default_factory=list)
    members: list[tuple[str, str]] = field(default_factory=list)


def find_inputs(spark: SparkSession, folder: str, tables: Mapping[str, Table]) -> dict[str, Inputs]:
    """Files by table, by the name of the file alone; files without bytes count too, so
    that a table without rows is loaded as such.  What is in an archive is routed by its
    own name, not the archive's.  Names only reach the driver, as in any Spark file
    listing."""
    files = list_files(spark, folder)
    empty = empty_files(spark, folder)
    if empty:
        rows = spark.createDataFrame([(path,) for path in empty], "path string")
        files = files.select("path", "name").union(rows.select("path", base_name(F.col("path"))))
    return route_inputs(spark, files, tables)


def route_inputs(spark: SparkSession, files: DataFrame, tables: Mapping[str, Table]) -> dict[str, Inputs]:
    """The same for a listing (path, name)."""
    patterns = {name: t.pattern for name, t in tables.items()}
    is_zip = F.lower("path").endswith(".zip")
    found: dict[str, Inputs] = {}
    routed = files.withColumn("t", F.when(~is_zip, route(F.col("name"), patterns)))
    zipped: list[str] = []
    for r in routed.filter(is_zip | F.col("t").isNotNull()).select("t", "path").collect():
        if r["t"] is None:
            zipped.append(r["path"])
        else:
            found.setdefault(r["t"], Inputs()).paths.append(r["path"])
    if zipped:
        inside = list_members(spark, zipped).select(
            route(base_name(F.col("member")), patterns).alias("t"), "archive", "member"
        )
        for r in inside.filter(F.col("t").isNotNull()).collect():
            found.setdefault(r["t"], Inputs()).members.append((r["archive"], r["member"]))
    return found


def scan(spark: SparkSession, table: Table, inputs: Inputs, **options: object) -> DataFrame:
    """Plain and zipped files of one table together."""
    parts = []
    if inputs.paths:
        parts.append(scan_delimited(spark, table, inputs.paths, **options))
    if inputs.members:
        listed = spark.createDataFrame(inputs.members, "archive string, member string")
        parts.append(scan_members(table, listed, n_members=len(inputs.members)))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def stored_keys(spark: SparkSession, out_path: str, table: Table, snapshot: str, part: str) -> DataFrame | None:
    """The keys of a month's accepted rows, in all its parts but the one that ``part`` names."""
    target = f"{out_path.rstrip('/')}/{table.name}"
    if not versions.exists(spark, target):
        return None
    rows = read_table(spark, out_path, table, snapshot)
    return rows.filter(F.col(sink.SNAPSHOT) != part).select(table.primary_key)


def reject_known(spark: SparkSession, checked: DataFrame, table: Table, known: DataFrame) -> DataFrame:
    """Checked rows, those with a key of ``known`` rejected.  The rows are written once in
    between, so that their source is read once; tables with a key are code lists, or as narrow."""
    folder = workspace(spark, f"keys-{table.name}")
    checked.write.parquet(f"{folder}/rows")
    rows = spark.read.schema(checked.schema).parquet(f"{folder}/rows")
    key = table.primary_key
    good = rows.filter(~F.col(REJECTED))
    keys.shared_keys(good, known, key).withColumnRenamed(key, "__taken").write.parquet(f"{folder}/taken")
    # Written, so that its size is known: broadcast if small, else a shuffled join.
    taken = small_side(spark.read.parquet(f"{folder}/taken"))
    again = ~F.col(REJECTED) & F.col("__taken").isNotNull()
    flagged = rows.join(taken, F.col(key) == F.col("__taken"), "left").withColumn("__again", again)
    reason = F.array(F.lit(duplicate_reason(table)))
    return flagged.withColumn(REASONS, F.when(F.col("__again"), reason).otherwise(F.col(REASONS))).withColumn(
        REJECTED, F.col(REJECTED) | F.col("__again")
    ).withColumn(RAW, F.when(F.col(REJECTED), F.col(RAW))).select(*checked.columns)


def load_table(spark: SparkSession, table: Table, inputs: Inputs, out_path: str, snapshot: str,
               keep_existing: bool = False, month: str | None = None, **options: object) -> tuple[int, int]:
    """One pass from raw files to one snapshot of a table.

    Accepted and rejected rows go into the same files, told apart by ``rejected``;
    nothing is read or cleaned twice, and the counts are taken on the way.

    Rows that join others, by ``keep_existing`` or as a part of ``month``, are also rejected
    if one of those has their primary key: what is stored stays.
    """
    joins = table.primary_key is not None and (keep_existing or month is not None)
    known = stored_keys(spark, out_path, table, month or snapshot, "" if keep_existing else snapshot) if joins else None
    target = f"{out_path.rstrip('/')}/{table.name}"

    def write(**scanned: object) -> tuple[int, int, int]:
        seen = Observation(f"load {table.name}")
        found = scan(spark, table, inputs, **options, **scanned)
        checked = typed_with_reasons(found, table, SOURCE_FILE, unique=True, keep_raw=known is not None)
        checked = checked.select([f.name for f in stored_schema(table).fields])
        if known is not None:
            checked = reject_known(spark, checked, table, known)
        checked = checked.observe(
            seen,
            F.count_if(~F.col(REJECTED)).alias("accepted"),
            F.count_if(REJECTED).alias("rejected"),
            F.count_if(F.col(LONG_RECORD) == OPEN_CELL).alias("opened"),
        )
        (sink.append_snapshot if keep_existing else sink.replace_snapshot)(checked, target, snapshot)
        return tuple(seen.get[n] for n in ("accepted", "rejected", "opened"))

    # Text without line breaks in cells is read once.  Where a line shows that there are some, what
    # was written is replaced by a load that looks for their files first.
    tries = inputs.paths and not keep_existing and not {"multi_line", "broken"} & set(options)
    accepted, rejected, opened = write(mark_open=True) if tries else write()
    if tries and opened:
        accepted, rejected, _ = write()
    if not keep_existing and accepted + rejected == 0:
        sink.clear_snapshot(spark.createDataFrame([], stored_schema(table)), target, snapshot)
    return accepted, rejected


def load_snapshot(spark: SparkSession, folder: str, out_path: str, snapshot: str,
                  tables: Mapping[str, Table] = REGISTRY, keep_existing: bool = False,
                  at_once: int = 4, **options: object) -> dict[str, tuple[int, int]]:
    """Load every table that has files; (accepted, rejected) rows per table.

    The small code lists come first; tables do not depend on each other, so a few
    are written at a time and one table's last tasks do not idle the cluster.
    """
    found = find_inputs(spark, folder, tables)
    order = [t for t in LOAD_ORDER if t in tables] + [t for t in tables if t not in LOAD_ORDER]

    def one(name: str) -> tuple[int, int]:
        return load_table(spark, tables[name], found[name], out_path, snapshot, keep_existing, **options)

    with ThreadPoolExecutor(at_once) as pool:
        started = {name: pool.submit(one, name) for name in order if name in found}
        return {name: job.result() for name, job in started.items()}


def read_table(spark: SparkSession, out_path: str, table: Table, snapshot: str | None = None) -> DataFrame:
    """The accepted rows.  ``rejected`` is pushed into the scan."""
    stored = sink.read_snapshots(
        spark, f"{out_path.rstrip('/')}/{table.name}", stored_schema(table), snapshot
    )
    return stored.filter(~F.col(REJECTED)).select(*table.columns, sink.SNAPSHOT)


def read_rejects(spark: SparkSession, out_path: str, table: Table, snapshot: str | None = None) -> DataFrame:
    """The rejected rows with their raw cells and reasons."""
    stored = sink.read_snapshots(
        spark, f"{out_path.rstrip('/')}/{table.name}", stored_schema(table), snapshot
    )
    return stored.filter(REJECTED).select(RAW, LONG_RECORD, REASONS, SOURCE_FILE, sink.SNAPSHOT)
