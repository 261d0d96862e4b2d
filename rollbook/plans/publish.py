"""Load the files of a folder that changed, and publish all tables of a store at once.

A store keeps the rows of every source file in a part of its own, so a file that changed is
read alone: its new part takes the place of the old one, and parts of files that are gone are
left out.  What is live is a version (``sinks.versions``); a load that fails publishes nothing.

Tables with a primary key hold each key once over all files of a month: their rows are few
next to the others', so after a change the stored parts of the month are read back (not
their files) and written with the new ones, flags made anew.  The result is that of loading
all files at once.

Archives are told apart by their size as plain files are; the members of one that is new or
changed are all read again.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.functions.match import like_any
from rollbook.operators import manifest
from rollbook.operators.shape import RAW, REASONS, REJECTED, flag_duplicates, typed_with_reasons
from rollbook.plans.load import Inputs, scan, stored_schema
from rollbook.schema import LOAD_ORDER, LOOKUP_COLUMNS, REGISTRY, SEARCH_COLUMNS, Table
from rollbook.session import setting
from rollbook.sinks import index, layout, versions
from rollbook.sinks.tables import SNAPSHOT
from rollbook.sources.archive import list_members
from rollbook.sources.delimited import LONG_RECORD, OPEN_CELL, SOURCE_FILE
from rollbook.sources.files import base_name, plain_path, route

log = logging.getLogger(__name__)

FILE_BYTES = 128 << 20  # of a stored file, which ``compact`` aims at
#: A task's rows are of a few sources: so many are written side by side as the rows come, and only
#: those of more are sorted by source first.
UNSORTED = ("spark.sql.maxConcurrentOutputFileWriters", "4")
SOURCE = "source"  # the folder of a source file's rows: a hash of its name
LISTING = "table_name string, source string, size long, archive string, member string"


@dataclass
class Loaded:
    """What a load did: (accepted, rejected) rows that its changed tables hold now, the files
    it read, the version it published (None if nothing had changed), the catalog tables it
    wrote, and the indexes that failed."""

    counts: dict[str, tuple[int, int]] = field(default_factory=dict)
    read: list[str] = field(default_factory=list)
    version: int | None = None
    catalog: dict[str, str] = field(default_factory=dict)
    failed: dict[str, dict[str, str]] = field(default_factory=dict)


def list_sources(spark: SparkSession, folder: str, tables: Mapping[str, Table]) -> DataFrame:
    """(table_name, source, size, archive, member) of every file and archive member that is
    some table's, from one listing.  Names and sizes only reach the driver, as in any Spark
    file listing; files without bytes count."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    sizes = {plain_path(unquote(name)): 0 for name in files.inputFiles()}
    sizes |= {plain_path(r["path"]): r["length"] for r in files.select("path", "length").collect()}
    patterns = {name: t.pattern for name, t in tables.items()}
    listed = spark.createDataFrame(list(sizes.items()), "source string, size long")
    is_zip = F.lower("source").endswith(".zip")
    plain = listed.filter(~is_zip).select(
        route(base_name(F.col("source")), patterns).alias("table_name"), "source", "size",
        F.lit(None).cast("string").alias("archive"), F.lit(None).cast("string").alias("member"),
    )
    zipped = [path for path in sizes if path.lower().endswith(".zip")]
    if zipped:
        members = list_members(spark, zipped).select(plain_name(F.col("archive")).alias("archive"), "member")
        plain = plain.union(
            members.join(listed.withColumnRenamed("source", "archive"), "archive").select(
                route(base_name(F.col("member")), patterns).alias("table_name"),
                F.concat_ws("!", "archive", "member").alias("source"), "size", "archive", "member",
            )
        )
    return spark.createDataFrame(plain.filter("table_name IS NOT NULL").collect(), LISTING)


def plain_name(path):
    """``files.plain_path`` for a column."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def rows_of(spark: SparkSession, table: Table, sources: Iterable[tuple], **options: object) -> DataFrame:
    """Checked rows of some sources (source, archive, member)."""
    inputs = Inputs()
    for source, archive, member in sources:
        if archive is None:
            inputs.paths.append(source)
        else:
            inputs.members.append((archive, member))
    found = scan(spark, table, inputs, **options)
    return typed_with_reasons(found, table, SOURCE_FILE, keep_raw=table.primary_key is not None).select(
        [f.name for f in stored_schema(table).fields]
    )


def write_parts(rows: DataFrame, root: str, table: Table, load: str) -> list[tuple]:
    """Write rows by source file; (source file, part, accepted, rejected, open cells)."""
    folder = f"{root}/{table.name}/{load}"
    by_file = F.hex(F.xxhash64(F.coalesce(SOURCE_FILE, F.lit(""))))
    rows.withColumn(SOURCE, by_file).write.mode("overwrite").partitionBy(SOURCE).parquet(folder)
    schema = f"{SOURCE_FILE} string, {LONG_RECORD} string, {REJECTED} boolean, {SOURCE} string"
    counted = rows.sparkSession.read.schema(schema).parquet(folder).groupBy(SOURCE_FILE, SOURCE).agg(
        F.count_if(~F.col(REJECTED)), F.count_if(REJECTED), F.count_if(F.col(LONG_RECORD) == OPEN_CELL)
    ).collect()  # a row per source file
    if len({r[1] for r in counted}) < len(counted):
        raise ValueError(f"two source files of {table.name} have the same hash")
    return [
        (plain_path(unquote(r[0])), f"{table.name}/{load}/{SOURCE}={r[1]}", r[2], r[3], r[4]) for r in counted
    ]


def stored_rows(spark: SparkSession, root: str, table: Table, parts: Iterable[str]) -> DataFrame:
    """All rows of some parts, rejected ones included."""
    paths = [f"{root}/{p}" for p in parts]
    reader = spark.read.schema(stored_schema(table))
    return reader.parquet(*paths) if paths else spark.createDataFrame([], stored_schema(table))


def load_sources(spark: SparkSession, root: str, table: Table, snapshot: str, fresh: list[tuple],
                 kept: list, **options: object) -> tuple[list[tuple], list[str]]:
    """Parts of a month after ``fresh`` sources (source, size, archive, member) joined ``kept``
    parts, and the loads that were written."""
    started = f"{snapshot}-{uuid.uuid4().hex[:12]}"
    names = {f[0]: f for f in fresh}
    loads = [f"{started}-a"]
    found: dict[str, tuple] = {}
    wanted = [(s, a, m) for s, _, a, m in fresh]
    if wanted:
        # Line breaks in cells are found on the way; only files that have some are read again.
        found = {w[0]: w for w in write_parts(
            rows_of(spark, table, wanted, mark_open=True, **options), root, table, loads[0])}
        broken = [names[s] for s, w in found.items() if w[4] and names[s][2] is None]
        if broken:
            loads.append(f"{started}-b")
            again = rows_of(spark, table, [(s, a, m) for s, _, a, m in broken], multi_line=True, **options)
            found |= {w[0]: w for w in write_parts(again, root, table, loads[1])}
    if table.primary_key and (found or kept):
        live = [w[1] for w in found.values()] + [k["part"] for k in kept if k["part"]]
        loads.append(f"{started}-c")
        whole = flag_duplicates(stored_rows(spark, root, table, live), table, SOURCE_FILE)
        found = {w[0]: w for w in write_parts(whole, root, table, loads[-1])}
        loads = loads[-1:]
        sizes = {f[0]: f[1] for f in fresh} | {k["source"]: k["size"] for k in kept}
        kept = []
    else:
        sizes = {f[0]: f[1] for f in fresh}
    new = []
    for source, size in sizes.items():
        _, part, accepted, rejected, _ = found.get(source, (source, None, 0, 0, 0))
        load = part.split("/")[1] if part else None
        new.append((table.name, snapshot, source, size, load, part, accepted, rejected,
                    part_bytes(spark, f"{root}/{part}") if part else 0))
    return [tuple(k) for k in kept] + new, [w for w in loads if any(w == n[4] for n in new)]


def part_bytes(spark: SparkSession, path: str) -> int:
    system, target = versions.file_system(spark, path)
    return system.getContentSummary(target).getLength()


def load_changed(spark: SparkSession, folder: str, root: str, snapshot: str, database: str | None = None,
                 tables: Mapping[str, Table] = REGISTRY, at_once: int = 4, buckets: int | None = None,
                 **options: object) -> Loaded:
    """Read the files of a month that are new or changed since the version before, and publish.

    The columns that lookups and searches go by are indexed, part by part.  With ``database``
    the changed tables are also laid out as catalog tables, bucketed by their join key.
    """
    root = root.rstrip("/")
    before, live = versions.parts(spark, root)
    live = live.collect()  # a row per source file
    mine = [r for r in live if r["snapshot"] == snapshot and r["table_name"] in tables]
    known = versions.as_parts(spark, [tuple(r) for r in mine]).select("source", "size")
    listing = list_sources(spark, folder, tables)
    status = {r["source"]: r for r in manifest.diff(listing, known, "source").collect()}
    by_table: dict[str, tuple[list, list]] = {}
    for name in [t for t in LOAD_ORDER if t in tables] + [t for t in tables if t not in LOAD_ORDER]:
        fresh = [(r["source"], r["size"], r["archive"], r["member"]) for r in status.values()
                 if r["table_name"] == name and r["status"] != manifest.UNCHANGED]
        own = [r for r in mine if r["table_name"] == name]
        same = [r for r in own if r["source"] in status and status[r["source"]]["status"] == manifest.UNCHANGED]
        if fresh or len(same) < len(own):
            by_table[name] = fresh, same
    if not by_table:
        return Loaded()

    def one(name: str) -> tuple[list[tuple], list[str]]:
        return load_sources(spark, root, tables[name], snapshot, *by_table[name], **options)

    with setting(spark, *UNSORTED), ThreadPoolExecutor(at_once) as pool:
        started = {name: pool.submit(one, name) for name in by_table}
        done = {name: job.result() for name, job in started.items()}
    out = Loaded(read=sorted(f[0] for fresh, _ in by_table.values() for f in fresh))
    others = [tuple(r) for r in live if r["snapshot"] != snapshot or r["table_name"] not in by_table]
    for name, (rows, _) in done.items():
        out.counts[name] = sum(r[6] for r in rows), sum(r[7] for r in rows)
    out.failed = build_indexes(spark, root, {name: loads for name, (_, loads) in done.items()}, at_once)
    parts = versions.as_parts(spark, others + [r for rows, _ in done.values() for r in rows])
    out.version = versions.publish(spark, root, before, parts)
    if database is not None:
        out.catalog = arrange(spark, root, {n: tables[n] for n in by_table}, snapshot, database, buckets, at_once)
    return out


def compact(spark: SparkSession, root: str, table: Table, snapshot: str,
            target_bytes: int = FILE_BYTES) -> list[str]:
    """Write the parts of a month that lie in more files than their bytes ask for into fewer, and
    publish; returns these parts' sources.  Rows, and versions before, stay as they are, so it can
    be repeated, and finds nothing then; a load that publishes meanwhile makes it a ``Conflict``.

    A source file's rows stay apart from others', so there is one file per source at least.
    """
    root = root.rstrip("/")
    before, live = versions.parts(spark, root)
    rows = [tuple(r) for r in live.collect()]  # a row per source file
    loose = {}
    for r in live.filter(
        (F.col("table_name") == table.name) & (F.col("snapshot") == snapshot) & F.col("part").isNotNull()
    ).collect():
        n_files = sum(name.endswith(".parquet") for name in versions.children(spark, f"{root}/{r['part']}"))
        if n_files > 1 + r["bytes"] // target_bytes:
            loose[r["part"]] = r["source"]
    if not loose:
        return []
    load = f"{snapshot}-{uuid.uuid4().hex[:12]}-d"
    # Gathered by source; Spark cuts a large one into as many tasks as its bytes need.
    packed = stored_rows(spark, root, table, loose).hint("rebalance", F.col(SOURCE_FILE))
    with setting(spark, *UNSORTED):
        parts = {source: part for source, part, *_ in write_parts(packed, root, table, load)}
    moved = [
        (*r[:4], load, parts[r[2]], *r[6:8], part_bytes(spark, f"{root}/{parts[r[2]]}")) if r[5] in loose else r
        for r in rows
    ]
    build_indexes(spark, root, {table.name: [load]})
    versions.publish(spark, root, before, versions.as_parts(spark, moved))
    return sorted(loose.values())


def build_indexes(spark: SparkSession, root: str, loads: Mapping[str, list[str]],
                  at_once: int = 4) -> dict[str, dict[str, str]]:
    """Index new loads, by table; an index that fails does not stop the rest, and lookups do
    without it.  Returns the failures, by table and column."""
    wanted = [
        (table, load, kind, column)
        for kind, columns in ((index.VALUES, LOOKUP_COLUMNS), (index.GRAMS, SEARCH_COLUMNS))
        for table, own in loads.items() for load in own for column in columns.get(table, ())
    ]
    failed: dict[str, dict[str, str]] = {}

    def one(table: str, load: str, kind: str, column: str) -> None:
        try:
            rows = spark.read.parquet(f"{root}/{table}/{load}").filter(~F.col(REJECTED))
            index.build(rows, kind, column, index.path_of(root, table, load, kind, column))
        except Exception as error:  # noqa: BLE001 - reported, the rest goes on
            log.warning("no index of %s.%s: %s", table, column, error)
            failed.setdefault(table, {})[column] = str(error)

    with ThreadPoolExecutor(at_once) as pool:
        for job in [pool.submit(one, *w) for w in wanted]:
            job.result()
    return failed


def arrange(spark: SparkSession, root: str, tables: Mapping[str, Table], snapshot: str, database: str,
            buckets: int | None = None, at_once: int = 4) -> dict[str, str]:
    """A month of some tables as catalog tables below the store, other months staying; those
    with a join key are bucketed by it, all into the same number of buckets."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/_catalog'")
    _, live = versions.parts(spark, root)
    sizes = {r["table_name"]: r["n"] for r in live.filter(F.col("snapshot") == snapshot)
             .groupBy("table_name").agg(F.sum("bytes").alias("n")).collect()}
    largest = max((n for t, n in sizes.items() if REGISTRY.get(t, tables.get(t)).join_key), default=0)

    def one(name: str) -> str:
        rows = read_table(spark, root, tables[name], snapshot).drop(SNAPSHOT)
        return layout.keep_snapshot(
            rows, f"{database}.{name}", f"{root}/_catalog/{name}", snapshot, tables[name].join_key,
            buckets or layout.bucket_count(largest), analyzed(tables[name]),
        )

    with ThreadPoolExecutor(at_once) as pool:
        started = {name: pool.submit(one, name) for name in tables}
        return {name: job.result() for name, job in started.items()}


def analyzed(table: Table) -> list[str]:
    """Columns whose statistics are worth a pass: all of a code list, which joins may broadcast, and
    the keys and lookup columns of other tables."""
    if table.primary_key:
        return table.columns
    return [c for c in table.columns if c == table.join_key or c in LOOKUP_COLUMNS.get(table.name, ())]


def live_parts(spark: SparkSession, root: str, table: Table, snapshot: str | None = None,
               version: int | None = None) -> dict[str, list[str]]:
    """Part folders by month."""
    _, live = versions.parts(spark, root, version)
    wanted = live.filter((F.col("table_name") == table.name) & F.col("part").isNotNull())
    if snapshot is not None:
        wanted = wanted.filter(F.col("snapshot") == snapshot)
    out: dict[str, list[str]] = {}
    for r in wanted.select("snapshot", "part").collect():
        out.setdefault(r["snapshot"], []).append(r["part"])
    return out


def read_stored(spark: SparkSession, root: str, table: Table, paths: Mapping[str, list[str]]) -> DataFrame:
    """Stored rows of parts, or of single files of them, by month."""
    months = [
        stored_rows(spark, root, table, own).withColumn(SNAPSHOT, F.lit(month))
        for month, own in sorted(paths.items()) if own
    ]
    if not months:
        return stored_rows(spark, root, table, []).withColumn(SNAPSHOT, F.lit(None).cast("string"))
    return reduce(DataFrame.unionByName, months)


def read_table(spark: SparkSession, root: str, table: Table, snapshot: str | None = None,
               version: int | None = None) -> DataFrame:
    """The accepted rows of a published version, the last by default."""
    root = root.rstrip("/")
    rows = read_stored(spark, root, table, live_parts(spark, root, table, snapshot, version))
    return rows.filter(~F.col(REJECTED)).select(*table.columns, SNAPSHOT)


def read_rejects(spark: SparkSession, root: str, table: Table, snapshot: str | None = None,
                 version: int | None = None) -> DataFrame:
    """The rejected rows with their raw cells and reasons."""
    root = root.rstrip("/")
    rows = read_stored(spark, root, table, live_parts(spark, root, table, snapshot, version))
    return rows.filter(REJECTED).select(RAW, LONG_RECORD, REASONS, SOURCE_FILE, SNAPSHOT)


def lookup(spark: SparkSession, root: str, table: Table, where: Mapping[str, object], snapshot: str | None = None,
           version: int | None = None) -> DataFrame:
    """Accepted rows with these values, reading only the files that the indexes name."""
    root = root.rstrip("/")
    parts = live_parts(spark, root, table, snapshot, version)
    files = index.narrowed(spark, root, table.name, parts, [
        (index.VALUES, column, [value], None) for column, value in where.items()
    ])
    rows = read_stored(spark, root, table, files).filter(~F.col(REJECTED)).select(*table.columns, SNAPSHOT)
    return reduce(lambda df, c: df.filter(F.col(c) == F.lit(where[c])), where, rows)


def search(spark: SparkSession, root: str, table: Table, column: str, words: Iterable[str], ci_ai: bool = False,
           snapshot: str | None = None, version: int | None = None) -> DataFrame:
    """Accepted rows whose text holds one of the words, reading only files that the trigram
    index names for one of them; the words themselves decide."""
    root, words = root.rstrip("/"), list(words)
    parts = live_parts(spark, root, table, snapshot, version)
    files = index.narrowed(spark, root, table.name, parts, [(index.GRAMS, column, words, ci_ai)])
    rows = read_stored(spark, root, table, files).filter(~F.col(REJECTED)).select(*table.columns, SNAPSHOT)
    return rows.filter(like_any(F.col(column), words, ci_ai))
