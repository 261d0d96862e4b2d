"""ZIP archives as rows: one task per archive member, streamed.

Python only inflates and finds record ends; cells are parsed by Spark's own CSV
parser.  Archives are opened by path inside the tasks, so neither the driver
nor a row ever holds an archive.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.schema import Table
from rollbook.sources.delimited import SOURCE_FILE, finish_scan, parse_records
from rollbook.sources.records import BATCH_CHARS, BATCH_ROWS, MOST_CHARS, records, text_lines

BLOCK = 4 << 20

MEMBERS = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("member", T.StringType()),
        T.StructField("size", T.LongType()),
    ]
)
RECORDS = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("member", T.StringType()),
        T.StructField("at", T.LongType()),
        T.StructField("chars", T.LongType()),
        T.StructField("record", T.StringType()),
    ]
)


#: Stores that tasks can open for themselves.  Archives elsewhere must be unpacked first;
#: plain files are read by Spark from any store.
SCHEMES = ("file", "hdfs", "viewfs", "s3", "s3a", "s3n", "gs", "gcs")


def check_scheme(path: str) -> None:
    scheme = path.split(":", 1)[0] if ":" in path.split("/", 1)[0] else "file"
    if scheme not in SCHEMES:
        raise ValueError(f"archives cannot be opened in {scheme}: stores, only in {', '.join(SCHEMES)}")


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path for a URI or a plain path, inside any task."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        scheme, rest = path.split("://", 1)
        return pafs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")
    return pafs.LocalFileSystem(), path


def open_archive(path: str) -> zipfile.ZipFile:
    system, name = open_path(path)
    return zipfile.ZipFile(system.open_input_file(name))


def _list_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            with open_archive(path) as archive:  # a broken archive fails the job
                rows = [
                    {"archive": path, "member": i.filename, "size": i.file_size}
                    for i in archive.infolist()
                    if not i.is_dir()
                ]
            yield pa.RecordBatch.from_pylist(
                rows, pa.schema([("archive", pa.string()), ("member", pa.string()), ("size", pa.int64())])
            )


def _member_blocks(path: str, member: str, encoding: str) -> Iterator[str]:
    with open_archive(path) as archive, archive.open(member) as raw:
        reader = io.TextIOWrapper(raw, encoding=encoding, newline="")
        while block := reader.read(BLOCK):
            yield block


def list_members(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(archive, member, size) from the archives' directories, one task each."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    for path in paths:
        check_scheme(path)
    found = spark.read.format("binaryFile").options(
        recursiveFileLookup="true", pathGlobFilter="*.[zZ][iI][pP]"
    ).load(paths).select("path")  # listing only: the content column is not read
    return found.mapInArrow(_list_members, MEMBERS)


def read_members(members: DataFrame, sep: str = ";", encoding: str = "latin-1") -> DataFrame:
    """(archive, member, chars, record) of the listed members."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["archive", "member"]).to_pylist():
                chunk: list[str] = []
                held = 0

                def flush() -> pa.RecordBatch:
                    return pa.RecordBatch.from_arrays(
                        [
                            pa.repeat(pa.scalar(row["archive"], pa.string()), len(chunk)),
                            pa.repeat(pa.scalar(row["member"], pa.string()), len(chunk)),
                            pa.repeat(pa.scalar(0, pa.int64()), len(chunk)),
                            pa.repeat(pa.scalar(MOST_CHARS + 1, pa.int64()), len(chunk)),
                            pa.array(chunk, pa.string()),
                        ],
                        names=["archive", "member", "at", "chars", "record"],
                    )

                blocks = _member_blocks(row["archive"], row["member"], encoding)
                for record in records(text_lines(blocks), sep):
                    chunk.append(record)
                    held += len(record or "")
                    if len(chunk) >= BATCH_ROWS or held >= BATCH_CHARS:
                        yield flush()
                        chunk.clear()
                        held = 0
                if chunk:
                    yield flush()

    return members.mapInArrow(read, RECORDS)


def scan_members(
    table: Table,
    members: DataFrame,
    *,
    sep: str = ";",
    encoding: str = "latin-1",
    spread: bool | None = None,
    n_members: int | None = None,
) -> DataFrame:
    """The same columns as ``scan_delimited``, from (archive, member) rows.

    A deflated member can only be inflated from its start, so it is one task's
    stream.  ``spread`` redistributes the raw records right after that, in
    evenly sized partitions, so parsing and cleaning a huge member is shared; by
    default that is done if there are fewer members than cores.
    """
    # The listing is a few rows of text, which AQE would fold into one task; an explicit
    # partition count is left alone.
    n = n_members or max(1, members.count())
    lines = read_members(members.repartitionByRange(n, "archive", "member"), sep, encoding)
    # With a member for every core nothing is gained by moving the raw text.
    if n < members.sparkSession.sparkContext.defaultParallelism if spread is None else spread:
        lines = lines.hint("rebalance")
    named = lines.select(F.concat_ws("!", "archive", "member").alias(SOURCE_FILE), "at", "chars", "record")
    return finish_scan(parse_records(named, table, sep), table, sep)


def scan_zip(
    spark: SparkSession, table: Table, paths: str | Sequence[str], **options: object
) -> DataFrame:
    """All members of all archives below the paths, as one table."""
    return scan_members(table, list_members(spark, paths), **options)
