r"""Headerless delimited text, every cell a string, columns named by position.

Files of any size are read the same way: as lines, in splits.  A file without line breaks
in its cells has a record per line; the few files that have some are found by a first,
splittable pass and go through ``records.broken_records``.  All records are parsed by
Spark's CSV parser.  A record ends with LF, or with CR LF; CR and CR LF in a cell stay.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.functions.clean import null_token
from rollbook.schema import Table
from rollbook.session import workspace
from rollbook.sources.records import broken_records, read_lines

SOURCE_FILE = "source_file"
LONG_RECORD = "long_record"
_CORRUPT = "_corrupt_record"
_TOO_LONG = "_too_long"

OPEN_CELL = "a quoted cell is left open at the end of the line"

NAMED_FILES = 1000  # so many files with line breaks are named in the plan, more are joined

SNAPSHOT_IN_PATH = r"(\d{4}-\d{2})(?:/|$)"


def csv_options(sep: str = ";") -> dict[str, str]:
    return {
        "sep": sep,
        "lineSep": "\n",
        "quote": '"',
        "escape": '"',  # a quote inside a quoted cell is doubled
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _CORRUPT,
        # The reader itself maps empty cells, quoted or not, and NULL.
        "nullValue": "NULL",
        "emptyValue": "NULL",
        "maxCharsPerColumn": "-1",
    }


def parsed_schema(table: Table) -> T.StructType:
    return T.StructType([*table.raw_schema.fields, T.StructField(_CORRUPT, T.StringType())])


def _without_quoted_cells(line: Column, sep: str, stand_in: str = "") -> Column:
    """Take out every well-formed quoted cell; doubled quotes go first.  A quote
    that is still there belongs to a cell left open or to a stray quote."""
    s = re.escape(sep)
    return F.regexp_replace(
        F.replace(line, F.lit('""'), F.lit("")),
        rf'(^|{s})"[^"]*"(?={s}|$)',
        f"$1{stand_in}",
    )


def may_continue(line: Column, sep: str = ";") -> Column:
    """True for every line that ends inside a quoted cell (and for a few with
    stray quotes, which only costs splitting)."""
    # Nearly all lines are a row of whole cells, which is quicker to see than to take apart.
    s = re.escape(sep)
    cell = rf'(?:"[^"]*+"|[^"{s}]*+)'
    whole = F.replace(line, F.lit('""'), F.lit("")).rlike(rf"^{cell}(?:{s}{cell})*+$")
    return line.contains('"') & ~whole & _without_quoted_cells(line, sep).contains('"')


def field_count(record: Column, sep: str = ";") -> Column:
    return F.size(F.split(_without_quoted_cells(record, sep, "q"), re.escape(sep)))


def parse_records(found: DataFrame, table: Table, sep: str) -> DataFrame:
    """(source_file, record) to text columns.  A line break inside a record is always in
    a quoted cell.  A null record was too long to be one; it stays without cells."""
    schema = ", ".join(f"`{f.name}` string" for f in parsed_schema(table).fields)
    cells = F.from_csv("record", schema, csv_options(sep)).alias("cells")
    note = F.when(F.col("chars") < 0, F.lit(OPEN_CELL)).when(F.col("record").isNull(), F.concat(
        F.lit("record of "), F.col("chars").cast("string"), F.lit(" characters in the split at byte "),
        F.col("at").cast("string"),
    ))
    return found.select(cells, SOURCE_FILE, note.alias(_TOO_LONG)).select("cells.*", SOURCE_FILE, _TOO_LONG)


def finish_scan(parsed: DataFrame, table: Table, sep: str) -> DataFrame:
    """The last null token, and over-long records set apart from padded short ones.

    The parser marks both kinds of wrong arity as corrupt; a short record is
    padded and kept, a long one keeps its text in ``long_record``.
    """
    n = len(table.columns)
    corrupt = F.col(_CORRUPT)
    is_long = corrupt.isNotNull() & (field_count(corrupt, sep) > n)
    # No filter here: Spark would push it below the parser and parse every line a second time for
    # it.  Blank lines are gone already, by all that find records.
    return parsed.select(
        *[null_token(F.col(c), ("null",)).alias(c) for c in table.columns],
        F.coalesce(F.col(_TOO_LONG), F.when(is_long, corrupt)).alias(LONG_RECORD),
        SOURCE_FILE,
    )


def plain_records(lines: DataFrame, mark_open: str | None = None) -> DataFrame:
    """(path, at, chars, record): a record per line, blank lines skipped.

    ``mark_open``, a separator, has lines that may go on in the next one without a record
    and with -1 characters: their file is to be read again for line breaks in cells.
    """
    found = lines.filter(F.btrim("line", F.lit(" \r")) != "")
    record = F.regexp_replace("line", "\r$", "")
    record = F.when(F.col("line").endswith("\r"), record).otherwise(F.col("line"))
    chars = F.length("line").cast("long")
    if mark_open is not None:
        # In a step of its own, as two columns go by it.
        found = found.select("path", "start", "line", may_continue(F.col("line"), mark_open).alias("opened"))
        opened = F.col("opened")
        record, chars = F.when(~opened, record), F.when(opened, F.lit(-1).cast("long")).otherwise(chars)
    return found.select("path", F.col("start").alias("at"), chars.alias("chars"), record.alias("record"))


def broken_files(spark: SparkSession, paths: Sequence[str], sep: str = ";",
                 encoding: str = "ISO-8859-1") -> tuple[DataFrame, list[str] | None]:
    """The files with a line break in a cell, as a written table, and by name if there
    are at most NAMED_FILES."""
    lines = read_lines(spark, list(paths), encoding)
    target = f"{workspace(spark, 'broken')}/files"
    lines.filter(may_continue(F.col("line"), sep)).select("path").distinct().write.parquet(target)
    found = spark.read.parquet(target)
    names = [r["path"] for r in found.limit(NAMED_FILES + 1).collect()]
    return found, names if len(names) <= NAMED_FILES else None


def scan_delimited(
    spark: SparkSession,
    table: Table,
    paths: str | Sequence[str],
    *,
    sep: str = ";",
    encoding: str = "ISO-8859-1",
    multi_line: bool | None = None,
    broken: Sequence[str] | None = None,
    mark_open: bool = False,
) -> DataFrame:
    """All files of a table as one DataFrame of text columns.

    ``multi_line`` None finds out which files have line breaks in cells; True takes all
    to have some and False none.  ``broken`` names those files if that is known already.
    With ``mark_open`` files without line breaks are read once: a line that may go on in
    the next one becomes a row with OPEN_CELL as its ``long_record``.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = read_lines(spark, paths, encoding)
    folder = workspace(spark, "scan")
    if mark_open:
        found = plain_records(lines, sep)
    elif multi_line is not None:
        found = broken_records(lines, sep, folder) if multi_line else plain_records(lines)
    else:
        hits, names = (None, list(broken)) if broken is not None else broken_files(spark, paths, sep, encoding)
        if names is None:
            outside = lines.join(hits, "path", "left_anti")
            inside = lines.join(hits, "path", "left_semi")
            found = plain_records(outside).unionByName(broken_records(inside, sep, folder))
        elif names:
            # Names in the plan prune files.  file_path is URI-encoded, readers take plain paths.
            inside = read_lines(spark, sorted(unquote(n) for n in names), encoding)
            outside = lines.filter(~F.col("path").isin(*names))
            found = plain_records(outside).unionByName(broken_records(inside, sep, folder))
        else:
            found = plain_records(lines)
    return finish_scan(parse_records(found.withColumnRenamed("path", SOURCE_FILE), table, sep), table, sep)


def snapshot_of(path: Column) -> Column:
    """The month folder in a path or URL, e.g. '2025-10'."""
    return F.regexp_extract(path, SNAPSHOT_IN_PATH, 1)
