"""Records of delimited text whose quoted cells may hold line breaks.

``records`` joins the lines of one stream.  ``broken_records`` does the same for files
of any size, read in splits by Spark: every split is walked on its own, for both cases of
starting outside and inside a quoted cell; window functions over the list of splits then
tell how each really starts, and records that cross splits are put together from their
pieces.

A line ends with LF only, so that CR and CR LF inside a cell stay; one CR at the end of a
record belongs to the record's end.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BATCH_ROWS = 20_000
BATCH_CHARS = 4 << 20
# A record of more characters is a quote left open.  It is set apart by file and offset,
# and its text is not gathered.
MOST_CHARS = 1 << 20

SPLIT = ["path", "start", "length"]


def closed_record(sep: str) -> re.Pattern[str]:
    """Matches a text that does not end inside a quoted cell."""
    s = re.escape(sep)
    cell = rf'(?:"(?:[^"]++|"")*+"[^{s}]*+|(?!")[^{s}]*+)'
    return re.compile(rf"{cell}(?:{s}{cell})*+")


class OpenCell:
    """Does a line end inside a quoted cell?"""

    def __init__(self, sep: str) -> None:
        self.closed = closed_record(sep)
        self.border = f'"{sep}"'

    def after(self, line: str, is_open: bool) -> bool:
        quotes = line.count('"')
        if not quotes:
            return is_open
        if not is_open and line[0] == '"' == line[-1] and quotes == 2 * (line.count(self.border) + 1):
            return False  # every quote is a border of a cell
        # Inside a cell the line reads as if the cell began right before it.
        return not self.closed.fullmatch('"' + line if is_open else line)


def text_lines(blocks: Iterable[str]) -> Iterator[str]:
    r"""Lines, without their \n, of a text that arrives in blocks."""
    rest = ""
    for block in blocks:
        *lines, rest = (rest + block).split("\n")
        yield from lines
    if rest:
        yield rest


def bare(record: str) -> str:
    return record[:-1] if record.endswith("\r") else record


class Record:
    """The lines of a record that is not yet complete."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.chars = 0

    def add(self, line: str) -> None:
        self.chars += len(line) + 1
        if self.chars <= MOST_CHARS:
            self.lines.append(line)
        else:
            self.lines.clear()

    def text(self) -> str | None:
        """The whole text, or None if it is too long for a record."""
        return bare("\n".join(self.lines)) if self.chars <= MOST_CHARS else None


def records(lines: Iterable[str], sep: str) -> Iterator[str | None]:
    """Join lines until no quoted cell is open; blank lines are skipped, and a record
    of more than MOST_CHARS is None."""
    cell = OpenCell(sep)
    held: Record | None = None
    for line in lines:
        is_open = cell.after(line, held is not None)
        if held is None and not is_open:
            if line.strip():
                yield bare(line)
            continue
        held = held or Record()
        held.add(line)
        if not is_open:
            yield held.text()
            held = None
    if held:
        yield held.text()


def read_lines(spark: SparkSession, files: list[str], encoding: str) -> DataFrame:
    """(path, start, length, at, line): text by file and split; ``at`` orders the lines
    of a split."""
    return spark.read.text(files, lineSep="\n", recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        F.monotonically_increasing_id().alias("at"),
        F.decode(F.col("value").cast("binary"), encoding).alias("line"),
    )


def _by_split(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple]:
    """((path, start, length, *more), line) of every line, in order."""
    for batch in batches:
        keys = zip(*[batch.column(c).to_pylist() for c in (*SPLIT, *more)])
        yield from zip(keys, batch.column("line").to_pylist())


ENDS = "path string, start long, length long, after_closed boolean, after_open boolean, closes boolean"
PIECES = "path string, origin long, at long, chars long, record string"


def split_ends(lines: DataFrame, sep: str) -> DataFrame:
    """One row per split: is a cell open at its end, if none or one was open at its
    start, and does one that was open ever close."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = OpenCell(sep)
        split, states = None, [False, True, False]

        def row() -> pa.RecordBatch:
            names = [*SPLIT, "after_closed", "after_open", "closes"]
            return pa.RecordBatch.from_pydict(dict(zip(names, [[v] for v in (*split, *states)])))

        for key, line in _by_split(batches):
            if key != split:
                if split:
                    yield row()
                split, states = key, [False, True, False]
            if '"' in line:
                states[0] = cell.after(line, states[0])
                states[1] = cell.after(line, states[1])
                states[2] |= not states[1]
        if split:
            yield row()

    ordered = lines.sortWithinPartitions(*SPLIT, "at")  # a join may have moved them
    return ordered.select(*SPLIT, "line").mapInArrow(walk, ENDS)


def split_starts(ends: DataFrame) -> DataFrame:
    """(path, start, length, origin) of every split: where the record began that is open
    at its start, or null.

    What a split does to the state (closed or open) is one of four functions: both to
    closed, both to open, keep, or swap.  The state at a start is what the last split
    before with a fixed result left, swapped once for each swapping split since; a file
    begins closed.  The windows hold one row per split of one file.
    """
    here = Window.partitionBy("path").orderBy("start")
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("after_closed") == F.col("after_open")
    swaps = (F.col("after_closed") & ~F.col("after_open")).cast("int")
    known = ends.withColumn("swaps", F.coalesce(F.sum(swaps).over(before), F.lit(0)))
    last = F.max(
        F.when(fixed, F.struct("start", F.col("swaps").alias("at"), F.col("after_closed").alias("open")))
    ).over(before)
    known = known.withColumn("last", last)
    since = F.col("swaps") - F.coalesce("last.at", F.lit(0))
    known = known.withColumn(
        "open", F.coalesce("last.open", F.lit(False)) != (since % 2 == 1)
    )
    # A record open at a start began in the last split in which one could begin.
    begins = F.when(~F.col("open") | F.col("closes"), F.col("start"))
    known = known.withColumn("origin", F.max(begins).over(before))
    return known.select(*SPLIT, F.when(F.col("open"), F.col("origin")).alias("origin"))


def broken_records(lines: DataFrame, sep: str, folder: str) -> DataFrame:
    """(path, record, chars) of files with line breaks in cells, by as many tasks as they
    have splits.  A record of more than MOST_CHARS is null, with its first byte's split
    in ``origin``.

    The list of splits is written once.  Splits are cut by Spark when a job runs, by
    settings that may differ by then: a split that is not on the list is an error.
    """
    path = f"{folder}/splits"
    split_starts(split_ends(lines, sep)).write.mode("overwrite").parquet(path)
    splits = lines.sparkSession.read.parquet(path).withColumn("listed", F.lit(True))
    known = lines.join(splits, SPLIT, "left").sortWithinPartitions(*SPLIT, "at")
    changed = F.raise_error(F.concat(
        F.lit("splits of this file have changed since the scan was built; build it again: "), "path"
    ))
    known = known.select(
        *SPLIT, "origin", F.when(F.col("listed"), F.col("line")).otherwise(changed.cast("string")).alias("line")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = OpenCell(sep)
        rows: list[tuple] = []
        size = 0
        split, origin, held = None, None, None

        def flush() -> pa.RecordBatch:
            nonlocal size
            columns = [list(c) for c in zip(*rows)]
            rows.clear()
            size = 0
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["path", "origin", "at", "chars", "record"],
            )

        def piece() -> None:
            """Part of a record that crosses the split's border."""
            nonlocal size
            text = "\n".join(held.lines) if held.chars <= MOST_CHARS else None
            rows.append((split[0], origin, split[1], held.chars, text))
            size += held.chars if text else 0

        for key, line in _by_split(batches, "origin"):
            if key != split:
                if held:
                    piece()
                split, origin = key, key[3]
                held = Record() if origin is not None else None
            is_open = cell.after(line, held is not None)
            if held is None and not is_open:
                if line.strip():
                    rows.append((split[0], None, split[1], len(line), bare(line)))
                    size += len(line)
            else:
                if held is None:
                    held, origin = Record(), split[1]
                    whole = True
                elif not held.lines and not held.chars:
                    whole = False  # goes on from an earlier split
                held.add(line)
                if not is_open:
                    if whole:
                        rows.append((split[0], None, split[1], held.chars, held.text()))
                        size += len(rows[-1][4] or "")
                    else:
                        piece()
                    held = None
            if len(rows) >= BATCH_ROWS or size >= BATCH_CHARS:
                yield flush()
        if held:
            piece()
        if rows:
            yield flush()

    pieces = known.mapInArrow(cut, PIECES)
    whole = pieces.filter("origin IS NULL").select("path", "at", "chars", "record")
    # A record cut by split borders: its pieces' texts come together if it is not too long.
    crossing = pieces.filter("origin IS NOT NULL")
    size = crossing.groupBy("path", "origin").agg(F.sum("chars").alias("total"))
    fits = crossing.join(size, ["path", "origin"]).select(
        "path", "origin", "at", "total", F.when(F.col("total") <= MOST_CHARS, F.col("record")).alias("record")
    )
    joined = fits.groupBy("path", "origin").agg(
        F.max("total").alias("chars"),
        F.array_sort(F.collect_list(F.when(F.col("record").isNotNull(), F.struct("at", "record")))).alias("p"),
    )
    text = F.regexp_replace(F.array_join("p.record", "\n"), "\r$", "")
    return whole.unionByName(joined.select(
        "path", F.col("origin").alias("at"), "chars", F.when(F.size("p") > 0, text).alias("record")
    ))
