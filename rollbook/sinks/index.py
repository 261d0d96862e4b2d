"""Which files of a store hold a value, or the three-character pieces of a word.

An index is a Spark table of postings per load and column: (key, file).  A lookup reads the
postings of its keys (clustered, with Bloom filters), and the named files instead of the whole
table; the predicate is applied to the rows all the same, so an index can only save work.
Parts of a load without an index, and lookups that would name more than MOST_FILES files, are read
whole.

* VALUES: the column's values.
* GRAMS: every three characters in a row of the folded text.  Folding drops case, accents and
  characters that collation UNICODE_CI_AI ignores, one character at a time, so that a text that
  holds a word, by bytes or by that collation, has all pieces of the folded word.  What the
  fold does not know (all beyond latin-1) is kept for byte search, and for a search by
  collation its file is posted under OTHER and always read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.sinks import layout, versions

VALUES, GRAMS = "values", "grams"
FOLDER = "_index"
PIECE = 3
OTHER = "*"
MOST_FILES = 10_000  # named files of a lookup that reach the driver

# Latin-1 letters and the plain ones that collation UNICODE_CI_AI holds equal.
_PLAIN_OF = {
    "a": "àáâãäåÀÁÂÃÄÅª", "c": "çÇ", "d": "ðÐ", "e": "èéêëÈÉÊË", "i": "ìíîïÌÍÎÏ", "n": "ñÑ",
    "o": "òóôõöøÒÓÔÕÖØº", "u": "ùúûüÙÚÛÜ", "y": "ýÿÝ", "þ": "Þ", "1": "¹", "2": "²", "3": "³",
    " ": "\xa0", "ss": "ß", "ae": "æÆ",
}
# What it ignores: control characters other than tab and line ends, and the soft hyphen.
_IGNORED = "".join(chr(c) for c in (*range(1, 9), *range(14, 32), 127, *range(128, 133), *range(134, 160), 173))


def fold(text: Column) -> Column:
    """Not ``lower``: that of one letter may depend on its neighbours, as of Greek sigma."""
    singles = [(c, plain) for plain, others in _PLAIN_OF.items() if len(plain) == 1 for c in others]
    singles += zip(ascii_uppercase, ascii_lowercase)
    out = F.translate(text, "".join(c for c, _ in singles) + _IGNORED, "".join(p for _, p in singles))
    for plain, others in _PLAIN_OF.items():
        if len(plain) > 1:
            out = reduce(lambda c, other: F.replace(c, F.lit(other), F.lit(plain)), others, out)  # noqa: B023
    return out


def pieces(text: Column) -> Column:
    """The different pieces of folded texts; none for short ones."""
    folded = fold(text)
    starts = F.sequence(F.lit(1), F.char_length(folded) - (PIECE - 1))
    found = F.array_distinct(F.transform(starts, lambda i: F.substr(folded, i, F.lit(PIECE))))
    return F.when(F.char_length(folded) >= PIECE, found)


def path_of(root: str, table: str, load: str, kind: str, column: str) -> str:
    return f"{root}/{FOLDER}/{table}/{load}/{column}.{kind}"


def build(rows: DataFrame, kind: str, column: str, path: str) -> None:
    """Postings of a written load: (key, source, file, rows).  A file's keys fold map-side."""
    key = F.col(column)
    if kind == GRAMS:
        strange = F.when(key.rlike(r"[^\x01-ÿ]"), F.array(F.lit(OTHER)))
        key = F.explode(F.concat(F.coalesce(pieces(key), F.array()), F.coalesce(strange, F.array())))
    found = rows.filter(F.col(column).isNotNull()).select(
        key.alias("key"), "source", F.col("_metadata.file_name").alias("file")
    )
    postings = found.groupBy("key", "source", "file").agg(F.count("*").alias("rows"))
    layout.cluster(postings, path, ["key"], bloom=["key"])


def keys_of(spark: SparkSession, words: Sequence[str]) -> list[list[str] | None]:
    """The pieces of each word; None for one that is too short to have any."""
    frame = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    found = {r["i"]: r["p"] for r in frame.select("i", pieces(F.col("w")).alias("p")).collect()}
    return [found[i] for i in range(len(words))]


def posted(spark: SparkSession, paths: Mapping[str, str], kind: str, wanted: Sequence[object],
           ci_ai: bool | None) -> DataFrame | None:
    """(load, source, file) of the files that may hold one of the wanted values or words."""
    tables = [
        spark.read.parquet(path).select(F.lit(load).alias("load"), "key", "source", "file")
        for load, path in paths.items()
    ]
    postings = reduce(DataFrame.unionByName, tables)
    place = ["load", "source", "file"]
    if kind == VALUES:
        return postings.filter(F.col("key").isin(list(wanted))).select(*place).distinct()
    words = keys_of(spark, wanted)
    # A word of characters that the fold does not know may equal others that it does not.
    if any(p is None for p in words) or (ci_ai and any(ord(c) > 255 or c == "\0" for w in wanted for c in str(w))):
        return None
    hits = [
        postings.filter(F.col("key").isin(p)).groupBy(*place).agg(F.count("*").alias("n"))
        .filter(F.col("n") == len(p)).select(*place)
        for p in words
    ]
    if ci_ai:
        hits.append(postings.filter(F.col("key") == OTHER).select(*place))
    return reduce(DataFrame.union, hits).distinct()


def narrowed(spark: SparkSession, root: str, table: str, parts: Mapping[str, Sequence[str]],
             conditions: Sequence[tuple[str, str, Sequence[object], bool | None]]) -> dict[str, list[str]]:
    """Paths to read, by month, in place of whole parts: (kind, column, wanted, ci_ai) must all
    hold."""
    out = {month: list(own) for month, own in parts.items()}
    for kind, column, wanted, ci_ai in conditions:
        loads = sorted({p.split("/")[1] for own in out.values() for p in own})
        paths = {
            load: path for load in loads
            if versions.exists(spark, f"{(path := path_of(root, table, load, kind, column))}/_SUCCESS")
        }
        found = posted(spark, paths, kind, wanted, ci_ai) if paths else None
        if found is None:
            continue
        rows = found.limit(MOST_FILES + 1).collect()
        if len(rows) > MOST_FILES:
            continue
        files: dict[str, set[str]] = {}
        for load, source, file in rows:
            files.setdefault(f"{table}/{load}/source={source}", set()).add(f"{table}/{load}/source={source}/{file}")
        for month, own in out.items():
            kept: list[str] = []
            for path in own:
                part = "/".join(path.split("/")[:3])
                if part.split("/")[1] not in paths:
                    kept.append(path)
                elif path == part:
                    kept.extend(sorted(files.get(part, ())))
                elif path in files.get(part, ()):
                    kept.append(path)
            out[month] = kept
    return out
