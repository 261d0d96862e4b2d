r"""Line deduplication: repeated runs of lines, by a distributed suffix array.

The corpus is the sequence of its documents' lines, in order of document and line, and
no run crosses documents.  Prefix doubling sorts the suffixes: round k ranks every
position by its next 2**k lines, from the ranks of its two halves.  Positions of equal
rank are an interval of the suffix array with a common prefix of at least 2**k lines;
positions whose rank is theirs alone cannot be part of a repeat and leave, so later
rounds see repeated runs only.

A line goes if it lies in a run of lines with LEAST_WORDS words or more that also
starts at an earlier position.  It is enough to look at the least such run that starts
at each line and the least that ends at each line: their union is the union of all.
The run [s, e) has the name (rank of s, rank of e - 2**k) in the largest round k with
2**k <= e - s, and of the positions of one name all but the first go.

DataFrame functions only.  Each round is one shuffle by rank of the positions that are
left, written to the shared folder; a rank that a third of all positions share is a hot
key of a join of two tables, which AQE splits.

Defined cases: lines are the parts between ``\n``; words are ``[^\x20\x09-\x0D]+``; lines
are equal if their bytes are; a null or empty text has no word and loses nothing; a
document is a doc_id with its text, so repeated rows are one document and share its
result, and the order is by doc_id, null first, then by a hash of the text; an empty
table gives an empty result.  Extra columns are kept by ``dedup`` and never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollbook.llm.components import save
from rollbook.session import workspace

LEAST_WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"


DOCUMENT = ["doc", "hash"]
NO_ID = -(1 << 63)  # stands for a null doc_id, and sorts first


def document_key() -> list[Column]:
    """What tells documents apart, and orders them."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return [doc.alias("doc"), F.xxhash64("text").alias("hash")]


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc, hash, line, a, b, words): every line of every document, once.

    a and b together name the line's text; the text itself is not shuffled.
    """
    every = docs.select(
        *document_key(), F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("line", "x")
    )
    named = every.select(
        *DOCUMENT, "line", F.xxhash64("x").alias("a"), F.crc32(F.col("x").cast("binary")).alias("b"),
        F.regexp_count("x", F.lit(WORD)).cast("long").alias("words"),
    )
    # Repeated rows are one document.
    return named.groupBy(*DOCUMENT, "line").agg(
        F.min("a").alias("a"), F.min("b").alias("b"), F.min("words").alias("words")
    )


def ranked(pairs: DataFrame, left: str, right: str, folder: str) -> DataFrame:
    """Positions with a new rank: the order of (left, right) among those that occur more
    than once.  Sorted by range, so ranks grow with the pair across partitions."""
    names = (
        pairs.groupBy(left, right).agg(F.count("*").alias("n")).filter("n > 1")
        .orderBy(left, right).select(left, right, F.monotonically_increasing_id().alias("place"))
    )
    names = save(names, f"{folder}-names")
    known = pairs.join(names, [left, right])
    return save(known.select(*DOCUMENT, "line", F.col("place").alias("rank")), f"{folder}-ranks")


def runs_to_test(lines: DataFrame, least_words: int) -> DataFrame:
    """(doc, hash, start, end): the least runs of enough words from and up to each line.

    Windows go over the lines of one document, by the words before each line.
    """
    own = Window.partitionBy(*DOCUMENT)
    ended = lines.select(
        *DOCUMENT, "line", "words", F.coalesce(
            F.sum("words").over(own.orderBy("line").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("before"),
        F.max("line").over(own).alias("last"),
    )
    # The end of the document is a place too: one more row behind its last line.
    places = ended.select(
        *DOCUMENT,
        F.explode(
            F.when(F.col("line") == F.col("last"), F.array(
                F.struct("line", "before"),
                F.struct((F.col("line") + 1).alias("line"), (F.col("before") + F.col("words")).alias("before")),
            )).otherwise(F.array(F.struct("line", "before")))
        ).alias("p"),
    ).select(*DOCUMENT, "p.line", "p.before")
    far = Window.unboundedPreceding
    ahead = own.orderBy(F.col("before").desc()).rangeBetween(far, -least_words)
    behind = own.orderBy(F.col("before")).rangeBetween(far, -least_words)
    found = places.select(
        *DOCUMENT, "line",
        F.min("line").over(ahead).alias("end"), F.max("line").over(behind).alias("start"),
    )
    forward = found.filter("end IS NOT NULL").select(*DOCUMENT, F.col("line").alias("start"), "end")
    backward = found.filter("start IS NOT NULL").select(*DOCUMENT, "start", F.col("line").alias("end"))
    return forward.union(backward).distinct()


def removed_lines(spark: SparkSession, docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc, hash, spans): the spans [start, end) of lines to go, in order."""
    folder = workspace(spark, "lines")
    lines = save(lines_of(docs), f"{folder}/lines")
    ranks = ranked(lines, "a", "b", f"{folder}/round-0")
    # Documents that hold a repeated line; no other can hold a repeated run.
    concerned = ranks.select(*DOCUMENT).distinct()
    runs = save(runs_to_test(lines.join(concerned, DOCUMENT), least_words), f"{folder}/runs")
    later = None
    k = 0
    while True:
        size = 1 << k
        own = runs.withColumn("n", F.col("end") - F.col("start")).filter(
            (F.col("n") >= size) & (F.col("n") < 2 * size)
        )
        first = ranks.select(*DOCUMENT, F.col("line").alias("start"), F.col("rank").alias("r1"))
        second = ranks.select(*DOCUMENT, (F.col("line") + size).alias("end"), F.col("rank").alias("r2"))
        named = save(
            own.join(first, [*DOCUMENT, "start"]).join(second, [*DOCUMENT, "end"]),
            f"{folder}/named-{k}",
        )
        firsts = save(
            named.groupBy("n", "r1", "r2").agg(
                F.min(F.struct(*DOCUMENT, "start")).alias("first"), F.count("*").alias("times")
            ).filter("times > 1"),
            f"{folder}/firsts-{k}",
        )
        found = named.join(firsts, ["n", "r1", "r2"]).filter(
            F.struct(*DOCUMENT, "start") != F.col("first")
        ).select(*DOCUMENT, "start", "end")
        found = save(found, f"{folder}/later-{k}")
        later = found if later is None else later.union(found)
        k += 1
        if runs.filter(F.col("end") - F.col("start") >= (1 << k)).isEmpty():
            break
        shifted = ranks.select(*DOCUMENT, (F.col("line") - size).alias("line"), F.col("rank").alias("next"))
        pairs = ranks.join(shifted, [*DOCUMENT, "line"])
        ranks = ranked(save(pairs, f"{folder}/round-{k}-pairs"), "rank", "next", f"{folder}/round-{k}")
    return merged(later)


def merged(spans: DataFrame) -> DataFrame:
    """(doc, hash, spans): overlapping spans of a document made one."""
    by_start = Window.partitionBy(*DOCUMENT).orderBy("start", "end")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    fresh = spans.distinct().withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1))
    island = F.sum("new").over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    return (
        fresh.withColumn("island", island)
        .groupBy(*DOCUMENT, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy(*DOCUMENT)
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    )


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows of ``docs`` with the spans of their document, null if it loses nothing."""
    doc, text_hash = document_key()
    named = spans.select(*[F.col(c).alias(f"__{c}") for c in (*DOCUMENT, "spans")])
    return docs.join(named, (doc == F.col("__doc")) & (text_hash == F.col("__hash")), "left")


def account(spark: SparkSession, docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_lines, n_removed and spans of every document."""
    text = F.col("text").cast("string")
    n_lines = F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n")))
    listed = docs.select("doc_id", *document_key(), n_lines.alias("n_lines"))
    removed = F.aggregate("spans", F.lit(0), lambda total, s: total + (s["end"] - s["start"]))
    return listed.join(removed_lines(spark, docs, least_words), DOCUMENT, "left").select(
        "doc_id", "n_lines", F.coalesce(removed, F.lit(0)).alias("n_removed"), "spans"
    )


def dedup(spark: SparkSession, docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` without later copies of repeated runs; a text that loses all is empty."""
    found = with_spans(docs, removed_lines(spark, docs, least_words))
    kept = F.filter(
        F.split(F.col("text").cast("string"), "\n"),
        lambda line, i: ~F.exists("__spans", lambda s: (i >= s["start"]) & (i < s["end"])),
    )
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return found.withColumn("text", text).select(*[f"`{c}`" for c in docs.columns])
