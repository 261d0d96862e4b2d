r"""How far the sources of a language differ in their words: pointer sort and smoothed shares.

Terms are the matches of ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+`` with only A-Z lower-cased.  A
task copies texts into slices of about SLICE_BYTES, builds a pointer to every word start and
sorts the pointers by multikey quicksort, eight bytes of the words at a time; runs of equal
words give the documents and occurrences of each (language, source).  These partial counts
are all that is shuffled, so a frequent word or a hot source is one row per slice.

A language keeps the terms of at least MIN_DOCS of its documents.  With V of them, a group
(or the whole language) with ``count`` occurrences of a term and N of all kept terms gives it
``1 + floor(10**9 * (count + 5) / (N + 5 * V))``, in decimals, exact for any count.  Sources
are compared in tiles of at most about TILE_SOURCES times TILE_SOURCES sources and TILE_TERMS
terms; what no source of a tile holds adds the difference of the groups' zero values.

Defined cases: a null text, language or source is ''.  An empty text has no terms, but its
group is there, with value 0 against the others if its language keeps no term.  Rows count
as documents, repeated ones and those with a null or repeated id too.  Equal values are
ordered by the item's UTF-8 bytes.  A text is handled whole, so a task's memory follows the
longest one.  Empty tables give empty results; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollbook.llm import text as tx
from rollbook.llm.components import save
from rollbook.session import workspace

MIN_DOCS = 30
TOP_TERMS = 50
SLICE_BYTES = 16 << 20  # of text whose pointers are sorted together
TILE_SOURCES = 128
TILE_TERMS = 512

SCALE, PRIOR = 1_000_000_000, 5

#: ASCII letters, and every byte of a longer character.
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def sort_words(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, run): word pointers by the words' bytes, and for each the number of its run of
    equal words.  Within a run pointers keep their order.

    Each step deals the words that are still tied by their next eight bytes and goes on with
    the ties that have more; a word's end counts as a zero byte, which no word holds.
    """
    n = len(begin)
    order = np.arange(n)
    if not n:
        return order, order
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, ">u8", padded.data, strides=(1,))
    fresh = np.zeros(n, bool)  # does a new run start at this place?
    fresh[0] = True
    at, depth = np.arange(n), 0  # places whose words are not told apart yet
    while len(at):
        word = order[at]
        left = end[word] - begin[word] - depth
        key = eight[begin[word] + depth].astype(np.uint64)
        short = left < 8
        key[short] &= ~np.uint64(0) << (np.uint64(8) * (np.uint64(8) - left[short].astype(np.uint64)))
        run = np.cumsum(fresh)[at]
        more = left > 8  # a word that ends here comes before one that goes on
        rank = np.lexsort((more, key, run) if depth else (more, key))
        order[at] = word[rank]
        key, run, more = key[rank], run[rank], more[rank]
        new = np.ones(len(at), bool)
        new[1:] = (key[1:] != key[:-1]) | (run[1:] != run[:-1]) | (more[1:] != more[:-1])
        fresh[at] |= new
        tied = ~new
        tied[:-1] |= ~new[1:]
        at, depth = at[tied & more], depth + 8
    return order, np.cumsum(fresh) - 1


def slice_counts(texts: tx.Texts, group: np.ndarray, n_groups: int) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """(group, term, documents, occurrences) of one slice; ``group`` tells each row's."""
    data = tx.LOWER[texts.data]
    spans = tx.runs(texts, LETTER[data])
    order, run = sort_words(data, spans.begin, spans.end)
    row = spans.row[order]
    cell = run * n_groups + group[row]
    cells, times = np.unique(cell, return_counts=True)
    # Equal words lie in the order of the text, so a document's are neighbours.
    first = np.ones(len(run), bool)
    first[1:] = (run[1:] != run[:-1]) | (row[1:] != row[:-1])
    docs = np.unique(cell[first], return_counts=True)[1]
    sample = order[np.searchsorted(run, cells // n_groups)]
    raw = data.tobytes()
    terms = [raw[b:e] for b, e in zip(spans.begin[sample].tolist(), spans.end[sample].tolist())]
    return cells % n_groups, terms, docs, times


PARTIAL = "lang string, source string, term string, docs long, n long"


def partial_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, docs, n) by slice of the input."""

    def emit(names: dict, texts: list[tx.Texts], groups: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        bounds = np.cumsum([0, *[len(t.data) for t in texts]])
        offsets = [t.offsets[:-1] + b for t, b in zip(texts, bounds)]
        whole = tx.Texts(np.concatenate([t.data for t in texts]), np.concatenate([*offsets, bounds[-1:]]))
        group, terms, n_docs, n = slice_counts(whole, np.concatenate(groups), len(names))
        langs, sources = (pa.array(c, pa.string()) for c in zip(*names))
        for lo in range(0, len(terms), 1 << 16):
            part = slice(lo, lo + (1 << 16))
            which = pa.array(group[part])
            yield pa.RecordBatch.from_arrays(
                [langs.take(which), sources.take(which), pa.array(terms[part], pa.binary()).cast(pa.string()),
                 pa.array(n_docs[part].astype(np.int64)), pa.array(n[part].astype(np.int64))],
                names=["lang", "source", "term", "docs", "n"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[tuple[str, str], int] = {}
        texts: list[tx.Texts] = []
        groups: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for rows, piece in tx.pieces(batch):
                keys = zip(rows.column("lang").to_pylist(), rows.column("source").to_pylist())
                groups.append(np.array([names.setdefault(k, len(names)) for k in keys], np.int64))
                texts.append(piece)
                held += len(piece.data)
                if held >= SLICE_BYTES:
                    yield from emit(names, texts, groups)
                    names, texts, groups, held = {}, [], [], 0
        if texts:
            yield from emit(names, texts, groups)

    return docs.select("lang", "source", "text").mapInArrow(run, PARTIAL)


def share(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), without rounding; 1 when
    there are no terms."""
    wide = "decimal(20,0)"
    # decimal(20) times decimal(10) has 31 digits: no overflow, and div is exact.
    return F.expr(
        f"1 + coalesce((CAST({count} + {PRIOR} AS {wide}) * CAST({SCALE} AS decimal(10,0))) div "
        f"nullif(CAST({total} + {PRIOR} * {terms} AS {wide}), 0), 0)"
    )


def tile_sums(table: pa.Table) -> pa.Table:
    """Sums of differences over one tile: (one, other, total, present, zeros) for each pair of
    a source of the first block and one of the second, each pair once.

    Rows without a term tell a source's zero value and the block it is in.
    """
    head = table.filter(pc.is_null(table["term"]))
    body = table.filter(pc.is_valid(table["term"]))
    names = np.array(head["source"].to_pylist(), object)
    side = np.asarray(head["block"])
    zero = np.asarray(head["p"])
    order = np.argsort(names)  # a pair's first is the smaller name, in any task
    names, side, zero = names[order], side[order], zero[order]
    place = {name: i for i, name in enumerate(names)}
    term = body["term"].combine_chunks().dictionary_encode()
    if isinstance(term, pa.ChunkedArray):
        term = term.combine_chunks()
    present = len(term.dictionary) if len(body) else 0
    p = np.repeat(zero[:, None], present, axis=1)
    if len(body):
        p[[place[s] for s in body["source"].to_pylist()], np.asarray(term.indices)] = np.asarray(body["p"])
    lo, hi = (int(table[c][0].as_py()) for c in ("lo", "hi"))
    one, other, total, zeros = [], [], [], []
    for i in range(len(names)):
        later = np.arange(i + 1, len(names))
        # Within one block all pairs; of two blocks only those with a source of each.
        later = later[side[later] != side[i]] if lo != hi else later
        if not len(later):
            continue
        one.extend([names[i]] * len(later))
        other.extend(names[later])
        total.append(np.abs(p[later] - p[i]).sum(axis=1))
        zeros.append(np.abs(zero[later] - zero[i]))
    n = len(one)
    flat = lambda parts: np.concatenate(parts) if n else np.zeros(0, np.int64)
    return pa.table({
        "lang": pa.array([table["lang"][0].as_py()] * n, pa.string()),
        "one": pa.array(one, pa.string()), "other": pa.array(other, pa.string()),
        "total": pa.array(flat(total), pa.int64()), "present": pa.array([present] * n, pa.int64()),
        "zeros": pa.array(flat(zeros), pa.int64()),
    })


def audit(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS,
          tile_sources: int = TILE_SOURCES, tile_terms: int = TILE_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` rows say how far a group's shares are
    from those of each other source, ``term`` rows which terms it has more of than its
    language."""
    folder = workspace(spark, "divergence")
    plain = docs.select(*[
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")
    ])
    groups = save(plain.select("lang", "source").distinct(), f"{folder}/groups")
    counted = save(
        partial_counts(plain).groupBy("lang", "source", "term").agg(
            F.sum("docs").alias("docs"), F.sum("n").alias("n")
        ),
        f"{folder}/counts",
    )
    kept = save(
        counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        .filter(F.col("docs") >= min_docs).select("lang", "term", "lang_n"),
        f"{folder}/kept",
    )
    cells = counted.select("lang", "source", "term", "n").join(kept, ["lang", "term"])
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    sizes = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    langs = sizes.join(langs, "lang", "left").na.fill(0, ["terms", "lang_total"])
    stats = (
        groups.join(totals, ["lang", "source"], "left").na.fill(0, ["total"]).join(langs, "lang")
        .withColumn("blocks", F.ceil(F.col("sources") / tile_sources))
        .withColumn("slices", F.greatest(F.ceil(F.col("terms") / tile_terms), F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")))
    )
    stats = save(stats, f"{folder}/stats")
    shares = save(
        cells.join(stats, ["lang", "source"]).select(
            "lang", "source", "term", "block", "blocks",
            F.pmod(F.xxhash64("term"), F.col("slices")).alias("slice"),
            share("n", "total", "terms").alias("p"), share("lang_n", "lang_total", "terms").alias("q"),
        ),
        f"{folder}/shares",
    )
    return pairs(stats, shares).unionByName(terms(shares, top_terms))


def pairs(stats: DataFrame, shares: DataFrame) -> DataFrame:
    heads = stats.select(
        "lang", "source", F.lit(None).cast("string").alias("term"), "block", "blocks",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("slice"),
        share("0", "total", "terms").alias("p"),
    )
    rows = shares.select(*heads.columns).unionByName(heads)
    # A block meets each block, itself included, in one tile.
    met = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    rows = rows.withColumn("met", met).select(
        "lang", "slice", F.least("block", "met").alias("lo"), F.greatest("block", "met").alias("hi"),
        "block", "source", "term", "p",
    )
    sums = rows.groupBy("lang", "slice", "lo", "hi").applyInArrow(
        tile_sums, "lang string, one string, other string, total long, present long, zeros long"
    )
    sums = sums.groupBy("lang", "one", "other").agg(
        F.sum("total").alias("total"), F.sum("present").alias("present"), F.max("zeros").alias("zeros")
    )
    sizes = stats.select("lang", "terms").distinct()
    apart = sums.join(sizes, "lang").withColumn("value", F.expr("total + (terms - present) * zeros"))
    both = apart.select(
        "lang", F.explode(F.array(
            F.struct(F.col("one").alias("source"), F.col("other").alias("item")),
            F.struct(F.col("other").alias("source"), F.col("one").alias("item")),
        )).alias("x"), "value",
    ).select("lang", "x.source", "x.item", "value")
    return ranked(both, "pair")


def terms(shares: DataFrame, top: int) -> DataFrame:
    above = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("p - q").alias("value"))
    return ranked(above, "term", top)


def ranked(rows: DataFrame, part: str, top: int | None = None) -> DataFrame:
    """Spark cuts to the first ``top`` of each group before the shuffle too."""
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = rows.withColumn("rank", F.row_number().over(best))
    if top is not None:
        out = out.filter(F.col("rank") <= top)
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
