"""Benchmark decontamination by greedy string tiling.

A document is compared with a benchmark item if the runs of TILE words that they share
cover enough of the item.  The two word sequences are then tiled: Karp-Rabin fingerprints of TILE words
give all common runs, the longest run that is still unmarked is marked in both, and
so on until none of TILE words is left.  Tiles may lie in any order, so passages whose
sentences were moved around count as well.  A document goes if tiles cover at least
COVERAGE percent of an item.

Runs find their items in one of two ways with the same result.  A benchmark of up to
``broadcast_words`` words goes to every task, and the texts are read once and never
shuffled.  A larger one is joined: distinct runs of documents with runs of items.  Both
only leave out items that no tiling could cover.

Defined cases: words are runs of letters, digits and combining marks of any script, folded
to one case and composed form; all other characters, typographic quotes, dashes and
no-break spaces too, stand between words; a null or empty text matches nothing; characters of scripts without spaces (Han, Kana, Thai, Lao, Khmer, Myanmar and others)
are words by themselves; an item of fewer than TILE words is one tile, so it is matched
wherever all of it stands, be it a single word; an item without a word matches nothing;
repeated items, or several rows with one item_id, count once per id, by the best of
them, and rows with a null item_id count together under the null id; rows of ``docs`` are judged one by one, so repeated
rows and null ids stay as they are; empty tables give empty results, or no matches.
Extra columns are carried and never read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cache
from unicodedata import category, normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.llm import text as tx
from rollbook.llm.components import save
from rollbook.session import workspace

TILE = 3  # words
COVERAGE = 80  # percent of an item's words
HITS = 1 << 19  # equal places of a text and an item that are looked at together
MOST_RUNS = 200_000  # common runs of a text and an item, beyond which they are thinned
BROADCAST_WORDS = 1_000_000  # 8 MB of fingerprints

ITEMS = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("coverage", T.DoubleType())
]))
_ITEMS = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64())]))


#: First and last code points of scripts that are written without spaces.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x2E80, 0x2FDF),
    (0x3005, 0x3007), (0x3021, 0x3029), (0x3031, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF),
    (0x4E00, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F),
    (0x20000, 0x3FFFF),
)


@cache
def in_words() -> np.ndarray:
    """For every code point: 1 if it is part of a word, 2 if it is one by itself, else 0."""
    kind = np.array([c.isalnum() or category(c)[0] == "M" for c in map(chr, range(0x110000))], np.int8)
    for first, last in UNSPACED:
        kind[first : last + 1] *= 2
    return kind


def folded(text: bytes) -> str:
    """Upper case first: its fold is the same for all ways to write a letter, also a
    dotless i or a sharp s."""
    if text.isascii():
        return text.decode("ascii")
    return normalize("NFC", text.decode("utf-8", "replace").upper().casefold())


def plain(texts: tx.Texts) -> tx.Texts:
    """The texts with letters beyond ASCII folded and a blank for what is beyond ASCII and
    in no word, so that all bytes from 128 on are word bytes."""
    if not (texts.data >= 128).any():
        return texts
    raw = texts.data.tobytes()
    parts = [folded(raw[a:b]) for a, b in zip(texts.offsets[:-1], texts.offsets[1:])]
    codes = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")
    bound = np.cumsum([0, *map(len, parts)])
    kind = in_words()[codes]
    codes = np.where(kind > 0, codes, 32).astype("<u4")
    if (kind == 2).any():  # blanks around each
        many = np.where(kind == 2, 3, 1)
        place = np.concatenate([[0], np.cumsum(many)])
        wide = np.full(place[-1], 32, "<u4")
        wide[place[:-1] + (kind == 2)] = codes
        codes, bound = wide, place[bound]
    width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
    data = np.frombuffer(codes.tobytes().decode("utf-32-le").encode(), np.uint8)
    return tx.Texts(data, np.concatenate([[0], np.cumsum(width)])[bound])


def word_hashes(texts: tx.Texts) -> tuple[np.ndarray, np.ndarray]:
    texts = plain(texts)
    spans = tx.runs(texts, tx.WORD_BYTE[texts.data])
    return tx.hashes(texts.data, spans, tx.LOWER), spans.row


def fingerprints(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of every run of k words of one text."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    coefficient = tx.constants(100 + k, k)
    total = words[:n] * coefficient[0]
    for j in range(1, k):
        total += words[j : n + j] * coefficient[j]
    return tx.mix(total)


def tile_of(n: int) -> int:
    """Words of the shortest tile of an item of n words."""
    return min(TILE, n)


def common_runs(text: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Rows (length, place in text, place in item) of the maximal common runs of TILE words, or
    of the whole of a shorter item.

    The text is taken in blocks of about HITS equal places, and runs that go on in the next
    block are joined, so memory follows the text and the runs, not their product; of very many
    runs ``thinned`` keeps what a tiling can use.
    """
    tile = tile_of(len(item))
    text_prints, item_prints = fingerprints(text, tile), fingerprints(item, tile)
    none = np.zeros((0, 3), np.int64)
    if not len(text_prints) or not len(item_prints):
        return none
    order = np.argsort(item_prints, kind="stable")
    ranked = item_prints[order]
    low = np.searchsorted(ranked, text_prints, "left")
    many = np.searchsorted(ranked, text_prints, "right") - low
    total = np.cumsum(many)
    done, n_done, open_runs = [], 0, none  # open: hits so far instead of lengths
    begin = 0
    while begin < len(many):
        past = total[begin] - many[begin]
        end = max(begin + 1, int(np.searchsorted(total, past + HITS, "right")))
        runs = diagonal_runs(begin, low[begin:end], many[begin:end], order)
        # On one diagonal a run that ends where this block begins goes on in it.
        before = np.argsort(open_runs[:, 1] - open_runs[:, 2])
        known = (open_runs[:, 1] - open_runs[:, 2])[before]
        first = np.flatnonzero(runs[:, 1] == begin)
        diagonal = runs[first, 1] - runs[first, 2]
        place = np.minimum(np.searchsorted(known, diagonal), max(len(known) - 1, 0))
        goes_on = known[place] == diagonal if len(known) else np.zeros(len(first), bool)
        older = before[place[goes_on]]
        runs[first[goes_on], 0] += open_runs[older, 0]
        runs[first[goes_on], 1:] = open_runs[older, 1:]
        over = np.ones(len(open_runs), bool)
        over[older] = False
        at_end = runs[:, 1] + runs[:, 0] == end
        done += [open_runs[over], runs[~at_end]]
        n_done += int(over.sum()) + int((~at_end).sum())
        open_runs = runs[at_end]
        if n_done > MOST_RUNS:
            done = [thinned(np.concatenate(done), len(item), tile)]
            n_done = len(done[0]) // 2  # it grows by as much again before the next time
        begin = end
    found = np.concatenate([*done, open_runs])
    if len(found) > MOST_RUNS:
        found = thinned(found, len(item), tile)
    return found + np.array([tile - 1, 0, 0])


def diagonal_runs(begin: int, low: np.ndarray, many: np.ndarray, order: np.ndarray) -> np.ndarray:
    """(hits, place in text, place in item) of the runs of equal places in a block of the text:
    neighbours on one diagonal."""
    at = np.repeat(np.arange(len(many)), many)
    step = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
    to = order[np.repeat(low, many) + step]
    at += begin
    rank = np.argsort((at - to).astype(np.int32 if begin + len(many) < 1 << 30 else np.int64), kind="stable")
    at, to = at[rank], to[rank]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (to[1:] != to[:-1] + 1)
    first = np.flatnonzero(new)
    return np.column_stack([np.diff(np.append(first, len(at))), at[first], to[first]])


def thinned(runs: np.ndarray, words: int, tile: int) -> np.ndarray:
    """Of the runs of one length at one place of an item of so many words, as many disjoint ones
    as the item has words, and one: the tiles of an item mark that many words of a text at most, so
    one of them stays unmarked.  Runs that have fewer disjoint ones all stay."""
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0], runs[:, 2]))]
    length = runs[:, 0] + tile - 1
    fresh = np.ones(len(runs), bool)
    fresh[1:] = (runs[1:, 0] != runs[:-1, 0]) | (runs[1:, 2] != runs[:-1, 2])
    group = np.cumsum(fresh) - 1
    # The first that begins in the first half of each stretch of twice the length.
    half, inside = runs[:, 1] // (2 * length), runs[:, 1] % (2 * length) < length
    at = np.flatnonzero(inside)
    lead = np.ones(len(at), bool)
    lead[1:] = (group[at[1:]] != group[at[:-1]]) | (half[at[1:]] != half[at[:-1]])
    chosen = at[lead]
    many = np.bincount(group[chosen], minlength=group[-1] + 1)
    rank = np.arange(len(chosen)) - np.repeat(np.cumsum(many) - many, many)
    keep = many[group] <= words
    keep[chosen[rank <= words]] = True
    return runs[keep]


def tiled(text: np.ndarray, item: np.ndarray, least: float = 0.0) -> int:
    """Words of ``item`` that greedy tiles cover, or 0 if they cannot reach ``least``."""
    found = common_runs(text, item)
    reach = np.zeros(len(item) + 1, np.int64)
    np.add.at(reach, found[:, 2], 1)
    np.add.at(reach, found[:, 2] + found[:, 0], -1)
    if (np.cumsum(reach)[:-1] > 0).sum() < least:
        return 0
    in_text, in_item = np.zeros(len(text), bool), np.zeros(len(item), bool)
    heap = [(-length, j, i) for length, i, j in found.tolist()]
    heapq.heapify(heap)
    while heap:
        length, j, i = heapq.heappop(heap)
        length = -length
        taken = in_text[i : i + length] | in_item[j : j + length]
        if not taken.any():
            in_text[i : i + length] = True
            in_item[j : j + length] = True
            continue
        # What is left of the run between marked words waits for its turn.
        edges = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]]).astype(np.int8)))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a >= tile_of(len(item)):
                heapq.heappush(heap, (-(b - a), j + a, i + a))
    return int(in_item.sum())


def best_of(found: list[tuple[int | None, float]]) -> list[dict]:
    best: dict[int | None, float] = {}
    for item_id, coverage in found:
        best[item_id] = max(best.get(item_id, 0.0), coverage)
    return [{"item_id": k, "coverage": best[k]} for k in sorted(best, key=lambda k: (k is not None, k or 0))]


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, words, n, item): the word hashes of every item that has words, and their key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in tx.pieces(batch):
                words, row = word_hashes(texts)
                bound = np.searchsorted(row, np.arange(len(texts) + 1))
                parts = [words[a:b].tobytes() for a, b in zip(bound[:-1], bound[1:])]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("item_id"), pa.array(parts, pa.binary()), pa.array(np.diff(bound))],
                    names=["item_id", "words", "n"],
                )

    return (
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(run, "item_id long, words binary, n long")
        .filter("n > 0")
        .withColumn("item", F.sha2("words", 256))
    )


class Index:
    """Tile-long runs of a whole benchmark, sorted, with the places they stand at."""

    def __init__(self, rows: list, coverage: int) -> None:
        self.ids = [r["item_id"] for r in rows]
        self.words = [np.frombuffer(bytes(r["words"]), np.uint64) for r in rows]
        size = np.array([len(w) for w in self.words], np.int64)
        first = np.cumsum(size) - size
        self.least = coverage * size / 100
        self.owner = np.repeat(np.arange(len(size)), size)
        self.runs = []
        for k in range(1, TILE + 1):
            own = [i for i, w in enumerate(self.words) if tile_of(len(w)) == k]
            prints = np.concatenate([np.zeros(0, np.uint64), *[fingerprints(self.words[i], k) for i in own]])
            at = np.concatenate([np.zeros(0, np.int64), *[first[i] + np.arange(size[i] - k + 1) for i in own]])
            order = np.argsort(prints, kind="stable")
            if len(order):
                self.runs.append((k, prints[order], at[order]))

    def candidates(self, text: np.ndarray) -> np.ndarray:
        """Items of which runs shared with the text cover enough words, before tiling."""
        covered = [np.zeros(0, np.int64)]
        for k, known, at in self.runs:
            prints = fingerprints(text, k)
            low = np.searchsorted(known, prints)
            found = np.unique(prints[known[np.minimum(low, len(known) - 1)] == prints])
            low = np.searchsorted(known, found)
            many = np.searchsorted(known, found, "right") - low
            step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            covered.append((at[np.repeat(low, many) + step][:, None] + np.arange(k)).ravel())
        owner, n = np.unique(self.owner[np.unique(np.concatenate(covered))], return_counts=True)
        return owner[n >= self.least[owner]]


def packed(docs: DataFrame, names: list[str]) -> DataFrame:
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.col("text").cast("string").alias("text"),
    )


def by_broadcast(docs: DataFrame, items: DataFrame, names: list[str], coverage: int) -> DataFrame:
    rows = packed(docs, names)
    shared = docs.sparkSession.sparkContext.broadcast(items.select("item_id", "words").collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(shared.value, coverage)
        for batch in batches:
            for part, texts in tx.pieces(batch):
                words, row = word_hashes(texts)
                bound = np.searchsorted(row, np.arange(len(texts) + 1))
                out = []
                for a, b in zip(bound[:-1], bound[1:]):
                    found = []
                    for k in index.candidates(words[a:b]):
                        item = index.words[k]
                        least = coverage * len(item) / 100
                        marked = tiled(words[a:b], item, least)
                        if marked >= least:
                            found.append((index.ids[k], marked / len(item)))
                    out.append(best_of(found))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(out, _ITEMS)], names=["row", "items"]
                )

    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("items", ITEMS)]))


def runs_of(texts: DataFrame, lengths: list[int]) -> DataFrame:
    """(key, run): the distinct runs of these lengths of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in tx.pieces(batch):
                words, row = word_hashes(found)
                bound = np.searchsorted(row, np.arange(len(found) + 1))
                prints = [
                    np.unique(np.concatenate([np.zeros(0, np.uint64), *[fingerprints(words[a:b], k) for k in lengths]]))
                    for a, b in zip(bound[:-1], bound[1:])
                ]
                owner = np.repeat(np.arange(len(found)), [len(p) for p in prints])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key").take(pa.array(owner)),
                        tx.signed(np.concatenate([np.zeros(0, np.uint64), *prints])),
                    ],
                    names=["key", "run"],
                )

    return texts.select("key", "text").mapInArrow(run, "key string, run long")


def runs_of_items(items: DataFrame) -> DataFrame:
    """(item, n, run, places): the distinct tile-long runs of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, words in zip(batch.column("item").to_pylist(), batch.column("words").to_pylist()):
                own = np.frombuffer(words, np.uint64)
                prints, places = np.unique(fingerprints(own, tile_of(len(own))), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(prints), pa.string()), pa.array([len(own)] * len(prints), pa.int64()),
                     tx.signed(prints), pa.array(places, pa.int64())],
                    names=["item", "n", "run", "places"],
                )

    return items.select("item", "words").mapInArrow(run, "item string, n long, run long, places long")


def by_join(spark: SparkSession, docs: DataFrame, items: DataFrame, names: list[str], coverage: int) -> DataFrame:
    """The same for a benchmark of any size: nothing is sent to all tasks.

    Equal texts are compared once, under their hash.  To cover enough of an item, a text
    must hold its runs at T places or more; so it holds one of those that are left when
    the most common ones, at T - 1 places together, are not looked up.  A run or an item
    that many texts hold makes a hot key of a plain join of two tables, which AQE splits.
    """
    folder = workspace(spark, "decontaminate")
    keyed = packed(docs, names).withColumn("key", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    texts = keyed.select("key", "text")
    items = save(items, f"{folder}/items")
    words = items.groupBy("item").agg(F.first("words").alias("words"))
    known = save(runs_of_items(words), f"{folder}/item-runs")
    lengths = [r[0] for r in items.select(F.least("n", F.lit(TILE)).cast("int")).distinct().collect()]
    met = save(
        runs_of(texts, lengths).join(known.select("run").distinct(), "run").distinct(), f"{folder}/text-runs"
    )
    places = F.ceil(F.col("n") * coverage / (100 * F.least("n", F.lit(TILE))))  # T
    common_first = Window.partitionBy("item").orderBy(F.col("texts").desc(), "run").rowsBetween(
        Window.unboundedPreceding, 0
    )
    looked_up = (
        known.join(met.groupBy("run").agg(F.count("*").alias("texts")), "run")
        .withColumn("upto", F.sum("places").over(common_first))
        .filter(F.col("upto") >= places).select("item", "run")
    )
    pairs = save(met.join(looked_up, "run").select("key", "item").distinct(), f"{folder}/pairs")
    one = texts.join(pairs.select("key").distinct(), "key", "left_semi").groupBy("key").agg(
        F.first("text").alias("text")
    )
    both = pairs.join(words, "item").join(one, "key").repartition("key", "item")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in tx.pieces(batch):
                words, row = word_hashes(found)
                bound = np.searchsorted(row, np.arange(len(found) + 1))
                items = [np.frombuffer(w, np.uint64) for w in part.column("words").to_pylist()]
                share = []
                for item, a, b in zip(items, bound[:-1], bound[1:]):
                    least = coverage * len(item) / 100
                    marked = tiled(words[a:b], item, least)
                    share.append(marked / len(item) if marked >= least else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("item"), pa.array(share, pa.float64())],
                    names=["key", "item", "coverage"],
                )

    matched = (
        both.mapInArrow(run, "key string, item string, coverage double")
        .filter("coverage IS NOT NULL")
        .join(items.select("item", "item_id").distinct(), "item")
        .groupBy("key", "item_id").agg(F.max("coverage").alias("coverage"))
        .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("item_id", "coverage"))).alias("items"))
    )
    out = keyed.select("row", "key").join(save(matched, f"{folder}/matched"), "key", "left")
    return out.select("row", F.coalesce("items", F.array().cast(ITEMS)).alias("items"))


def matches(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *keep: str,
            coverage: int = COVERAGE, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """``row`` (a struct of the columns of ``keep``, all by default) and ``items``, the
    benchmark items that the document holds, with the share of their words covered."""
    names = list(keep) or docs.columns
    items = items_of(benchmark)
    size = items.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if size <= broadcast_words:
        return by_broadcast(docs, items, names, coverage)
    return by_join(spark, docs, items, names, coverage)


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """The documents that hold no item, with their own columns only."""
    return matches(spark, docs, benchmark, **options).filter(F.size("items") == 0).select("row.*")
