"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams.

Features of a text are its distinct words, pairs of neighbours, pairs with one word between
them and the beginnings of longer words, as inflected forms of one word share theirs, all as
64-bit hashes.  L1 leaves few weights, which go to every task as two
sorted arrays; the whole of every text is then scored in one pass without a shuffle.

Learning reads a sample of labelled documents of bounded size (SAMPLE_TOXIC and
SAMPLE_CLEAN rows, the first of each class in hash order, one of each doc_id, as long as
their texts are at most SAMPLE_BYTES), so the one task that learns has the same work at any
scale.    The sample's share of toxic rows differs from that of
all labels; the intercept is corrected for it.

Defined cases: words are runs of letters and digits, A-Z lower-cased; a null or empty
text has no features and scores the base rate; labels that are null do not count, and
of several labels of a doc_id the highest does; without any usable label every score
is 0; rows are scored one by one, so repeated rows and null ids stay as they are; equal
texts have equal scores; a long text is scored whole, in memory in proportion to it; empty
tables give empty results.  Extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollbook.llm import text as tx
from rollbook.llm.components import save
from rollbook.llm.ftrl import Ftrl
from rollbook.llm.sample import bounded
from rollbook.session import workspace

SAMPLE_TOXIC = 4000
SAMPLE_CLEAN = 8000
SAMPLE_BYTES = 32 << 20  # of the texts of either class
LEAST_DOCS = 4  # sample documents a feature must be in
STEMS = (5, 7, 9)  # bytes: longer words count by their beginnings too
EPOCHS = 6
ALPHA, BETA, L1, L2 = 2.0, 1.0, 5.0, 0.5
THRESHOLD = 0.7


def features(texts: tx.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word, pair, skip pair and stem; repeats included."""
    spans = tx.runs(texts, tx.WORD_BYTE[texts.data])
    word, row = tx.hashes(texts.data, spans, tx.LOWER), spans.row
    found, rows = [word], [row]
    for gap in (1, 2):
        a, b = tx.constants(200 + gap, 2)
        same = row[:-gap] == row[gap:]
        found.append(tx.mix(word[:-gap] * a + word[gap:] * b)[same])
        rows.append(row[:-gap][same])
    for size in STEMS:
        longer = spans.end - spans.begin > size
        cut = tx.Spans(spans.begin[longer], spans.begin[longer] + size, row[longer])
        found.append(tx.mix(tx.hashes(texts.data, cut, tx.LOWER) ^ np.uint64(size)))
        rows.append(cut.row)
    return np.concatenate(found), np.concatenate(rows)


def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, weight) of all features that kept one; the intercept has no key."""
    keys, sizes, toxic = [], [], []
    for batch in batches:
        for rows, texts in tx.pieces(batch):
            found, row = tx.distinct(*features(texts))
            keys.append(found)
            sizes.append(np.bincount(row, minlength=len(texts)))
            toxic.append(rows.column("toxic").to_numpy(zero_copy_only=False))
    if not keys:
        return
    key, size, toxic = np.concatenate(keys), np.concatenate(sizes), np.concatenate(toxic)
    # Rare features go first, by counts in 2**22 cells; the rest get consecutive numbers.
    cell = (key >> np.uint64(42)).astype(np.int64)
    common = np.bincount(cell, minlength=1 << 22)[cell] >= LEAST_DOCS
    doc = np.repeat(np.arange(len(size)), size)[common]
    kept, number = np.unique(key[common], return_inverse=True)
    bound = np.searchsorted(doc, np.arange(len(size) + 1))
    model = Ftrl(len(kept), 1, ALPHA, BETA, L1, L2)
    for _ in range(EPOCHS):
        for i in range(len(size)):
            rows = np.append(number[bound[i] : bound[i + 1]], len(kept))
            model.learn(rows, np.ones(len(rows), np.float32), np.array([float(toxic[i])]))
    weight = model.weights()[:, 0].astype(np.float64)
    full = np.flatnonzero(weight[:-1])
    yield pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([tx.signed(kept[full]), pa.nulls(1, pa.int64())]),
            pa.array(np.append(weight[full], weight[-1])),
        ],
        names=["key", "weight"],
    )


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, usable: Column) -> list:
    """The rows (key, weight) of the model, from labels where ``usable`` holds."""
    folder = workspace(spark, "toxicity")
    judged = save(
        labels.filter(usable & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.max("toxic") > 0).cast("int").alias("toxic")),
        f"{folder}/judged",
    )
    counts = {r["toxic"]: r["count"] for r in judged.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return []

    def first(toxic: int, most: int) -> DataFrame:
        own = judged.filter(F.col("toxic") == toxic)
        return own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    sample = save(first(1, SAMPLE_TOXIC).union(first(0, SAMPLE_CLEAN)), f"{folder}/sample")
    # Bounded by the two limits above, so it may go to every task.  Of a doc_id that stands at
    # many rows one is taken; Spark drops the others before the shuffle.
    one = Window.partitionBy("key").orderBy(F.xxhash64("text"), "text")
    texts = docs.select(F.col("doc_id").cast("long").alias("key"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(sample.withColumnRenamed("doc_id", "key")), "key"
    ).withColumn("row", F.row_number().over(one)).filter("row = 1").select("key", "toxic", "text")
    texts = bounded(texts, "toxic", max(SAMPLE_TOXIC, SAMPLE_CLEAN), SAMPLE_BYTES, folder)
    model = (
        texts.repartition(1).sortWithinPartitions(F.xxhash64("key"), "key", "text")
        .select("text", "toxic")
        .mapInArrow(learn, "key long, weight double")
    )
    weights = [(r["key"], r["weight"]) for r in model.collect()]
    drawn = min(counts[1], SAMPLE_TOXIC) / min(counts[0], SAMPLE_CLEAN)
    shift = log(counts[1] / counts[0]) - log(drawn)
    return [(k, w + shift if k is None else w) for k, w in weights]


def score(docs: DataFrame, weights: list, *keep: str) -> DataFrame:
    """The columns of ``keep`` and ``score``, the chance that the text is toxic."""
    base = sum(w for k, w in weights if k is None)
    known = sorted((k, w) for k, w in weights if k is not None)
    key = np.array([k for k, _ in known], np.int64).view(np.uint64)
    order = np.argsort(key)
    key, weight = key[order], np.array([w for _, w in known])[order]
    likely = np.zeros(1 << 16, bool)
    likely[(key >> np.uint64(48)).astype(np.int64)] = True
    packed = docs.select(*keep, F.col("text").cast("string").alias("text"))
    kinds = dict(packed.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in tx.pieces(batch):
                found, row = features(texts)
                maybe = likely[(found >> np.uint64(48)).astype(np.int64)]
                found, row = tx.distinct(found[maybe], row[maybe])
                total = np.full(len(texts), base)
                if len(key):
                    place = np.minimum(np.searchsorted(key, found), len(key) - 1)
                    hit = key[place] == found
                    total += np.bincount(row[hit], weight[place[hit]], minlength=len(texts))
                p = 1 / (1 + np.exp(-np.clip(total, -60, 60))) if weights else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(c) for c in keep], pa.array(p)], names=[*keep, "score"]
                )

    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], "score double"])
    return packed.mapInArrow(run, schema)
