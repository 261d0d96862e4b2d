"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

Runs of one to three folded characters (letters in lower case, all else one blank) are
hashed into BUCKETS.  Document frequencies count every document that may be learnt
from; the weights come from FTRL with elastic net on a sample of at most
SAMPLE_PER_LANGUAGE different texts of each language, bounded in rows and bytes over all
languages too, so the one task that learns has bounded work; a tenth of the sample is held back to set the temperature of the probabilities.
Weights and frequencies have BUCKETS rows whatever the corpus, and go to every task.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is
every text if there is nothing to learn from; rows are judged one by one, so repeated
rows and null ids stay as they are; empty tables give empty results.  Extra columns are
never read.  Texts are read whole, in parts of bounded length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import text as tx
from rollbook.llm.components import save
from rollbook.llm.ftrl import Ftrl, probability, temperature
from rollbook.llm.sample import bounded
from rollbook.session import workspace

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
MOST = 3  # characters of a gram
PART = 1 << 18  # characters handled at a time
SAMPLE_PER_LANGUAGE = 1500
LEAST_PER_LANGUAGE = 20
SAMPLE_ROWS = 24_000  # of all languages together, where that leaves LEAST_PER_LANGUAGE
SAMPLE_BYTES = 96 << 20  # of the texts of so many rows
HELD_BACK = 10  # one of so many sample documents sets the temperature
SCALE = 10.0
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.3, 0.1
UNKNOWN = "und"


@cache
def folded() -> np.ndarray:
    """For every code point: its lower case if it is a letter, else a blank."""
    points = [chr(i) for i in range(0x110000)]
    return np.array([ord(c.lower()[0]) if c.isalpha() else 32 for c in points], np.uint32)


def grams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bucket, row, letters by row), in parts; a part's rows are ascending."""
    table = folded()
    multiplier = tx.constants(300, MOST)

    def part(pieces: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # A zero between texts: no gram holds one.
        codes = np.frombuffer("\0".join(s for _, s in pieces).encode("utf-32-le", "surrogatepass"), "<u4")
        row = np.repeat([i for i, _ in pieces], [len(s) + 1 for _, s in pieces])[: len(codes)]
        plain = np.where(codes == 0, 0, table[np.minimum(codes, 0x10FFFF)])
        letters = np.bincount(row[plain > 32], minlength=len(texts))
        again = np.zeros(len(plain), bool)
        again[1:] = (plain[1:] == 32) & (plain[:-1] == 32)
        plain, row = plain[~again].astype(np.uint64), row[~again]
        buckets, rows = [], []
        total, whole = np.zeros(len(plain), np.uint64), np.ones(len(plain), bool)
        for n in range(1, MOST + 1):
            total = total[: len(plain) - n + 1] + plain[n - 1 :] * multiplier[n - 1]
            whole = whole[: len(plain) - n + 1] & (plain[n - 1 :] > 0)
            mixed = (total * np.uint64(0xD6E8FEB86659FD93 + 2 * n)) >> np.uint64(64 - BUCKET_BITS)
            buckets.append(mixed[whole].astype(np.int64))
            rows.append(row[: len(whole)][whole])
        bucket, row = np.concatenate(buckets), np.concatenate(rows)
        order = np.argsort(row, kind="stable")
        return bucket[order], row[order], letters

    held, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text or ""), PART):
            piece = text[at : at + PART + (MOST - 1)]
            held.append((i, piece))
            size += len(piece)
            if size >= PART:
                yield part(held)
                held, size = [], 0
    if held:
        yield part(held)


def document_frequency(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each bucket's grams, and documents in all.  A task sends one
    row per bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        held = np.zeros(BUCKETS, bool)  # buckets of the text that may go on in the next part
        for batch in batches:
            for rows, _ in tx.pieces(batch):
                current = -1
                for bucket, row, _ in grams(rows.column("text").to_pylist()):
                    bound = np.searchsorted(row, np.arange(len(rows) + 1))
                    for i in np.flatnonzero(np.diff(bound)):
                        if i != current:
                            total += held
                            held[:] = False
                            current = i
                        held[bucket[bound[i] : bound[i + 1]]] = True
                total += held
                held[:] = False
                n += len(rows)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(full, -1)), pa.array(np.append(total[full], n))], names=["bucket", "n"]
        )

    counted = texts.select("text").mapInArrow(run, "bucket long, n long")
    found = counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    frequency, n = np.zeros(BUCKETS, np.int64), 0
    for r in found:
        if r["bucket"] < 0:
            n = r["n"]
        else:
            frequency[r["bucket"]] = r["n"]
    return frequency, n


def fit(spark: SparkSession, docs: DataFrame, usable: Column) -> dict:
    """The model, from texts and languages where ``usable`` holds."""
    folder = workspace(spark, "language")
    known = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
    )
    counts = save(known.groupBy("lang").agg(F.count("*").alias("n")), f"{folder}/languages")
    languages = sorted(r["lang"] for r in counts.collect())
    if not languages:
        return {"languages": []}
    frequency, n = document_frequency(known)
    idf = (np.log((1 + n) / (1 + frequency)) + 1).astype(np.float32)
    most = max(LEAST_PER_LANGUAGE, min(SAMPLE_PER_LANGUAGE, SAMPLE_ROWS // len(languages)))
    # Drawn by text: copies come together and are folded map-side to one.  A written table of a
    # row per language: Spark broadcasts it if its size allows.
    digest = F.xxhash64("text", F.lit(1))
    chance = F.pmod(digest, F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = known.join(counts, "lang").filter(chance * F.col("n") < F.lit(float(4 * most)))
    texts = drawn.groupBy("lang", F.xxhash64("text").alias("key")).agg(F.min("text").alias("text"))
    sample = bounded(texts, "lang", most, SAMPLE_BYTES * most // SAMPLE_ROWS, folder)
    place = {language: i for i, language in enumerate(languages)}

    def vector(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, times = np.unique(buckets, return_counts=True)
        x = times.astype(np.float32) / np.float32(max(1, len(buckets))) * idf[rows] * np.float32(SCALE)
        return np.append(rows, BUCKETS), np.append(x, np.float32(1))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples, truth = [], []
        for batch in batches:
            for rows, _ in tx.pieces(batch):
                found = [[] for _ in range(len(rows))]
                for bucket, row, _ in grams(rows.column("text").to_pylist()):
                    bound = np.searchsorted(row, np.arange(len(rows) + 1))
                    for i in np.flatnonzero(np.diff(bound)):
                        found[i].append(bucket[bound[i] : bound[i + 1]])
                for parts, language in zip(found, rows.column("lang").to_pylist()):
                    if parts:
                        examples.append(vector(np.concatenate(parts)))
                        truth.append(place[language])
        model = Ftrl(BUCKETS, len(languages), ALPHA, BETA, L1, L2)
        one = np.eye(len(languages), dtype=np.float32)
        for _ in range(EPOCHS):
            for i, (rows, x) in enumerate(examples):
                if i % HELD_BACK:
                    model.learn(rows, x, one[truth[i]])
        held = range(0, len(examples), HELD_BACK)
        divisor = 1.0
        if len(languages) > 1 and len(held):
            logits = np.array([examples[i][1] @ model.weights(examples[i][0]) for i in held])
            divisor = temperature(logits, np.array([truth[i] for i in held]))
        weights = model.weights()
        row, column = np.nonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(row, -1).astype(np.int64)), pa.array(np.append(column, -1).astype(np.int64)),
                pa.array(np.append(weights[row, column], divisor).astype(np.float64)),
            ],
            names=["bucket", "language", "weight"],
        )

    learnt = (
        sample.repartition(1).sortWithinPartitions(F.xxhash64("key"), "key", "lang").select("text", "lang")
        .mapInArrow(learn, "bucket long, language long, weight double")
    )
    weights, divisor = np.zeros((BUCKETS + 1, len(languages)), np.float32), 1.0
    for bucket, language, weight in learnt.collect():
        if bucket < 0:
            divisor = weight
        else:
            weights[bucket, language] = weight
    return {
        "languages": languages, "temperature": divisor, "intercept": weights[-1],
        "weights": weights[:-1] * idf[:, None] * np.float32(SCALE),
    }


def predict(docs: DataFrame, model: dict, *keep: str) -> DataFrame:
    """The columns of ``keep``, ``lang_pred`` and its probability ``score``."""
    packed = docs.select(*keep, F.col("text").cast("string").alias("text"))
    kinds = dict(packed.dtypes)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        languages = own["languages"]
        for batch in batches:
            for rows, _ in tx.pieces(batch):
                n = len(rows)
                total = np.zeros((n, max(1, len(languages))), np.float64)
                count, letters = np.zeros(n, np.int64), np.zeros(n, np.int64)
                for bucket, row, seen in grams(rows.column("text").to_pylist()):
                    letters += seen
                    if not len(row) or not languages:
                        continue
                    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                    total[row[first]] += np.add.reduceat(own["weights"][bucket], first, axis=0)
                    count += np.bincount(row, minlength=n)
                told = (letters > 0) & bool(languages)
                pred, score = np.full(n, UNKNOWN, object), np.zeros(n)
                if told.any():
                    logits = total[told] / count[told, None] + own["intercept"]
                    p = probability(logits / own["temperature"]) if len(languages) > 1 else np.ones_like(logits)
                    pred[told] = np.array(languages, object)[p.argmax(axis=1)]
                    score[told] = p.max(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(c) for c in keep], pa.array(pred, pa.string()), pa.array(score)],
                    names=[*keep, "lang_pred", "score"],
                )

    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], "lang_pred string, score double"])
    return packed.mapInArrow(run, schema)
