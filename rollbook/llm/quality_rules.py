"""Quality rules with a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements and
one failure bit per rule; a policy is a versioned mask over those bits, so another
policy, or an ablation, needs no second look at the texts.

Defined cases: a null or empty text has no words and fails ``too_few_words``; rows
are judged one by one, so repeated rows and null ids stay as they are; an empty
table gives an empty ledger.  Extra columns are kept by ``filter_documents`` and
never read.  A text is measured whole, in memory that follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.llm import text as tx

REPEAT_WINDOW = 8  # words
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letters", "n_capitals", "n_wide", "n_echoes",
)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True

#: A rule fails where its expression over the measurements holds.  The bit of a rule
#: is its place in this list: append new ones, never move one.
RULES: tuple[tuple[str, str], ...] = (
    ("too_few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("capitals", "n_letters >= 20 AND 2 * n_capitals > n_letters"),
    ("duplicate_lines", "n_lines >= 4 AND 2 * n_dup_lines > n_lines"),
    ("word_length", "word_chars < 2 * n_words OR n_letters > 20 * n_words"),
    # Characters beyond ASCII count as letters here: no script is held against a text.
    ("few_letters", "2 * (n_letters + n_wide) < word_chars"),
    ("echoes", "5 * n_echoes > n_words"),
)
BITS = {name: 1 << place for place, (name, _) in enumerate(RULES)}

#: Policies by version.  A version never changes; a change of mind is a new version.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("too_few_words", "repeated_windows"),
    "corpus-1": (
        "too_few_words", "repeated_windows", "symbols", "capitals", "duplicate_lines",
        "word_length", "few_letters", "echoes",
    ),
}
POLICY = "corpus-1"


def repeat_words(word: np.ndarray, row: np.ndarray, n_rows: int, window: int) -> np.ndarray:
    """Words inside a window of words that the same text holds twice or more."""
    n = len(word)
    if n < window:
        return np.zeros(n_rows, np.int64)
    coefficient = tx.constants(7, window)
    total = word[: n - window + 1] * coefficient[0]
    for j in range(1, window):
        total += word[j : n - window + 1 + j] * coefficient[j]
    at = np.flatnonzero(row[: n - window + 1] == row[window - 1 :])
    # One key for window and row: equal windows of different texts must not meet.
    key = tx.mix(total[at] ^ tx.mix(row[at].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key)
    ranked = key[order]
    same = np.zeros(len(key), bool)
    same[1:] = ranked[1:] == ranked[:-1]
    same[:-1] |= same[1:]
    begins = at[order[same]]
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, begins + window, -1)
    covered = np.cumsum(change[:-1]) > 0
    return np.bincount(row[covered], minlength=n_rows).astype(np.int64)


def measures_of(texts: tx.Texts) -> dict[str, np.ndarray]:
    n = len(texts)
    data = texts.data
    words = tx.words(texts)
    byte_row = np.repeat(np.arange(n), np.diff(texts.offsets))

    def count(hit: np.ndarray) -> np.ndarray:
        return np.bincount(byte_row[hit], minlength=n).astype(np.int64)

    lines = tx.lines(texts)
    words_before = np.searchsorted(words.begin, lines.begin)
    has_word = np.searchsorted(words.begin, lines.end) > words_before
    spoken = tx.Spans(lines.begin[has_word], lines.end[has_word], lines.row[has_word])
    _, first_rows = tx.distinct(tx.hashes(data, spoken), spoken.row)
    word_hash = tx.hashes(data, words)
    echo = (word_hash[1:] == word_hash[:-1]) & (words.row[1:] == words.row[:-1])
    return {
        "n_words": words.counts(n),
        "word_chars": count(~tx.SPACE[data] & ((data & 0xC0) != 0x80)),
        "n_symbols": count(_SYMBOL[data]),
        "n_dup_lines": spoken.counts(n) - np.bincount(first_rows, minlength=n),
        "n_repeat_words": repeat_words(word_hash, words.row, n, REPEAT_WINDOW),
        "n_lines": spoken.counts(n),
        "n_letters": count(_LETTER[data]),
        "n_capitals": count(_CAPITAL[data]),
        "n_wide": count(data >= 0xC0),  # lead bytes: one per character
        "n_echoes": np.bincount(words.row[1:][echo], minlength=n).astype(np.int64),
    }


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in tx.pieces(batch):
            found = measures_of(texts)
            yield pa.RecordBatch.from_arrays(
                [rows.column("row"), *[pa.array(found[m]) for m in MEASURES]],
                names=["row", *MEASURES],
            )


def failures() -> Column:
    """One bit for every failed rule, from the measurements alone."""
    bits = [F.when(F.expr(rule), F.lit(BITS[name])).otherwise(F.lit(0)) for name, rule in RULES]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def mask_of(policy: str) -> int:
    return sum(BITS[name] for name in POLICIES[policy])


def ledger(docs: DataFrame, *keep: str) -> DataFrame:
    """``row`` (a struct of the columns of ``keep``, all by default), the measurements,
    and ``failed``: a bit per rule.  Names inside ``row`` cannot clash with the rest."""
    names = keep or docs.columns
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.col("text").cast("string").alias("text"),
    )
    schema = T.StructType([
        packed.schema["row"], *[T.StructField(m, T.LongType()) for m in MEASURES]
    ])
    return packed.mapInArrow(_measure, schema).withColumn("failed", failures())


def passes(failed: Column, policy: str = POLICY) -> Column:
    return failed.bitwiseAND(F.lit(mask_of(policy))) == 0


def ablation(rows: DataFrame, policy: str = POLICY) -> DataFrame:
    """Per rule of a policy: documents that fail it, and those that fail nothing else,
    which is what the policy would gain without the rule.

    Documents are first counted by their bits, which a task does for itself; only the
    counts move.
    """
    counted = (
        rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask_of(policy))).alias("bits"))
        .agg(F.count("*").alias("n"))
    )
    rules = F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).alias("bit")) for r in POLICIES[policy]
    ])).alias("r")
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return (
        counted.select("bits", "n", rules)
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n_failed"),
            F.coalesce(F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n"))), F.lit(0))
            .alias("n_failed_alone"),
        )
    )


def filter_documents(docs: DataFrame, policy: str = POLICY) -> DataFrame:
    """The documents that a policy keeps, with their own columns only.

    Whole rows pass through Python once, so no join brings a verdict back to its row.
    """
    return ledger(docs).filter(passes(F.col("failed"), policy)).select("row.*")
