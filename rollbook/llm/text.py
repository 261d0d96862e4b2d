"""Words of whole texts as arrays: the vectorised part that several operators share.

A Spark task gets Arrow batches; ``pieces`` cuts them into runs of rows with about
a megabyte of text, and everything here works on one such run at a time, so a
task's memory follows the longest single text, not the batch or the partition, and
many tiny texts cost no more than a few long ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
PIECE_ROWS = 1 << 12
HASH_BYTES = 1 << 20  # bytes of words hashed at a time

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: ASCII letters and digits, and every byte of a longer character.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """1, m, m*m, ... modulo 2**64 for an odd m."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 2 * len(_powers)), _MULTIPLIER)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def constants(seed: int, n: int) -> np.ndarray:
    """n odd 64-bit numbers that are the same in every process."""
    base = np.uint64(seed) * np.uint64(1 << 32)
    return mix(base + np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


@dataclass
class Texts:
    """Concatenated UTF-8 of some rows; row i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def texts_of(column: pa.Array) -> Texts:
    """The column's bytes; a null is an empty text."""
    column = column.fill_null("").cast(pa.large_utf8())
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, bounds, data = column.buffers()
    offsets = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(whole[offsets[0] : offsets[-1]], offsets - offsets[0])


def pieces(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of a batch with about PIECE_BYTES of text and at most PIECE_ROWS, one row at
    least."""
    texts = texts_of(batch.column(column))
    row = 0
    while row < len(texts):
        limit = texts.offsets[row] + PIECE_BYTES
        end = int(np.searchsorted(texts.offsets, limit, "right")) - 1
        end = max(row + 1, min(end, row + PIECE_ROWS))
        lo, hi = texts.offsets[row], texts.offsets[end]
        yield batch.slice(row, end - row), Texts(texts.data[lo:hi], texts.offsets[row : end + 1] - lo)
        row = end


@dataclass
class Spans:
    """Runs of bytes inside texts: begin, end (exclusive) and the row each is in."""

    begin: np.ndarray
    end: np.ndarray
    row: np.ndarray

    def counts(self, n_rows: int) -> np.ndarray:
        return np.bincount(self.row, minlength=n_rows).astype(np.int64)


def runs(texts: Texts, inside: np.ndarray) -> Spans:
    """Maximal runs of bytes where ``inside`` holds; no run crosses rows."""
    n = len(texts.data)
    fresh = np.zeros(n + 1, bool)
    fresh[texts.offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | fresh[1:n]
    lasts = inside.copy()
    lasts[:-1] &= ~inside[1:] | fresh[1:n]
    begin = np.flatnonzero(starts)
    row = np.searchsorted(texts.offsets, begin, "right") - 1
    return Spans(begin, np.flatnonzero(lasts) + 1, row)


def words(texts: Texts) -> Spans:
    r"""The words ``[^\x20\x09-\x0D]+``."""
    return runs(texts, ~SPACE[texts.data])


def lines(texts: Texts) -> Spans:
    r"""The parts between ``\n``, empty ones included."""
    breaks = np.flatnonzero(texts.data == 10)
    begin = np.sort(np.concatenate([texts.offsets[:-1], breaks + 1]))
    end = np.sort(np.concatenate([texts.offsets[1:], breaks]))
    rows = np.sort(np.concatenate([
        np.arange(len(texts)), np.searchsorted(texts.offsets, breaks, "right") - 1
    ]))
    return Spans(begin, end, rows)


def hashes(data: np.ndarray, spans: Spans, table: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of every span's bytes, after mapping them through ``table``."""
    out = np.empty(len(spans.begin), np.uint64)
    done = np.concatenate([[0], np.cumsum(spans.end - spans.begin)])
    at = 0
    while at < len(out):
        upto = max(at + 1, int(np.searchsorted(done, done[at] + HASH_BYTES, "right")) - 1)
        length = spans.end[at:upto] - spans.begin[at:upto]
        first = done[at:upto] - done[at]
        place = np.arange(done[upto] - done[at]) - np.repeat(first, length)
        chars = data[place + np.repeat(spans.begin[at:upto], length)]
        if table is not None:
            chars = table[chars]
        value = (chars.astype(np.uint64) + np.uint64(1)) * powers(int(length.max(initial=1)))[place]
        total = np.zeros(upto - at, np.uint64)
        full = length > 0
        if full.any():
            total[full] = np.add.reduceat(value, first[full])
        out[at:upto] = total
        at = upto
    return mix(out + np.uint64(0x51))


def shingles(word: np.ndarray, row: np.ndarray, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of k words; a text of fewer words is one shingle,
    a text without words none."""
    coefficient = constants(k, k)
    n = len(word)
    counts = np.bincount(row, minlength=n_rows)
    first = np.cumsum(counts) - counts
    if n >= k:
        total = word[: n - k + 1] * coefficient[0]
        for j in range(1, k):
            total += word[j : n - k + 1 + j] * coefficient[j]
        whole = row[: n - k + 1] == row[k - 1 :]
        out, out_row = mix(total[whole]), row[: n - k + 1][whole]
    else:
        out, out_row = np.zeros(0, np.uint64), np.zeros(0, row.dtype)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            has = counts[short] > j
            extra[has] += word[first[short[has]] + j] * coefficient[j]
        extra += counts[short].astype(np.uint64)  # of another length: another shingle
        out = np.concatenate([out, mix(extra)])
        out_row = np.concatenate([out_row, short.astype(out_row.dtype)])
    return out, out_row


def distinct(values: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's values once, ordered by row and value."""
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[new], row[new]


def sum_by_row(values: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """Sum of values (modulo 2**64) for each row; ``row`` is ascending."""
    out = np.zeros(n_rows, values.dtype)
    if len(row):
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        out[row[first]] = np.add.reduceat(values, first)
    return out


def signed(values: np.ndarray) -> pa.Array:
    """Unsigned 64-bit numbers as Spark's long, bit by bit."""
    return pa.array(values.view(np.int64))
