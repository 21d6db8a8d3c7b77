"""Texts of an Arrow batch as flat numpy arrays: bytes, words, word hashes.

Every function handles any number of documents at once and no loop runs over
words. A word is a maximal run of bytes outside 0x20 and 0x09-0x0D; those are
ASCII, so in UTF-8 that is the same as a run of code points outside them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Text handled at once; a longer document is handled alone.
CHUNK_BYTES = 1 << 18

# Odd multiplier of the polynomial word hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat, at


def chunks(
    batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) for runs of rows of about ``size`` bytes."""
    flat, at = text_buffers(batch.column(batch.schema.get_field_index(column)))
    rows, start = batch.num_rows, 0
    while start < rows:
        end = int(np.searchsorted(at, at[start] + size, side="right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end, flat[at[start] : at[end]], at[start : end + 1] - at[start]
        start = end


def find_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) byte positions of all words, and per document the number of the first one.

    The third array has one entry more than there are documents.
    """
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = at[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, at)


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    known = _powers.get(0)
    if known is not None and len(known[0]) >= n:
        return known
    size = max(n, CHUNK_BYTES + 1)

    def table(base: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    made = table(BASE), table(INVERSE)
    if size <= 4 * CHUNK_BYTES:  # a single huge document does not stay in memory
        _powers[0] = made
    return made


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word from prefix sums of one polynomial."""
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` word hashes; entry i starts at word i."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = out * np.uint64(0xD1342543DE82EF95) + words[j : j + n]
    return mix(out)
