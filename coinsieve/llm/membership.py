"""Fixed-size membership filters for the tasks of a later pass.

A filter says "surely not" or "maybe". It only spares shuffles: whatever passes
is decided exactly afterwards, so a full filter costs time and no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinsieve.llm.storage import tidy

# At most: 2**27 bits are 16 MB on the driver and in each Python worker, whatever the input.
FILTER_BITS = 27
_PAGE = 15  # bits in the number of bits of one row of the bitmap
_BITS_EACH = 64  # while that leaves the filter below its most bits


def bits_for(rows: int) -> int:
    """The ``bits`` of a filter of so many values: each worker and executor holds a copy."""
    return min(FILTER_BITS, max(_PAGE, (max(rows, 1) * _BITS_EACH - 1).bit_length()))


def build_filter(df: DataFrame, value: Column, bits: int = FILTER_BITS) -> np.ndarray:
    """Bitmap with the bits of all ``value`` modulo 2**bits, built by the executors
    in rows of 4 KB; at most 2**bits / 8 bytes reach the driver."""
    rows = (
        df.select(value.bitwiseAND(F.lit((1 << bits) - 1)).alias("v"))
        .groupBy(F.shiftright("v", _PAGE).alias("page"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("v") + 1)).alias("bitmap"))
    )
    out = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (_PAGE - 3)
    with tidy(df.sparkSession):
        pages = rows.collect()  # one job; toLocalIterator runs one for each partition
    for row in pages:
        out[row.page * size : (row.page + 1) * size] = np.frombuffer(row.bitmap, np.uint8)
    return out


def maybe(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """True where a 64-bit value may be in the set."""
    at = values.astype(np.uint64) & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
