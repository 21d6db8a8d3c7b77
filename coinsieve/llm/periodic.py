"""Periodic runs of words, found by online dyadic square catching.

Words are appended one after the other or many at once; the result does not depend on how.
Whenever the text passes a multiple of a power of two L, the block of the last L words is
complete and becomes a catcher. It waits for its own words to come again after a
distance of 2/3 L to 4/3 L: every appended word completes one suffix of L words, and
that suffix is compared with the one catcher whose distances it can have. A match is a
square in the making: it is followed to the left word by word, and to the right as far
as the text goes, again with every append. Squares of one period that overlap merge into one
stretch; a stretch of enough periods is a run.

A run of period q and at least four periods matches itself at distance q over three periods, which hold
a whole aligned block of the size that serves distance q, so no run is missed. Suffixes are compared
by hashes, matches are followed by the words themselves, so none is made up.

Cases: a null text has no words. A stretch that several periods fit is reported with the smallest.
A run that goes on in both directions is one row; runs may overlap. Repeated rows each come back.
Other columns pass through; ``n_words``, ``runs`` and ``collapsed`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"

# A run has this many periods and this many words at least.
PERIODS = 4
LEAST_WORDS = 6
# Words appended at once: suffix hashes are kept for a few blocks of each size only.
APPEND = 1 << 16
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def nearest(size: int) -> int:
    """The smallest distance that blocks of this size serve: from it on, three periods
    hold an aligned block whatever their place."""
    return -(-(2 * size - 1) // (PERIODS - 1))


class SquareCatcher:
    """Runs of a text that is appended in pieces."""

    def __init__(self) -> None:
        self.words = np.zeros(0, np.int64)
        self.n = 0
        # Per block size 1, 2, 4, ...: (first place kept, hashes of the suffixes that start there and after).
        self.suffixes: list[tuple[int, np.ndarray]] = []
        # Per period, the stretches that match themselves: [start, end) of the places j with word j = word j + period.
        self.stretches: dict[int, list[list[int]]] = {}
        # Per place, the run that reaches furthest of those known there: its period and end.
        self.period = np.zeros(0, np.int64)
        self.reach = np.zeros(0, np.int64)

    def append(self, words: np.ndarray) -> None:
        """``words``: numbers, equal for equal words."""
        for start in range(0, len(words), APPEND):
            self._append(words[start : start + APPEND])

    def _append(self, words: np.ndarray) -> None:
        before, self.n = self.n, self.n + len(words)
        if self.n > len(self.words):
            room = max(2 * len(self.words), self.n)
            for name in ("words", "period", "reach"):
                grown = np.zeros(room, np.int64)
                grown[:before] = getattr(self, name)[:before]
                setattr(self, name, grown)
        self.words[before : self.n] = words
        for period, found in self.stretches.items():
            if found[-1][1] + period == before:  # was open at the end
                found[-1][1] = self._right(found[-1][1], period)
                self._cover(period, *found[-1])
        level, size = 0, 1
        while size == 1 or PERIODS * nearest(size) <= self.n:
            self._advance(level, size, words)
            if size > 1:
                self._catch(level, size, before)
            level, size = level + 1, 2 * size
        # Suffixes that no later word can need go.
        for level, (first, hashes) in enumerate(self.suffixes):
            keep = self.n - 6 * (1 << level)
            if keep - first > len(hashes) // 2:
                self.suffixes[level] = keep, hashes[keep - first :].copy()

    def _advance(self, level: int, size: int, words: np.ndarray) -> None:
        """Hashes of the suffixes of one size that the appended words complete."""
        if level == len(self.suffixes):
            self.suffixes.append((0, np.zeros(0, np.uint64)))
        first, hashes = self.suffixes[level]
        if size == 1:
            new = words.astype(np.uint64) * _FACTOR
        else:
            start, half = first + len(hashes), size // 2
            lower, parts = self.suffixes[level - 1]
            left = parts[start - lower : self.n - size + 1 - lower]
            right = parts[start + half - lower : self.n - half + 1 - lower]
            new = (left ^ (left >> _SHIFT)) * _FACTOR + right
        self.suffixes[level] = first, np.concatenate([hashes, new])

    def _catch(self, level: int, size: int, before: int) -> None:
        """Compare each new suffix with the catcher that waits for it."""
        first, hashes = self.suffixes[level]
        low, high = nearest(size), nearest(2 * size) - 1
        start = max(low, before - size + 1, 0)
        if PERIODS * low > before:  # blocks of this size come into use: nothing was compared before
            start = low
        suffix = np.arange(start, self.n - size + 1)
        block = (suffix - low) // size * size
        met = hashes[suffix - first] == hashes[block - first]
        met &= suffix - block <= high
        if not met.any():
            return
        suffix, block = suffix[met], block[met]
        distance = suffix - block
        # Inside a known run, distances that its period divides tell nothing new.
        known = self.period[block]
        inside = (known > 0) & (self.reach[block] >= suffix + size)
        new = ~(inside & (distance % np.maximum(known, 1) == 0))
        for period, place in zip(distance[new].tolist(), block[new].tolist(), strict=True):
            found = self.stretches.get(period)
            if found and place < found[-1][1]:
                continue  # merges into the stretch found last
            left, right = self._left(place, period), self._right(place, period)
            if right - place < size:
                continue  # equal hashes of different words
            self.stretches.setdefault(period, []).append([left, right])
            self._cover(period, left, right)

    def _right(self, place: int, period: int) -> int:
        """The first place from ``place`` on whose word differs from that a period on, or where the text ends."""
        step, last = 32, self.n - period
        while place < last:
            end = min(place + step, last)
            differ = self.words[place:end] != self.words[place + period : end + period]
            if differ.any():
                return place + int(differ.argmax())
            place, step = end, 2 * step
        return place

    def _left(self, place: int, period: int) -> int:
        """The start of the matching stretch that holds ``place``."""
        step = 32
        while place > 0:
            start = max(place - step, 0)
            differ = self.words[start:place] != self.words[start + period : place + period]
            if differ.any():
                return place - int(differ[::-1].argmax())
            place, step = start, 2 * step
        return 0

    def _cover(self, period: int, left: int, right: int) -> None:
        end = right + period
        if end - left < max(LEAST_WORDS, PERIODS * period):
            return
        further = self.reach[left:end] < end
        self.period[left:end][further] = period
        self.reach[left:end][further] = end

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs so far, by start, then period."""
        smallest: dict[tuple[int, int], int] = {}
        for period, found in self.stretches.items():
            for left, right in found:
                length = right + period - left
                if length >= max(LEAST_WORDS, PERIODS * period):
                    smallest[left, length] = min(period, smallest.get((left, length), period))
        return sorted(((left, length, period) for (left, length), period in smallest.items()), key=lambda r: (r[0], r[2]))


def runs_of(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs in a list of words."""
    if len(words) < LEAST_WORDS:
        return []
    numbers: dict = {}
    catcher = SquareCatcher()
    catcher.append(np.fromiter(map(numbers.setdefault, words, count()), np.int64, len(words)))
    return catcher.runs()


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that any run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words), bool)
    for start, length, period in runs:
        drop[start + period : start + length] = True
    return [words[i] for i in np.flatnonzero(~drop)]


RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
ADDED = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, the runs of its texts, and the texts with each run cut to its first period."""
    kept = docs.drop(*[f.name for f in ADDED])
    schema = T.StructType([*kept.schema.fields, *ADDED])
    run_type = pa.list_(pa.struct([(f.name, pa.int64()) for f in RUN.fields]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, runs, texts = [], [], []
            for value in batch.column(batch.schema.get_field_index(text)):
                # Without arguments, bytes are split at 0x20 and 0x09 to 0x0D.
                words = (value.as_py() or "").encode().split()
                found = runs_of(words)
                sizes.append(len(words))
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                texts.append(b" ".join(collapsed(words, found)).decode())
            columns = [pa.array(sizes, pa.int64()), pa.array(runs, run_type), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[f.name for f in schema.fields])

    return kept.mapInArrow(run, schema)


def planted(docs: DataFrame) -> Column:
    """Every tenth text (by the checksum of its doc_id) with a periodic tail."""
    h = F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(f"({WORD})"))
    g = F.floor(h / 10).cast("bigint")

    def tail(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("bigint")
        places = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.transform(places, lambda i: F.get(w, i.cast("int"))), " "))

    # The words are listed once, then looked up by place.
    made = F.element_at(F.transform(F.array(words), tail), 1)
    return F.when(h % 10 == 0, F.coalesce(made, F.lit(""))).otherwise(F.col("text").cast("string"))


def run_digests(docs: DataFrame) -> DataFrame:
    """Runs of every text, every tenth with a planted tail: the number, the longest, and digests."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), planted(docs).alias("text"))
    found = find_runs(texts)
    # The longest first, then the earliest, then the shortest period.
    ranked = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("back"), (-r.period).alias("less"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return found.select("doc_id", "collapsed", F.size("runs").cast("bigint").alias("n_runs"), ranked.alias("best"), lines.alias("lines")).select(
        "doc_id", "n_runs", (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.less")).alias("period"),
        F.floor(F.col("best.length") * 1000 / -F.col("best.less")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
