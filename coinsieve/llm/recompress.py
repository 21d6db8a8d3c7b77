"""Removal of repeated word windows by recompression.

Every pass parses each document in the same way: in rounds, runs of one symbol
get a new name, then pairs of neighbours get one where a coin that the symbol's
name decides shows left for the first and right for the second. A name is a hash
of what it stands for, so equal word sequences get equal names on all executors
without a dictionary, but for a few symbols at their ends. With each symbol goes
the range of words that decides it. A symbol whose range lies inside a window
appears wherever that window appears: it is an interior symbol.

1. Each window of ``size`` words takes its widest interior symbol as its anchor
   (the window's own hash if it has none): a function of the window's words alone.
2. Anchors are counted by document. Windows under an anchor that one document has
   alone are unique. (A bitmap of the shared anchors, of fixed size, goes to the
   tasks.)
3. Runs of windows under a shared anchor are dealt by anchor and verified: equal
   hashes of all words, first document by number.
4. The found windows go back to their documents as bit masks, and covered words go.

Cases: windows are judged on the input. A null text has no words. A row without
doc_id is neither a source nor changed. Rows that share a doc_id are not smaller
than one another. A document with fewer words than a window keeps all. Other
columns pass through; names that start with ``_rc_`` are used inside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinsieve.llm import flat
from coinsieve.llm.membership import build_filter, maybe
from coinsieve.llm.storage import stored

WINDOW = 13
ROUNDS = 2
# An anchor with more blocks than this is grouped by counting joins, not in one task.
HOT_BLOCKS = 50_000
# The list of such anchors stays below this many entries: the limit above grows.
HOT_ANCHORS = 100_000
BLOCK = 32  # windows to a bit mask

FAR = np.int64(1) << 60
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def parse(words: np.ndarray, doc: np.ndarray, rounds: int) -> list[tuple[np.ndarray, ...]]:
    """(name, width, from, to) of the symbols after each round: the number of words a
    symbol stands for, and the words [from, to) that decide it, beyond the array where
    a document's end does."""
    name = words
    width = np.ones(len(words), np.int64)
    low = np.arange(len(words), dtype=np.int64)
    high = low + 1
    levels = []
    for turn in range(rounds):
        joined = doc[1:] == doc[:-1]
        # Runs: maximal, so the neighbours on both sides take part in the decision.
        heads = np.flatnonzero(np.r_[True, ~(joined & (name[1:] == name[:-1]))])
        counts = np.diff(np.r_[heads, len(name)])
        tails = heads + counts - 1
        before = np.r_[False, joined][heads]
        after = np.r_[joined, False][tails]
        low_2 = np.where(before, low[np.maximum(heads - 1, 0)], -FAR)
        high_2 = np.where(after, high[np.minimum(tails + 1, len(name) - 1)], FAR)
        run = flat.mix(name[heads] * np.uint64(0xC2B2AE3D27D4EB4F) + counts.astype(np.uint64))
        name = np.where(counts > 1, run, name[heads])
        low, high, doc = low_2, high_2, doc[heads]
        width = np.add.reduceat(width, heads)
        # Pairs: left and right by a coin for each name.
        right = flat.mix(name + np.uint64(0x165667B19E3779F9 + turn)) & np.uint64(1) == 1
        joined = doc[1:] == doc[:-1]
        first = np.r_[joined & ~right[:-1] & right[1:], False]
        second = np.r_[False, first[:-1]]
        near_low = np.r_[-FAR, np.where(joined, low[:-1], -FAR)]
        near_high = np.r_[np.where(joined, high[1:], FAR), FAR]
        low_2 = np.where(right & ~second, near_low, low)
        high_2 = np.where(~right, near_high, high)
        pair = flat.mix(name * np.uint64(0x27D4EB2F165667C5) + np.r_[name[1:], np.uint64(0)])
        name = np.where(first, pair, name)[~second]
        width = np.where(first, width + np.r_[width[1:], 0], width)[~second]
        # A pair is decided by what decides its two halves.
        high_2[:-1] = np.where(first[:-1], high[1:], high_2[:-1])
        low, high, doc = low_2[~second], high_2[~second], doc[~second]
        levels.append((name, width, low, high))
    return levels


def anchors(levels: list, windows: np.ndarray, size: int) -> np.ndarray:
    """For each word, the anchor of the window that starts there."""
    count = len(windows)
    best = np.full(count, NONE, np.uint64)
    for level, (name, symbol_width, low, high) in enumerate(levels):
        # The widest symbol first, then the least hash: wide symbols are seldom shared by chance.
        key = flat.mix(name + np.uint64(0x9E3779B185EBCA87 + level)) >> np.uint64(5)
        key |= (np.uint64(31) - np.minimum(symbol_width, 31).astype(np.uint64)) << np.uint64(59)
        spans = high - low
        for span in range(1, size + 1):
            pick = spans == span
            if not pick.any():
                continue
            at = np.full(count + size, NONE, np.uint64)
            np.minimum.at(at, low[pick], key[pick])
            # Least over the next size - span + 1 places, by doubling.
            width, have = size - span + 1, 1
            while have < width:
                step = min(have, width - have)
                at[:-step] = np.minimum(at[:-step], at[step:])
                have += step
            best = np.minimum(best, at[:count])
    return flat.mix(np.where(best == NONE, windows + np.uint64(0x85EBCA77C2B2AE63), best))


def blocks(
    data: np.ndarray, at: np.ndarray, size: int, rounds: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """(anchor, document, first window, number of windows, window hashes) of the runs
    of windows that share an anchor."""
    starts, ends, first = flat.find_words(data, at)
    if len(starts) < size:
        return None
    words = flat.hash_words(data, starts, ends)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(first))
    window = np.zeros(len(words), np.uint64)
    grams = flat.gram_hashes(words, size)
    window[: len(grams)] = grams
    whole = np.flatnonzero(np.arange(len(words)) + size <= first[1:][doc])
    if not len(whole):
        return None
    anchor = anchors(parse(words, doc, rounds), window, size)[whole]
    doc, place = doc[whole], whole - first[:-1][doc[whole]]
    head = np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]
    offset = np.arange(len(whole)) - np.flatnonzero(head)[np.cumsum(head) - 1]
    heads = np.flatnonzero(offset % BLOCK == 0)
    return anchor[heads], doc[heads], place[heads], np.diff(np.r_[heads, len(whole)]), window[whole]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def anchor_rows(docs: DataFrame, size: int, rounds: int) -> DataFrame:
    """(anchor, doc_id) for every block."""
    schema = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for a, _, data, at in flat.chunks(batch, "text"):
                if (made := blocks(data, at, size, rounds)) is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(made[0])), pa.array(ids[a + made[1]])], schema=schema
                    )

    return docs.select("doc_id", "text").mapInArrow(run, "anchor bigint, doc_id bigint")


def block_rows(docs: DataFrame, size: int, rounds: int, shared, hot: np.ndarray, want_hot: bool) -> DataFrame:
    """(anchor, doc_id, row_key, place, hashes) of blocks under anchors that may be shared."""
    names = ["anchor", "doc_id", "row_key", "place", "hashes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, _, data, at in flat.chunks(batch, "text"):
                if (made := blocks(data, at, size, rounds)) is None:
                    continue
                anchor, doc, place, count, window = made
                keep = np.isin(signed(anchor), hot) if want_hot else maybe(shared.value, anchor)
                if not want_hot and len(hot):
                    keep &= ~np.isin(signed(anchor), hot)
                if not keep.any():
                    continue
                window = window[np.repeat(keep, count)]
                ends = np.r_[0, np.cumsum(count[keep])].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(anchor[keep])), pa.array(ids[a + doc[keep]]),
                        pa.array(keys[a + doc[keep]]), pa.array(place[keep].astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(window))),
                    ],
                    names=names,
                )

    return docs.select("doc_id", F.xxhash64("text").alias("row_key"), "text").mapInArrow(
        run, "anchor bigint, doc_id bigint, row_key bigint, place int, hashes array<bigint>"
    )


def later_windows(table: pa.Table) -> pa.RecordBatch:
    """Blocks of whole anchors -> (doc_id, row_key, place, mask) of the windows that
    start in a smaller document too."""
    lists = table.column("hashes").combine_chunks()
    hashes = lists.flatten().to_numpy()
    count = np.diff(lists.offsets.to_numpy())
    block = np.repeat(np.arange(len(count)), count)
    bit = np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
    anchor, doc = (table.column(c).to_numpy()[block] for c in ("anchor", "doc_id"))
    order = np.lexsort((doc, hashes, anchor))
    h, n, d = hashes[order], anchor[order], doc[order]
    head = np.r_[True, (h[1:] != h[:-1]) | (n[1:] != n[:-1])]
    least = d[np.flatnonzero(head)[np.cumsum(head) - 1]]
    late = order[d > least]
    mask = np.zeros(len(count), np.int64)
    np.bitwise_or.at(mask, block[late], np.int64(1) << bit[late])
    found = np.flatnonzero(mask)
    return pa.RecordBatch.from_arrays(
        [pa.array(table.column(c).to_numpy()[found]) for c in ("doc_id", "row_key", "place")] + [pa.array(mask[found])],
        names=["doc_id", "row_key", "place", "mask"],
    )


def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partitions sorted by anchor; the last anchor of a batch waits for the next."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.column(0).to_numpy()
        cut = int(np.searchsorted(names, names[-1]))
        if cut or (held and held[-1].column(0)[-1].as_py() != names[0]):
            ready = [*held, batch.slice(0, cut)]
            held = []
            yield later_windows(pa.Table.from_batches(ready))
        held.append(batch.slice(cut))
    if held:
        yield later_windows(pa.Table.from_batches(held))


MARKS = "doc_id bigint, row_key bigint, place int, mask bigint"


def repeated_windows(docs: DataFrame, size: int = WINDOW, rounds: int = ROUNDS, hot_blocks: int = HOT_BLOCKS) -> DataFrame:
    """(doc_id, row_key, place, mask): which windows of a row start in a smaller document too.

    Bit b of ``mask`` is the window at word ``place`` + b; ``row_key`` is xxhash64 of the text.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).filter(
        "doc_id IS NOT NULL AND text IS NOT NULL"
    )
    shared = stored(
        anchor_rows(docs, size, rounds)
        .groupBy("anchor")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n"))
        .filter("low < high")
        .select("anchor", "n"),
        "anchors",
    )
    bitmap = spark.sparkContext.broadcast(build_filter(shared, F.col("anchor")))
    total = shared.agg(F.sum("n").alias("n")).first().n or 0
    limit = max(hot_blocks, total // HOT_ANCHORS)
    hot = np.array([r.anchor for r in shared.filter(F.col("n") > limit).select("anchor").collect()], np.int64)
    cold = block_rows(docs, size, rounds, bitmap, hot, False)
    found = cold.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(verify, MARKS)
    if len(hot):
        rows = block_rows(docs, size, rounds, bitmap, hot, True).select(
            "anchor", "doc_id", "row_key", "place", F.posexplode("hashes").alias("bit", "hash")
        )
        first = rows.groupBy("anchor", "hash").agg(F.min("doc_id").alias("first_id"))
        found = found.unionByName(
            rows.join(first, ["anchor", "hash"])
            .filter("first_id < doc_id")
            .groupBy("doc_id", "row_key", "place")
            .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
        )
    return found


def dedupe_substrings(docs: DataFrame, size: int = WINDOW, rounds: int = ROUNDS, hot_blocks: int = HOT_BLOCKS) -> DataFrame:
    """``docs`` with ``_rc_kept`` (kept words joined by one space), ``_rc_words`` and
    ``_rc_removed`` (numbers of words)."""
    marks = (
        stored(repeated_windows(docs, size, rounds, hot_blocks), "windows")
        .groupBy(F.col("doc_id").alias("_rc_id"), F.col("row_key").alias("_rc_key"))
        .agg(F.collect_list("place").alias("_rc_place"), F.collect_list("mask").alias("_rc_mask"))
    )
    keyed = docs.withColumn("_rc_text", F.col("text").cast("string")).withColumns(
        {"_rc_id_": F.col("doc_id").cast("bigint"), "_rc_key_": F.xxhash64("_rc_text")}
    )
    joined = keyed.join(
        marks, (F.col("_rc_id_") == F.col("_rc_id")) & (F.col("_rc_key_") == F.col("_rc_key")), "left"
    ).drop("_rc_id", "_rc_key", "_rc_id_", "_rc_key_")
    columns = docs.columns
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("_rc_kept", T.StringType()),
         T.StructField("_rc_words", T.LongType()), T.StructField("_rc_removed", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, at in flat.chunks(batch, "_rc_text"):
                part = batch.slice(a, b - a)
                kept, sizes, words, removed = keep_words(part, data, at, size)
                text = pa.LargeStringArray.from_buffers(b - a, pa.py_buffer(sizes), pa.py_buffer(kept))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in range(len(columns))], text.cast(pa.string()),
                     pa.array(words), pa.array(removed)],
                    names=[*columns, "_rc_kept", "_rc_words", "_rc_removed"],
                )

    return joined.select(*[F.col(f"`{c}`") for c in columns], "_rc_text", "_rc_place", "_rc_mask").mapInArrow(run, schema)


def keep_words(part: pa.RecordBatch, data: np.ndarray, at: np.ndarray, size: int):
    """(bytes, offsets) of the kept words, and the numbers of all and of removed words."""
    starts, ends, first = flat.find_words(data, at)
    cover = np.zeros(len(starts) + size + BLOCK + 1, np.int64)
    places, masks = part.column(part.num_columns - 2), part.column(part.num_columns - 1)
    counts = np.diff(places.offsets.to_numpy())
    counts = np.where(places.is_valid().to_numpy(zero_copy_only=False), counts, 0)
    place = np.repeat(first[:-1], counts) + places.flatten().to_numpy()
    mask = masks.flatten().to_numpy()
    for bit in range(BLOCK):
        hit = place[(mask >> bit) & 1 == 1] + bit
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + size, -1)
    stays = np.cumsum(cover)[: len(starts)] <= 0
    doc = np.repeat(np.arange(len(at) - 1), np.diff(first))
    words = np.diff(first).astype(np.int64)
    removed = words - np.bincount(doc[stays], minlength=len(words))
    s, e, d = starts[stays], ends[stays], doc[stays]
    inside = np.zeros(len(data) + 1, np.int64)
    inside[s] += 1
    inside[e] -= 1
    keep = np.cumsum(inside)[: len(data)] > 0
    gaps = e[:-1][d[1:] == d[:-1]]  # the byte after a word that another one follows
    out = data.copy()
    out[gaps] = 32
    keep[gaps] = True
    offsets = np.r_[0, np.cumsum(keep)][at].astype(np.int64)
    return out[keep], offsets, words, removed


def kept_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    made = dedupe_substrings(docs.select("doc_id", "text"))
    return made.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("_rc_words").alias("n_words"),
        F.col("_rc_removed").alias("n_removed"),
        F.sha2(F.col("_rc_kept").cast("binary"), 256).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with repeated windows cut out of their texts: what is left of a changed
    text is its kept words joined by one space. ``n_chars`` follows where it is a column."""
    made = dedupe_substrings(docs, size)
    changed = F.col("_rc_removed") > 0
    new = {"text": F.when(changed, F.col("_rc_kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        size_of = F.length("_rc_kept").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(changed, size_of).otherwise(F.col("n_chars"))
    return made.withColumns(new).select(*[F.col(f"`{c}`") for c in docs.columns])
