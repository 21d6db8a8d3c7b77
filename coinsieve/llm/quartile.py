"""Document fingerprints from the quartiles of hashed byte triplets.

Triplets of bytes within four neighbouring bytes are hashed into 256 buckets and
counted. Each bucket is written as the quartile its count falls into (two bits), after a
header: length on a logarithmic scale, two ratios of the quartile borders, and a
checksum. The difference of two digests adds up header and bucket differences and is
bounded; likeness is one less its share of the bound.

Cases: a null text is an empty one; its buckets are all zero. Equal texts have equal
digests. The next document is the next row by doc_id (nulls first), then by a hash of
the text; after the last row comes the first, so a single row is its own next one. Repeated rows each
come back. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coinsieve.llm import flat
from coinsieve.llm.storage import stored

BUCKETS = 256
# Places of the three bytes of a triplet, from its first byte.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
LENGTH_BASE = 1.1
# Differences add up to this at most; random buckets differ by about 416.
BOUND = 512
LENGTH_WEIGHT, RATIO_WEIGHT, FAR_BUCKET = 2, 4, 6


def counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(documents, buckets) triplet counts."""
    docs = len(at) - 1
    doc = np.repeat(np.arange(docs, dtype=np.int64) * BUCKETS, np.diff(at))
    end = np.repeat(at[1:], np.diff(at))
    wide = data.astype(np.uint32)
    place = np.arange(len(data))
    total = np.zeros(docs * BUCKETS, np.int64)
    for salt, (a, b, c) in enumerate(TRIPLETS):
        n = len(data) - c
        if n <= 0:
            continue
        h = wide[a : a + n] * np.uint32(0x9E3779B1) + wide[b : b + n] * np.uint32(0x85EBCA6B)
        h += wide[c : c + n] * np.uint32(0xC2B2AE35) + np.uint32(salt * 0x27D4EB2F + 1)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        inside = place[:n] + c < end[:n]
        total += np.bincount((doc[:n] + (h >> np.uint32(24)))[inside], minlength=docs * BUCKETS)
    return total.reshape(docs, BUCKETS)


def digests(texts: list[bytes]) -> tuple[np.ndarray, list[str]]:
    """Per text: header and bucket codes as numbers, and the digest as hex."""
    at = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    met = counts(data, at)
    order = np.sort(met, axis=1)
    q1, q2, q3 = (order[:, BUCKETS * k // 4 - 1] for k in (1, 2, 3))
    code = (met > q1[:, None]).astype(np.uint8) + (met > q2[:, None]) + (met > q3[:, None])
    size = np.diff(at)
    length = np.minimum(np.floor(np.log1p(size) / np.log(LENGTH_BASE)), 255).astype(np.uint8)
    top = np.maximum(q3, 1)
    ratios = (15 * q1 // top * 16 + 15 * q2 // top).astype(np.uint8)
    wide = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * (np.arange(len(data), dtype=np.uint64) * np.uint64(2) + np.uint64(1)))]
    # Weighted sum with weights from the text's own start: subtract what lies before it.
    plain = np.r_[np.uint64(0), np.cumsum(data.astype(np.uint64) + np.uint64(1))]
    first = at[:-1].astype(np.uint64)
    own = (wide[at[1:]] - wide[at[:-1]]) - (plain[at[1:]] - plain[at[:-1]]) * first * np.uint64(2)
    check = (flat.mix(own) >> np.uint64(56)).astype(np.uint8)
    packed = (code[:, 0::4] << 6) | (code[:, 1::4] << 4) | (code[:, 2::4] << 2) | code[:, 3::4]
    body = np.concatenate([length[:, None], ratios[:, None], check[:, None], packed], axis=1)
    numbers = np.concatenate([length[:, None], ratios[:, None] >> 4, ratios[:, None] & 15, check[:, None], code], axis=1)
    return numbers.astype(np.int16), [row.tobytes().hex() for row in body]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 - bounded difference / bound, per row."""
    d = np.abs(a - b).astype(np.int64)
    buckets = np.where(d[:, 4:] == 3, FAR_BUCKET, d[:, 4:]).sum(axis=1)
    total = buckets + LENGTH_WEIGHT * d[:, 0] + RATIO_WEIGHT * (d[:, 1] + d[:, 2]) + (d[:, 3] > 0)
    return 1 - np.minimum(total, BOUND) / BOUND


def difference(a: str, b: str) -> int:
    """The bounded difference of two digests."""

    def numbers(digest: str) -> np.ndarray:
        raw = np.frombuffer(bytes.fromhex(digest), np.uint8)
        code = np.stack([raw[3:] >> s & 3 for s in (6, 4, 2, 0)], axis=1).ravel()
        return np.r_[raw[0], raw[1] >> 4, raw[1] & 15, raw[2], code].astype(np.int16)[None]

    return round((1 - likeness(numbers(a), numbers(b))[0]) * BOUND)


COLUMNS = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
NAMES = [c.split(" ")[0] for c in COLUMNS.split(", ")]
ARROW = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def compared(ids: list, texts: list[str], nexts: list[str]) -> list[pa.Array]:
    """The result columns for texts, each with the text of its next document."""
    edited = [
        (t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode() for t, n in zip(texts, nexts, strict=True)
    ]
    own, shown = digests([t.encode() for t in texts])
    changed, changed_shown = digests(edited)
    after, _ = digests([t.encode() for t in nexts])
    values = [
        ids, [len(t) for t in texts], [hashlib.sha256(e).hexdigest() for e in edited], shown, changed_shown,
        likeness(own, changed), likeness(own, after),
    ]
    return [pa.array(v, t) for v, t in zip(values, ARROW, strict=True)]


def in_parts(ids: list, texts: list[str], nexts: list[str]) -> Iterator[list[pa.Array]]:
    start = 0
    while start < len(ids):
        end, held = start, 0
        while end < len(ids) and (end == start or held < flat.CHUNK_BYTES):
            held += len(texts[end])
            end += 1
        yield compared(ids[start:end], texts[start:end], nexts[start:end])
        start = end


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """The result columns for every document and its next one.

    Documents are range-partitioned and sorted once; each task sees its neighbours in
    order. Only the first and last text of every partition are matched up by a join.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [zlib.compress(t.as_py().encode(), 1) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["doc_id", "tie", "packed"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    ordered = (
        docs.select(F.col("doc_id").cast("bigint"), F.xxhash64(text).alias("tie"), text.alias("text"))
        # Whole texts are shuffled once, deflated.
        .mapInArrow(pack, "doc_id bigint, tie bigint, packed binary")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "packed")
    )
    extra = [pa.int32(), pa.string(), pa.string()]

    def rows(columns: list[pa.Array], part: int | None = None, edge: str | None = None, text: str | None = None):
        n = len(columns[0])
        more = [pa.array([v] * n, t) for v, t in zip((part, edge, text), extra, strict=True)]
        return pa.RecordBatch.from_arrays([*columns, *more], names=[*NAMES, "part", "edge", "edge_text"])

    def edge_row(doc_id, part: int, edge: str, text: str):
        return rows([pa.array([doc_id], ARROW[0]), *[pa.nulls(1, t) for t in ARROW[1:]]], part, edge, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held_id, held = None, None
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [zlib.decompress(p.as_py()).decode() for p in batch.column(1)]
            if not ids:
                continue
            if held is None:
                yield edge_row(ids[0], part, "first", texts[0])
            else:
                ids, texts = [held_id, *ids], [held, *texts]
            for columns in in_parts(ids[:-1], texts[:-1], texts[1:]):
                yield rows(columns)
            held_id, held = ids[-1], texts[-1]
        if held is not None:
            yield edge_row(held_id, part, "last", held)

    made = stored(ordered.mapInArrow(run, COLUMNS + ", part int, edge string, edge_text string"), "fingerprints")
    # One row per partition: which partition with rows comes next, the first after the last.
    parts = made.filter("edge = 'first'").select("part")
    follows = parts.select(
        "part",
        F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next_part"),
    )
    lasts = made.filter("edge = 'last'").select("doc_id", F.col("edge_text").alias("text"), "part").join(follows, "part")
    firsts = made.filter("edge = 'first'").select(F.col("edge_text").alias("next_text"), F.col("part").alias("next_part"))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in in_parts(*[batch.column(i).to_pylist() for i in range(3)]):
                yield pa.RecordBatch.from_arrays(columns, names=NAMES)

    edges = lasts.join(firsts, "next_part").select("doc_id", "text", "next_text").mapInArrow(match, COLUMNS)
    return made.filter("edge IS NULL").select(*NAMES).unionByName(edges)
