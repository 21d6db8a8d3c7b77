"""Language-model scores from a probabilistic suffix tree over words.

The tree's states are contexts of up to DEPTH words. P0 is the smoothed frequency of a word. A
state s that was followed by N words, T of them distinct, gives

    P(w | s) = (max(c(s, w) - 1, 0) + T * P(w | s')) / N

with s' its longest retained suffix (at last P0): each count gives up one, and what the
counts give up goes to the shorter context. That adds up to one over all words. A context is
retained if this gains over s': N times the divergence of P(. | s) from P(. | s') on the
training words, bounded from below by concavity, must reach DIVERGENCE nats. A text's score is
the sum over its words, and the end, of log10 P(w | longest retained suffix of the words before).

The documents become blocks of about BLOCK_TOKENS words: the sorted word hashes, and every
word as its number among them. What a block must know of the corpus it asks: the sorted hashes of
its n-grams go, packed and by ranges of hash values, to the tasks that add up each range, and the
totals come back in the same order. No n-gram is one row, none travels twice in a round, and a
frequent word is one entry per block. Only n-grams are asked whose beginning and end occur twice: a
count of one gives nothing to a state. Of a context's words each is entered by one block, the
first to hold it. The rounds: words; pairs; then n-grams of one more word together with
the states one shorter. Nothing of the model is broadcast but two totals.

Words are told apart by 64-bit hashes, n-grams by hashes of SPARE_BITS bits more than the corpus's size has. Cases: a null text is an empty one and has one token, the
end. Rows without doc_id are scored, held out and never learned from. Repeated rows count as often as
they come and get equal scores. Without training rows P0 is 1 for every word. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinsieve.llm import flat
from coinsieve.llm.storage import stored

DEPTH = 3
DIVERGENCE = 2.0

# Words of a block, about; a longer document is a block of its own.
BLOCK_TOKENS = 1 << 20
# Words of the corpus per range of hash values, and the least number of ranges (powers of two).
RANGE_TOKENS = 1 << 22
LEAST_RANGES = 32
# Keys of n-grams have so many bits more than the number of words of the corpus has, up to 64:
# one n-gram in two million shares its key with another.
SPARE_BITS = 21
# The end of a text.
END = np.uint64(0x5DEECE66D1CE4E5B)
_STEP = np.uint64(0xD1342543DE82EF95)

STATE, COUNT, STATES = 0, 1, 2
ROWS = (
    "block bigint, kind int, size int, span int, keys binary, vals binary, "
    "docs array<struct<doc_id:bigint,n:int,train:boolean>>, n bigint, v bigint"
)
NAMES = [part.strip().split(" ")[0] for part in ROWS.split(", ")]
DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("n", pa.int32()), ("train", pa.bool_())]))
TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), DOCS, pa.int64(), pa.int64()]


# --- packed arrays ------------------------------------------------------------------


def packed(values: np.ndarray) -> bytes:
    """Numbers in the narrowest type, byte planes apart, deflated."""
    if values.dtype.kind != "f":
        values = values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()
    head = np.array([len(values)], np.int64).tobytes() + values.dtype.char.encode()
    return head + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def unpacked(raw: bytes) -> np.ndarray:
    n, kind = int(np.frombuffer(raw[:8], np.int64)[0]), np.dtype(raw[8:9].decode())
    if not n:
        return np.zeros(0, kind)
    planes = pa.decompress(raw[9:], decompressed_size=n * kind.itemsize, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, n).T).view(kind).ravel()


def joined(columns: list[np.ndarray]) -> bytes:
    """Several packed arrays in one."""
    parts = [packed(c) for c in columns]
    return b"".join(np.array([len(p)], np.int64).tobytes() + p for p in parts)


def separated(raw: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(raw):
        end = at + 8 + int(np.frombuffer(raw[at : at + 8], np.int64)[0])
        out.append(unpacked(raw[at + 8 : end]))
        at = end
    return out


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as their differences."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked(raw), dtype=np.uint64)


def row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values.get(n)], t) for n, t in zip(NAMES, TYPES, strict=True)], names=NAMES)


def grouped(batches: Iterator[pa.RecordBatch], by: Callable) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows of sorted batches as dicts, one group after the other."""

    def rows() -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns, strict=True)}

    return groupby(rows(), by)


# --- blocks -------------------------------------------------------------------------


def blocks(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Documents (doc_id, train, text) as blocks."""

    def block_row(number: int, ids: list, trains: list, parts: list[np.ndarray]) -> pa.RecordBatch:
        words, at, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")  # frequent words get small numbers
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        held = [{"doc_id": i, "n": len(p), "train": t} for i, t, p in zip(ids, trains, parts, strict=True)]
        return row(block=number, kind=STATE, keys=words[order].tobytes(), vals=packed(rank[at]), docs=held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, trains, parts, tokens = [], [], [], 0
        for batch in batches:
            doc_ids, train = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, end, data, at in flat.chunks(batch):
                low = flat.lower_ascii(data)
                starts, ends, begin = flat.find_words(low, at)
                hashes = flat.hash_words(low, starts, ends)
                for i in range(end - first):
                    parts.append(np.append(hashes[begin[i] : begin[i + 1]], END))
                    tokens += len(parts[-1])
                ids += doc_ids[first:end]
                trains += train[first:end]
                if tokens >= block_tokens:
                    yield block_row(number, ids, trains, parts)
                    number, ids, trains, parts, tokens = number + 1, [], [], [], 0
        if ids:
            yield block_row(number, ids, trains, parts)

    return docs.select("doc_id", "train", "text").mapInArrow(run, ROWS)


class Grams:
    """The distinct n-grams of one size in a block that may occur twice in the corpus."""

    def __init__(self, keys: np.ndarray, at: np.ndarray):
        # Sorted; per word the number of the n-gram that ends there, or -1: the last one, that is no n-gram.
        self.keys, self.at = keys, at
        # Answers of the corpus: occurrences, whether this block enters it, and what a state's counts keep.
        self.counts = np.zeros(len(keys) + 1, np.int64)
        self.first = np.zeros(len(keys), bool)
        self.kept = np.zeros(len(keys) + 1, np.int64)


class Block:
    """One block, with what the corpus has answered so far."""

    def __init__(self, state: dict, bits: int, n: int, v: int):
        self.number, self.bits, self.n, self.v = state["block"], bits, n, v
        self.docs = state["docs"]
        lengths = np.array([d["n"] for d in self.docs], np.int64)
        self.starts = np.r_[0, np.cumsum(lengths)[:-1]]
        size = int(lengths.sum())
        self.place = np.arange(size, dtype=np.int32) - np.repeat(self.starts.astype(np.int32), lengths)
        self.train = np.repeat(np.array([d["train"] for d in self.docs], bool), lengths)
        words, ids = np.frombuffer(state["keys"], np.uint64), unpacked(state["vals"])
        order = np.argsort(words)
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order), dtype=np.int32)
        self.hashes = words[ids]
        self.grams = {1: Grams(words[order], number[ids])}

    def answer(self, kind: int, size: int, rows: list[dict]) -> None:
        """Take in the answers to an earlier round, which come in the order of the keys."""
        gram = self.gram(size)
        values = np.concatenate([unpacked(r["vals"]) for r in rows])
        if kind == COUNT:
            gram.counts[:-1] = values
            gram.first = np.concatenate([unpacked(r["keys"]) for r in rows]).astype(bool)
        else:
            gram.kept[self.contexts(size)] = values

    def gram(self, size: int) -> Grams:
        if size not in self.grams:
            below = self.gram(size - 1)
            twice = (below.counts >= 2)[below.at]
            ends = np.flatnonzero(twice[1:] & twice[:-1] & (self.place[1:] >= size - 1)) + 1
            hashes = flat.mix(below.keys[below.at[ends - 1]] * _STEP + self.hashes[ends]) >> np.uint64(64 - self.bits)
            keys, at = np.unique(hashes, return_inverse=True)
            place = np.full(len(twice), -1, np.int32)
            place[ends] = at
            self.grams[size] = Grams(keys, place)
        return self.grams[size]

    def contexts(self, size: int) -> np.ndarray:
        """Numbers of the n-grams that are contexts here and occur twice in the corpus."""
        gram = self.gram(size)
        used = np.zeros(len(gram.keys) + 1, bool)
        used[gram.at[:-1][self.place[1:] >= size]] = True
        return np.flatnonzero(used[:-1] & (gram.counts[:-1] >= 2))

    def base(self) -> np.ndarray:
        gram = self.gram(1)
        return ((gram.counts + 0.5) / (self.n + 0.5 * (self.v + 1)))[gram.at]

    def chances(self, depth: int) -> np.ndarray:
        """P of every word after its longest retained context of at most ``depth`` words."""
        p = self.base()
        for size in range(1, depth + 1):
            gram, longer = self.gram(size), self.gram(size + 1)
            ends = np.flatnonzero((gram.kept > 0)[gram.at[:-1]] & (self.place[1:] >= size)) + 1
            before = gram.at[ends - 1]
            times, less = gram.counts[before], gram.kept[before]
            own = np.maximum(longer.counts[longer.at[ends]] - 1, 0)
            p[ends] = (own + (times - less) * p[ends]) / times
        return p

    def ask_counts(self, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
        gram = self.gram(size)
        return gram.keys, [np.bincount(gram.at[self.train] + 1, minlength=len(gram.keys) + 1)[1:]]

    def ask_states(self, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """Per context: how often it occurs, and of the words after it that this block is the
        first to hold: counts less one, counts, and counts times their log ratio to the shorter context."""
        gram, longer = self.gram(size), self.gram(size + 1)
        chosen = self.contexts(size)
        ends = np.flatnonzero(longer.at >= 0)
        one = np.zeros(len(longer.keys), np.int64)  # a word where each n-gram ends
        one[longer.at[ends]] = ends
        mine = np.flatnonzero(longer.first & (longer.counts[:-1] >= 2))
        ends, times = one[mine], longer.counts[mine]
        ratio = times * np.log((times - 1) / self.chances(size - 1)[ends])
        context = gram.at[ends - 1]
        sums = [np.bincount(context, weights, minlength=len(gram.keys))[chosen] for weights in (times - 1, times, ratio)]
        return gram.keys[chosen], [gram.counts[chosen], *[c.astype(np.int64) for c in sums[:2]], sums[2].astype(np.float32)]


def of_blocks(table: DataFrame, fn: Callable[[Block], Iterator[pa.RecordBatch]], schema: str, *sizes: int) -> DataFrame:
    """``fn`` of every block, with the answers in ``table`` taken in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, lambda r: r["block"]):
            block = None
            for (kind, size), part in groupby(rows, lambda r: (r["kind"], r["size"])):
                if kind == STATE:
                    block = Block(next(part), *sizes)
                else:
                    block.answer(kind, size, list(part))
            yield from fn(block)

    # The block itself sorts first, then the answers in the order they were asked.
    dealt = table.repartition("block").sortWithinPartitions("block", "size", "kind", "span")
    return dealt.mapInArrow(run, schema)


# --- the rounds ---------------------------------------------------------------------


def added(rows: list[dict]) -> Iterator[dict]:
    """Totals of one range of keys, for each block in the order of its own keys."""
    keys = [unpacked_keys(r["keys"]) for r in rows]
    sizes = [len(k) for k in keys]
    ends = np.cumsum(sizes)
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    del keys
    values = [separated(r["vals"]) for r in rows]
    column = [np.concatenate([v[i] for v in values]) for i in range(len(values[0]))]
    if rows[0]["kind"] == COUNT:
        total = np.bincount(at, column[0], minlength=len(distinct)).astype(np.int64)
        # The first block that learned it enters an n-gram into its context.
        holders = np.flatnonzero(column[0] > 0)
        _, met = np.unique(at[holders], return_index=True)
        first = np.zeros(len(at), np.uint8)
        first[holders[met]] = 1
        answers = total[at]
        totals = {"n": int(total.sum()), "v": int((total > 0).sum())}
    else:
        times = np.zeros(len(distinct))
        times[at] = column[0]
        less, many, ratio = (np.bincount(at, c, minlength=len(distinct)) for c in column[1:])
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = less / times * (ratio - many * np.log(less)) + (times - many) * np.log((times - less) / times)
        answers = np.where((less > 0) & (gain >= DIVERGENCE), less, 0).astype(np.int64)[at]
        first, totals = None, {}
    for r, size, end in zip(rows, sizes, ends, strict=True):
        out = {"vals": packed(answers[end - size : end])}
        if first is not None:
            out["keys"] = packed(first[end - size : end])
        yield {"block": r["block"], "kind": r["kind"], "size": r["size"], "span": r["span"], **out, **totals}
        totals = {}


def asked(table: DataFrame, questions: list[tuple[int, int]], ranges: int, *sizes: int) -> DataFrame:
    """The answers of the corpus to the questions (kind, size) of all blocks."""

    def ask(block: Block) -> Iterator[pa.RecordBatch]:
        for kind, size in questions:
            keys, columns = block.ask_counts(size) if kind == COUNT else block.ask_states(size)
            shift = np.uint64((64 if size == 1 else block.bits) - ranges.bit_length() + 1)
            cuts = np.searchsorted(keys >> shift, np.arange(ranges + 1, dtype=np.uint64))
            for span in np.flatnonzero(np.diff(cuts)):
                part = slice(cuts[span], cuts[span + 1])
                yield row(block=block.number, kind=kind, size=size, span=int(span), keys=packed_keys(keys[part]), vals=joined([c[part] for c in columns]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, lambda r: (r["kind"], r["size"], r["span"])):
            for answer in added(list(rows)):
                yield row(**answer)

    questions_asked = of_blocks(table, ask, ROWS, *sizes)
    dealt = questions_asked.repartition("kind", "size", "span").sortWithinPartitions("kind", "size", "span", "block")
    return stored(dealt.mapInArrow(add, ROWS), "answers")


RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def scored(docs: DataFrame, train: Column, depth: int = DEPTH, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row; the
    tree is learned from the rows where ``train`` holds."""
    chosen = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"),
        F.col("text").cast("string").alias("text"),
    )
    state = stored(blocks(chosen, block_tokens), "blocks")
    tokens = state.select(F.explode("docs.n").alias("n")).agg(F.sum("n").alias("n")).first().n or 0
    ranges = max(LEAST_RANGES, 1 << (-(-tokens // RANGE_TOKENS)).bit_length())
    bits = min(64, tokens.bit_length() + SPARE_BITS)
    words = asked(state, [(COUNT, 1)], ranges, bits, 0, 0)
    total = words.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = total.n or 0, total.v or 0
    table = state.unionByName(words)
    for size in range(2, depth + 3):
        questions = [(COUNT, size)] if size <= depth + 1 else []
        if size >= 3:
            questions.append((STATES, size - 2))
        table = table.unionByName(asked(table, questions, ranges, bits, n, v))

    def score(block: Block) -> Iterator[pa.RecordBatch]:
        gram = block.gram(1)
        known = (gram.counts > 0)[gram.at]
        sums = [np.add.reduceat(x, block.starts) for x in (known.astype(np.int64), np.log10(block.base()), np.log10(block.chances(depth)))]
        columns = [[d["doc_id"] for d in block.docs], [not d["train"] for d in block.docs], [d["n"] for d in block.docs], *sums]
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[p.split(" ")[0] for p in RESULT.split(", ")])

    out = stored(of_blocks(table, score, RESULT, bits, n, v), "scores")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score")


def score_documents(docs: DataFrame) -> DataFrame:
    """Learned from the documents whose doc_id has a checksum other than 1 modulo 5."""
    remainder = F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary")) % 5
    return scored(docs, remainder != 1)
