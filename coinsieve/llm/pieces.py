"""Subword encoding and decoding with a SentencePiece BPE model.

The model file is read for its pieces and scores only. Texts are encoded by
merge rounds over flat numpy arrays: the symbols of all words lie in one array,
a segmented minimum finds each word's best pair, all leftmost occurrences of it
merge at once, and the array is compacted, until no word has a pair left.

Cases: a null or empty text has no symbols, so its only id is the end id and it
decodes to ''. Characters without a piece become byte pieces. Repeated rows are
encoded like any other row; other columns pass through or are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
# Words whose pieces a worker remembers; then it starts again with none.
REMEMBERED_WORDS = 600_000
# New words merged in one call.
WORDS_PER_CALL = 50_000
NO_PAIR = 1 << 62
# Hashing of the pair table.
SLOT_BITS = 20
SPREAD_TRIES = 1000
SPREAD, SPREAD_2 = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)

RESULT = (
    "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
)


class PieceTable:
    """Pieces, ranks and the pair table of one model, as arrays.

    A pair is known by the two symbols it joins, so every way to cut a piece
    into two symbols has an entry. Symbols are pieces and single characters
    (also those that occur only inside pieces).
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end_id = model.eos_id()
        count = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(count)]
        plain = [
            i for i in range(count)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.symbol = {self.text[i]: i for i in plain}
        self.byte_id = {int(self.text[i][3:5], 16): i for i in range(count) if model.is_byte(i)}
        if len(self.byte_id) != 256:
            raise ValueError("the model has no byte pieces")
        if any(SPACE in self.text[i].lstrip(SPACE) for i in plain):
            raise ValueError("a piece holds a space after other characters")
        self.pieces = count
        known = dict(self.symbol)
        for i in plain:
            for c in self.text[i]:
                known.setdefault(c, len(known) + count)
        self.known = known
        self.loose = {v: k for k, v in known.items() if v >= count}
        # Other characters get the number base + code point, which pairs with nothing.
        self.base = max(known.values()) + 1
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.shown = [t.replace(SPACE, " ") for t in self.text]
        self.shown[self.end_id] = ""
        scores = sorted({-model.get_score(i) for i in plain})
        place = {s: r for r, s in enumerate(scores)}
        rank = {i: place[-model.get_score(i)] for i in plain}
        entries = {}
        for i in plain:
            whole = self.text[i]
            for cut in range(1, len(whole)):
                a, b = known.get(whole[:cut]), known.get(whole[cut:])
                if a is not None and b is not None:
                    entries[a * self.base + b] = (rank[i], i)
        self.entries = entries
        keys = sorted(entries)
        self.keys = np.array(keys, np.int64)
        self.ranks = np.array([entries[k][0] for k in keys], np.int64)
        self.made = np.array([entries[k][1] for k in keys], np.int64)
        # Two hashed tables hold the places of all keys: the second those that collide
        # in the first, under the first multiplier that separates them.
        all_keys, places = self.keys.view(np.uint64), np.arange(len(keys))
        self.slots, self.spare = np.zeros((2, 1 << SLOT_BITS), np.int64)
        slot = (all_keys * SPREAD) >> np.uint64(64 - SLOT_BITS)
        self.slots[slot] = places
        rest = places[self.slots[slot] != places]
        for self.spread in np.arange(1, 2 * SPREAD_TRIES, 2, np.uint64) * SPREAD_2:
            slot = (all_keys[rest] * self.spread) >> np.uint64(64 - SLOT_BITS)
            self.spare[slot] = rest
            if (self.spare[slot] == rest).all():
                break
        else:
            raise ValueError("the pair table needs more slots")
        # A merge may bring forth a pair that is as good or better. Then the other
        # occurrences of the first pair have to wait: such words go one by one.
        wary = np.zeros(count, bool)
        for k in keys:
            r = entries[k][0]
            for part in (k // self.base, k % self.base):
                if part in rank and r <= rank[part]:
                    wary[part] = True
        self.wary = wary

    def lookup(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, place in the table) of each pair; rank NO_PAIR if it is none."""
        key = np.where((a < self.base) & (b < self.base), a * self.base + b, -1)
        place = self.slots[(key.view(np.uint64) * SPREAD) >> np.uint64(64 - SLOT_BITS)]
        again = np.flatnonzero(self.keys[place] != key)
        second = self.spare[(key[again].view(np.uint64) * self.spread) >> np.uint64(64 - SLOT_BITS)]
        place[again] = second
        return np.where(self.keys[place] == key, self.ranks[place], NO_PAIR), place


def merge_one_by_one(table: PieceTable, symbols: list[int]) -> list[int]:
    """Best pair first, leftmost among equals: for the words that need that order."""
    left = list(range(-1, len(symbols) - 1))
    right = [*range(1, len(symbols)), -1]
    def entry(a: int, b: int) -> tuple[int, int] | None:
        if a >= table.base or b >= table.base:
            return None
        return table.entries.get(a * table.base + b)

    heap: list[tuple[int, int, int, int, int]] = []

    def offer(i: int) -> None:
        j = right[i] if i >= 0 else -1
        if j >= 0 and (e := entry(symbols[i], symbols[j])):
            heapq.heappush(heap, (e[0], i, symbols[i], symbols[j], e[1]))

    for i in range(len(symbols)):
        offer(i)
    while heap:
        _, i, a, b, whole = heapq.heappop(heap)
        j = right[i] if symbols[i] == a else -1
        if j < 0 or symbols[j] != b:
            continue
        symbols[i], symbols[j] = whole, -1
        right[i] = right[j]
        if right[j] >= 0:
            left[right[j]] = i
        offer(left[i])
        offer(i)
    return [s for s in symbols if s >= 0]


def merge_words(table: PieceTable, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets): the piece ids of all words in one array, and where each word's start."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    used, place = np.unique(points, return_inverse=True)
    numbers = np.array([table.known.get(chr(p), table.base + p) for p in used], np.int64)
    symbol = numbers[place]
    word = np.repeat(np.arange(len(words)), [len(w) for w in words])
    done: list[tuple[np.ndarray, np.ndarray]] = []

    while len(symbol):
        rank = np.full(len(symbol), NO_PAIR, np.int64)
        found, place = table.lookup(symbol[:-1], symbol[1:])
        rank[:-1] = np.where(word[:-1] == word[1:], found, NO_PAIR)
        heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        sizes = np.diff(np.r_[heads, len(word)])
        best = np.repeat(np.minimum.reduceat(rank, heads), sizes)
        over = best == NO_PAIR
        at = np.flatnonzero((rank == best) & ~over)
        made = table.made[place[at]]
        # Words with several occurrences of a pair whose order matters go one by one.
        touched = word[at]
        twice = np.r_[False, touched[1:] == touched[:-1]]
        slow = np.unique(touched[twice & table.wary[made]])
        if len(slow):
            apart = np.isin(word, slow)
            cut = np.flatnonzero(np.diff(word[apart])) + 1
            for part, which in zip(np.split(symbol[apart], cut), slow, strict=True):
                merged = np.array(merge_one_by_one(table, part.tolist()), np.int64)
                done.append((np.full(len(merged), which), merged))
            keep = ~apart[at]
            at, made = at[keep], made[keep]
        if over.any():
            done.append((word[over], symbol[over]))
        # Of touching occurrences (a, a, a) every second one merges, from the left.
        if len(at):
            step = np.r_[True, np.diff(at) != 1]
            offset = np.arange(len(at)) - np.flatnonzero(step)[np.cumsum(step) - 1]
            at, made = at[offset % 2 == 0], made[offset % 2 == 0]
            symbol[at] = made
        # Compaction: merged right halves and finished words leave the arrays.
        keep = ~over
        if len(slow):
            keep &= ~apart
        keep[at + 1] = False
        symbol, word = symbol[keep], word[keep]

    if not done:
        return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
    word = np.concatenate([d[0] for d in done])
    symbol = np.concatenate([d[1] for d in done])
    order = np.argsort(word, kind="stable")
    word, ids = to_bytes(table, word[order], symbol[order])
    return ids, np.searchsorted(word, np.arange(len(words) + 1))


def to_bytes(table: PieceTable, word: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols that are no pieces become their UTF-8 byte pieces."""
    odd = np.flatnonzero(symbol >= table.pieces)
    if not len(odd):
        return word, symbol
    kinds, which = np.unique(symbol[odd], return_inverse=True)
    spelt = [
        [table.byte_id[b] for b in (table.loose.get(int(k)) or chr(int(k) - table.base)).encode()]
        for k in kinds
    ]
    sizes = np.ones(len(symbol), np.int64)
    sizes[odd] = np.array([len(x) for x in spelt])[which]
    ids = np.repeat(symbol, sizes)
    starts = np.cumsum(sizes) - sizes
    for k, x in enumerate(spelt):
        first = starts[odd[which == k]]
        for j, value in enumerate(x):
            ids[first + j] = value
    return np.repeat(word, sizes), ids


class Words(dict):
    """word -> [ids joined by spaces, its text]. A word not met before gets an
    empty entry at its first lookup and is noted in ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> list:
        self.new.append(word)
        entry = self[word] = [None, None]
        return entry


class Codec:
    """Encodes batches of texts; remembers the pieces of words.

    A word is cut before each space that follows something else: no piece reaches
    over such a place. Words with one leading space are kept without it.
    """

    def __init__(self, path: str):
        self.table = PieceTable(path)
        self.cut = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+", re.DOTALL)
        self.words, self.spaced = Words(), Words()
        self.digits = [str(i) for i in range(self.table.pieces)]
        self.digit_sizes = np.array([len(d) for d in self.digits])
        self.shown_sizes = np.array([len(t) for t in self.table.shown])

    def decode(self, ids: list[int]) -> str:
        """The text of ids, spaces as spaces, nothing cut at the start."""
        out = bytearray()
        for i in ids:
            if i in self.table.byte_of:
                out.append(self.table.byte_of[i])
            else:
                out += self.table.shown[i].encode()
        return out.decode("utf-8", "replace")

    def learn(self, known: Words, lead: str = "") -> None:
        """Fill the entries of the new words."""
        new, known.new = known.new, []
        digits, shown = self.digits, self.table.shown
        low, high = min(self.table.byte_of), max(self.table.byte_of)
        for i in range(0, len(new), WORDS_PER_CALL):
            part = new[i : i + WORDS_PER_CALL]
            ids, at = merge_words(self.table, [lead + w for w in part] if lead else part)
            flat = ids.tolist()
            # One long string of numbers and one of pieces; each word is a slice of both.
            numbers = " ".join([digits[k] for k in flat])
            pieces = "".join([shown[k] for k in flat])
            to_number = np.r_[0, np.cumsum(self.digit_sizes[ids] + 1)]
            to_piece = np.r_[0, np.cumsum(self.shown_sizes[ids])]
            spans = zip(
                part, to_number[at[:-1]].tolist(), (to_number[at[1:]] - 1).tolist(),
                to_piece[at[:-1]].tolist(), to_piece[at[1:]].tolist(), strict=True,
            )
            for w, a, b, c, d in spans:
                known[w][:] = numbers[a:b], pieces[c:d]
            byte = np.r_[0, np.cumsum((ids >= low) & (ids <= high))]
            for j in np.flatnonzero(byte[at[1:]] > byte[at[:-1]]).tolist():
                known[part[j]][1] = self.decode(flat[at[j] : at[j + 1]])

    def encode(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """(number of ids, the ids joined by spaces, decoded text) per text."""
        if len(self.words) + len(self.spaced) > REMEMBERED_WORDS:
            self.words, self.spaced = Words(), Words()
        cut = []
        for t in texts:
            if not t:
                cut.append([])
            elif "  " in t or SPACE in t or t[0] == " " or t[-1] == " ":
                cut.append([*map(self.words.__getitem__, self.cut.findall(SPACE + t.replace(" ", SPACE)))])
            else:
                cut.append([*map(self.spaced.__getitem__, t.split(" "))])
        self.learn(self.words)
        self.learn(self.spaced, SPACE)
        end = self.digits[self.table.end_id]
        for entries in cut:
            if not entries:
                yield 1, end, ""
                continue
            ids, shown = zip(*entries, strict=True)
            joined = " ".join(ids)
            yield joined.count(" ") + 2, f"{joined} {end}", "".join(shown)[1:]


def per_codec(path: str, size: int, row: Callable) -> Callable:
    """mapInArrow function: ``row(doc_id, count, ids, decoded)`` for each document.

    Texts are taken in parts of about ``size`` characters, so memory follows
    that size and the longest document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            start = 0
            while start < len(ids):
                part, held = [], 0
                while start + len(part) < len(ids) and (not part or held < size):
                    part.append(texts[start + len(part)].as_py())
                    held += len(part[-1] or "")
                rows = [
                    row(doc_id, *made)
                    for doc_id, made in zip(ids[start : start + len(part)], codec.encode(part), strict=True)
                ]
                start += len(part)
                yield rows

    return run


def encode_documents(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: number of ids, digests of ids and decoded text;
    with ``with_ids`` also the ids and the decoded text themselves."""
    schema = RESULT + (", ids array<int>, decoded string" if with_ids else "")

    def row(doc_id, count, joined, decoded):
        made = (
            doc_id, count,
            hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(),
        )
        return (*made, [int(i) for i in joined.split(" ")], decoded) if with_ids else made

    rows = per_codec(path, 1 << 21, row)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if with_ids else [])]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), *([pa.list_(pa.int32()), pa.string()] if with_ids else [])]
    arrow = pa.schema(list(zip(names, types, strict=True)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in rows(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], schema=arrow
            )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(encode, schema)
