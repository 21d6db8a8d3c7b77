"""Suffix-tree scores against a tree of dictionaries."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from coinsieve.llm import suffixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
END = object()


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(lower), END]


class Tree:
    """The same model, whole in memory."""

    def __init__(self, texts, depth):
        self.depth = depth
        self.after = defaultdict(Counter)
        for text in texts:
            t = tokens(text)
            for i, word in enumerate(t):
                for size in range(min(depth, i) + 1):
                    self.after[tuple(t[i - size : i])][word] += 1
        self.n, self.v = sum(self.after[()].values()), len(self.after[()])
        self.states = set()
        for size in range(1, depth + 1):
            found = {s for s in self.after if len(s) == size and self.gain(s) >= suffixes.DIVERGENCE}
            self.states |= found

    def base(self, word):
        return (self.after[()][word] + 0.5) / (self.n + 0.5 * (self.v + 1))

    def longest(self, context):
        for size in range(min(self.depth, len(context)), 0, -1):
            if tuple(context[-size:]) in self.states:
                return tuple(context[-size:])
        return ()

    def chance(self, word, state):
        if not state:
            return self.base(word)
        counts = self.after[state]
        shorter = self.chance(word, self.longest(state[1:]))
        return (max(counts.get(word, 0) - 1, 0) + len(counts) * shorter) / sum(counts.values())

    def gain(self, state):
        """The bound of the docstring."""
        counts = self.after[state]
        n, t = sum(counts.values()), len(counts)
        m, many = n - t, {w: c for w, c in counts.items() if c > 1}
        if not m:
            return 0
        ratio = sum(c * math.log((c - 1) / self.chance(w, self.longest(state[1:]))) for w, c in many.items())
        times = sum(many.values())
        return m / n * (ratio - times * math.log(m)) + (n - times) * math.log(t / n)

    def score(self, text):
        t = tokens(text)
        return sum(math.log10(self.chance(w, self.longest(t[max(0, i - self.depth) : i]))) for i, w in enumerate(t))


def corpus(seed, n=300):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)] + ["The", "the", "of", "é"]
    passages = [[draw.choice(vocabulary) for _ in range(12)] for _ in range(6)]
    rows = []
    for i in range(n):
        words = [draw.choice(vocabulary[-4:] if draw.random() < 0.4 else vocabulary) for _ in range(draw.randint(0, 25))]
        if draw.random() < 0.5:
            words[3:3] = draw.choice(passages)
        rows.append((i, draw.choice(["  ", " ", "\n"]).join(words)))
    return rows + [(n + i, rows[draw.randrange(n)][1]) for i in range(40)]


def learned(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 != 1


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1.5) for r in rows], "doc_id bigint, text string, train string, score double")


@pytest.mark.parametrize("block", [60, 1 << 20])
def test_scores_equal_whole_tree(spark, block):
    rows = corpus(1) + [(9000, None), (9001, ""), (9002, " \n"), (None, "the of w1 w2"), (9003, "unseen words Only"), (5, corpus(1)[5][1]), (9004, "w1 the " * 900)]
    docs = frame(spark, rows).repartition(3)
    made = suffixes.scored(docs, suffixes.F.crc32(suffixes.F.col("doc_id").cast("string").cast("binary")) % 5 != 1, block_tokens=block)
    tree = Tree([t for i, t in rows if learned(i)], suffixes.DEPTH)
    assert any(len(s) == 3 for s in tree.states) and any(len(s) == 1 for s in tree.states)
    got = sorted(map(tuple, made.collect()), key=str)
    want = []
    for doc_id, text in rows:
        t = tokens(text)
        known = sum(tree.after[()][w] > 0 for w in t)
        want.append((doc_id, not learned(doc_id), len(t), known, tree.n, sum(math.log10(tree.base(w)) for w in t), tree.score(text)))
    want.sort(key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


def test_distributions_add_up_to_one():
    tree = Tree([t for _, t in corpus(2)], 3)
    for state in [(), *sorted((s for s in tree.states), key=str)[:60]]:
        total = sum(tree.chance(w, state) for w in tree.after[()]) + tree.chance("never seen", state)
        assert total == pytest.approx(1)


def test_held_out_texts_score_better_than_the_base(spark):
    got = suffixes.score_documents(frame(spark, corpus(3, 600))).filter("held_out").collect()
    assert len(got) > 80
    assert sum(r.score for r in got) > 0.9 * sum(r.base_score for r in got)


def test_tables_without_training_rows(spark):
    assert suffixes.score_documents(frame(spark, [(1, "a")]).limit(0)).count() == 0
    only = suffixes.score_documents(frame(spark, [(None, "a b a b"), (None, None)])).collect()
    assert sorted(map(tuple, only), key=str) == [(None, True, 1, 0, 0, 0.0, 0.0), (None, True, 5, 0, 0, 0.0, 0.0)]


def test_packed_arrays_round_trip():
    draw = np.random.default_rng(1)
    keys = np.unique(draw.integers(0, 1 << 63, 1000, np.uint64) * np.uint64(2))
    for part in (keys, keys[:1], np.array([0], np.uint64), np.array([0, 1, 2**64 - 1], np.uint64)):
        assert (suffixes.unpacked_keys(suffixes.packed_keys(part)) == part).all()
    for values in (np.arange(300), np.zeros(0, np.int64), np.array([0.5, -3.0]), np.array([2**40])):
        assert (suffixes.unpacked(suffixes.packed(values)) == values).all()
    for columns in ([values], [np.arange(5), np.array([2**50]), np.array([0.25], np.float32)]):
        assert all((a == b).all() for a, b in zip(suffixes.separated(suffixes.joined(columns)), columns, strict=True))
