"""Periodic runs against a search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from coinsieve.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        j = 0
        while j < n - q:
            if words[j] != words[j + q]:
                j += 1
                continue
            end = j
            while end < n - q and words[end] == words[end + q]:
                end += 1
            if end + q - j >= max(6, 4 * q):
                found.setdefault((j, end + q - j), q)
            j = end
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def repetitive(draw):
    n, letters = draw.randint(0, 300), draw.choice([1, 2, 3, 5, 50])
    words = [draw.randrange(letters) for _ in range(n)]
    for _ in range(draw.randint(0, 4) if n > 8 else 0):
        start, period = draw.randrange(n), draw.randint(1, n // 5 + 1)
        for i in range(start + period, min(n, start + draw.randint(period, n))):
            words[i] = words[i - period]
    return words


def test_runs_equal_search_over_all_periods():
    draw = random.Random(11)
    for _ in range(600):
        words = repetitive(draw)
        assert periodic.runs_of(words) == brute(words)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.lists(st.integers(1, 9), min_size=1, max_size=60))
def test_appends_of_any_size_give_the_same_runs(words, sizes):
    catcher, at = periodic.SquareCatcher(), 0
    for size in [*sizes, *[3] * 60]:
        catcher.append(np.array(words[at : at + size], np.int64))
        at += size
        assert catcher.runs() == brute(words[:at])


def test_long_texts_are_appended_in_slices(monkeypatch):
    draw = random.Random(5)
    words = [draw.randrange(10_000) for _ in range(3000)]
    words += [draw.randrange(500) for _ in range(700)] * 6 + ["x"] * 9000 + [draw.randrange(10_000) for _ in range(500)]
    whole = periodic.runs_of(words)
    assert [r[2] for r in whole] == [700, 1] and whole[1][1] == 9000
    monkeypatch.setattr(periodic, "APPEND", 100)
    assert periodic.runs_of(words) == whole


def test_equal_hashes_of_other_words_make_no_run(monkeypatch):
    monkeypatch.setattr(periodic, "_FACTOR", np.uint64(0))
    draw = random.Random(2)
    for _ in range(60):
        words = repetitive(draw)
        assert periodic.runs_of(words) == brute(words)


def digest(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, *(hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)))


def test_digests_equal_brute_force(spark):
    draw = random.Random(4)
    rows = [(i, " ".join(f"w{w}" for w in repetitive(draw))) for i in range(150)]
    rows += [(1000 + i, " ".join(draw.choice("abcdef") for _ in range(draw.randint(0, 90)))) for i in range(150)]
    rows += [(2000, None), (2001, ""), (2002, " \n\t"), (2003, "a a " * 9), (2004, "é\x0bé\x0cé é\té\né é"), (2005, "ab " * 7000)]
    rows += [(None, "x " * 30), rows[3], rows[3]]
    docs = spark.createDataFrame([(*r, 1, "no", []) for r in rows], "doc_id bigint, text string, n_words int, runs string, collapsed array<int>")
    got = sorted(map(tuple, periodic.run_digests(docs.repartition(3)).collect()), key=str)
    assert got == sorted((digest(*r) for r in rows), key=str)
    assert periodic.run_digests(docs.limit(0)).count() == 0


@pytest.mark.parametrize("text,kept", [("the the the the the the end", "the end"), ("a b a b a b a b c", "a b c"), ("a a a a a", "a a a a a")])
def test_runs_are_cut_to_their_first_period(spark, text, kept):
    row = periodic.find_runs(spark.createDataFrame([(text, 7)], "text string, other int")).first()
    assert (row.collapsed, row.other, row.n_words) == (kept, 7, len(text.split()))
    assert len(row.runs) == (text != kept)
