"""Text similarity and the lossless pre-filter that goes with it.

Two scores from 0 to 100 compare the shorter text with windows of the longer:

* ``edit``  - Levenshtein over windows of length L-1, L and L+1, in Catalyst;
* ``ratio`` - matching-block ratio, in an Arrow function.

A score of at least T leaves room for few errors only. Cutting the shorter text
into one piece more than that leaves one piece intact inside the longer text,
so a pair without a shared piece can be dropped without scoring it.

For the ratio there are stronger tests: so few errors leave most letters and several pairs of
neighbouring letters of the shorter text intact, and they lie in one window of the longer.
"""

from __future__ import annotations

import math
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinsieve.functions.text import let

MATCHERS = ("edit", "ratio")
THRESHOLD = 80
# Below this, a text of one letter may differ in all of it: nothing could be ruled out.
LEAST_THRESHOLD = 51
SHORT_RULE = 2
SHORT_THRESHOLD = 90


def check_threshold(threshold: int) -> None:
    if not LEAST_THRESHOLD <= threshold <= 100:
        raise ValueError(f"the threshold lies between {LEAST_THRESHOLD} and 100, not at {threshold}")


def error_factor(threshold: int, matcher: str) -> tuple[float, int]:
    """(share, offset): at most floor(share * (length + offset)) errors fit."""
    share = (100.5 - threshold) / 100.0
    return (share, 1) if matcher == "edit" else (2 * share, 0)


def piece_count(length: int, threshold: int, matcher: str) -> int:
    share, offset = error_factor(threshold, matcher)
    return math.floor(share * (length + offset) + 1e-9) + 1


def pieces(text: str, threshold: int, matcher: str) -> list[str]:
    """Cut a text so that one piece survives every allowed set of errors."""
    n, length = piece_count(len(text), threshold, matcher), len(text)
    if n > length:
        raise ValueError(f"threshold {threshold} is too low to pre-filter texts of {length} characters")
    return [text[i * length // n:(i + 1) * length // n] for i in range(n)]


def pieces_col(text: Column, threshold: int, matcher: str) -> Column:
    """``pieces`` as an expression; NULL for an empty text."""
    share, offset = error_factor(threshold, matcher)
    length = F.length(text)
    n = F.floor(F.lit(share) * (length + offset) + 1e-9).cast("int") + 1

    def cut(i: Column) -> Column:
        start = F.floor(i * length / n).cast("int")
        stop = F.floor((i + 1) * length / n).cast("int")
        return F.substring(text, start + 1, stop - start)

    return F.when(length > 0, F.transform(F.sequence(F.lit(0), n - 1), cut))


def pairs_left(length: Column, threshold: int) -> Column:
    """How many of the pairs of neighbouring letters of a text must be found in a window
    of a longer one where their ratio reaches the threshold; not positive where none must.

    With e letters of the shorter text unmatched, and e - d of a window that is d letters
    shorter, 2 e + (e - d) pairs are lost at most: two for each of the former, one for
    each of the latter. The ratio limits e, and d is no more than e.
    """
    t = (threshold - 0.5) / 100.0
    share = (1 - t) * (3 + max(0.0, 1.5 * t - 1) / (1 - t / 2))
    return length - 1 - F.floor(share * length + 1e-9).cast("int")


def letter_pairs(text: Column) -> Column:
    """All pairs of neighbouring letters of a text of two letters or more, as often as they come."""
    return F.transform(F.sequence(F.lit(1), F.length(text) - 1), lambda i: F.substring(text, i, 2))


def _letter_counts(text: Column) -> Column:
    """(letter, n) of every letter of a text."""
    letters = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, 1)))
    return F.transform(letters, lambda c: F.struct(c.alias("letter"), _times(text, c).alias("n")))


def _times(text: Column, letter: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, letter, F.lit("")))


def _letters_held(text: Column, letters: Column) -> Column:
    """How many of the letters a text holds, each as often as it is there."""
    return F.aggregate(letters, F.lit(0), lambda sum_, c: sum_ + F.least(c["n"], _times(text, c["letter"])))


def may_reach_ratio(a: Column, b: Column, threshold: int) -> Column:
    """False only where two non-empty texts cannot reach the threshold by ratio.

    Some window of the longer text must hold enough pairs of neighbouring letters of the shorter
    one (``pairs_left``), and some window enough of its letters, windows cut off at the end included.
    """
    t = (threshold - 0.5) / 100.0
    a_first = F.length(a) <= F.length(b)
    pair = F.struct(
        F.when(a_first, a).otherwise(b).alias("short"), F.when(a_first, b).otherwise(a).alias("long"),
        F.least(F.length(a), F.length(b)).alias("size"), F.greatest(F.length(a), F.length(b)).alias("room"),
    )

    def enough_pairs(p: Column) -> Column:
        need = pairs_left(p["size"], threshold)

        # Only pairs that the whole text holds are looked for in its windows.
        def windows(pairs: Column) -> Column:
            starts = F.sequence(F.lit(1), p["room"] - p["size"] + 1)

            def held(i: Column) -> Column:
                return F.size(F.filter(pairs, lambda g: F.contains(F.substring(p["long"], i, p["size"]), g))) >= need

            return (F.size(pairs) >= need) & F.exists(starts, held)

        inside = F.filter(letter_pairs(p["short"]), lambda g: F.contains(p["long"], g))
        return F.when(need > 0, let(inside, windows)).otherwise(F.lit(True))

    def enough_letters(p: Column) -> Column:
        # A window of w letters matches w at most: 2 w >= t (size + w).
        least = F.ceil(t / (2 - t) * p["size"] - 1e-9).cast("int")
        starts = F.sequence(F.lit(1), p["room"] - least + 1)

        def windows(letters: Column) -> Column:
            def held(i: Column) -> Column:
                window = F.substring(p["long"], i, p["size"])
                return 2 * _letters_held(window, letters) >= t * (p["size"] + F.length(window)) - 1e-9

            whole = 2 * _letters_held(p["long"], letters) >= t * (p["size"] + least) - 1e-9
            return whole & F.exists(starts, held)

        return let(_letter_counts(p["short"]), windows)

    return let(pair, lambda p: enough_pairs(p) & enough_letters(p))


def required_score(rule: Column, threshold: int) -> Column:
    return F.when(
        F.length(rule) <= SHORT_RULE, F.lit(max(threshold, SHORT_THRESHOLD))
    ).otherwise(F.lit(threshold))


def partial_edit_score(a: Column, b: Column) -> Column:
    """Best window score in integer arithmetic; 0 when either text is empty."""
    a_first = F.length(a) <= F.length(b)
    pair = F.struct(
        F.when(a_first, a).otherwise(b).alias("short"),
        F.when(a_first, b).otherwise(a).alias("long"),
        F.least(F.length(a), F.length(b)).alias("size"),
        F.greatest(F.length(a), F.length(b)).alias("room"),
    )

    def best(p: Column, width: Column) -> Column:
        distances = F.transform(
            F.sequence(F.lit(1), p["room"] - width + 1),
            lambda i: F.levenshtein(p["short"], F.substring(p["long"], i, width)),
        )
        scale = F.greatest(p["size"], width)
        score = F.floor((200 * (scale - F.array_min(distances)) + scale) / (2 * scale)).cast("int")
        return F.when((width >= 1) & (p["room"] >= width), score)

    def scored(p: Column) -> Column:
        windows = [best(p, p["size"] + step) for step in (-1, 0, 1)]
        return F.when(p["size"] > 0, F.greatest(*windows))

    return F.coalesce(let(pair, scored), F.lit(0))


def within_edits(a: Column, b: Column, need: Column) -> Column:
    """``partial_edit_score(a, b) >= need`` for two non-empty texts.

    The score turns into a limit on the distance, so most windows are given up
    early and the first good one ends the search.
    """
    a_first = F.length(a) <= F.length(b)
    pair = F.struct(
        F.when(a_first, a).otherwise(b).alias("short"),
        F.when(a_first, b).otherwise(a).alias("long"),
        F.least(F.length(a), F.length(b)).alias("size"),
        F.greatest(F.length(a), F.length(b)).alias("room"),
        (201 - 2 * need).alias("slack"),
    )

    def found(p: Column, width: Column) -> Column:
        limit = F.floor(F.greatest(p["size"], width) * p["slack"] / 200).cast("int")
        starts = F.sequence(F.lit(1), p["room"] - width + 1)
        near = let(
            limit,
            lambda most: F.exists(
                starts,
                lambda i: F.call_function(
                    "levenshtein", p["short"], F.substring(p["long"], i, width), most
                ) >= 0,
            ),
        )
        return (width >= 1) & (p["room"] >= width) & near

    return let(pair, lambda p: found(p, p["size"]) | found(p, p["size"] + 1) | found(p, p["size"] - 1))


def ratio_bound(a: str, b: str) -> int:
    """No alignment can score more than this: shared letters, well placed."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    shared = sum(min(short.count(c), long.count(c)) for c in set(short))
    return math.floor(200 * shared / (len(short) + shared) + 0.5) if shared else 0


def block_ratio(a: str, b: str) -> int:
    """Matching-block partial ratio of two texts, 0 to 100."""
    if not a or not b:
        return 0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    best = 0.0
    for block in SequenceMatcher(None, short, long).get_matching_blocks():
        start = max(block.b - block.a, 0)
        best = max(best, SequenceMatcher(None, short, long[start:start + len(short)]).ratio())
        if best > 0.995:
            return 100
    return round(100 * best)


@F.pandas_udf(T.IntegerType())
def partial_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([block_ratio(x or "", y or "") for x, y in zip(a, b)], dtype="int32")


@F.pandas_udf(T.BooleanType())
def within_ratio(a: pd.Series, b: pd.Series, need: pd.Series) -> pd.Series:
    """``block_ratio(a, b) >= need``, aligned only where the letters allow it."""
    return pd.Series(
        [n <= 0 or (ratio_bound(x, y) >= n and block_ratio(x, y) >= n) for x, y, n in zip(a, b, need)],
        dtype="bool",
    )


def partial_score(a: Column, b: Column, matcher: str) -> Column:
    if matcher not in MATCHERS:
        raise ValueError(f"matcher must be one of {MATCHERS}")
    return partial_edit_score(a, b) if matcher == "edit" else partial_ratio(a, b)


def reaches(a: Column, b: Column, need: Column, matcher: str) -> Column:
    """Whether two non-empty texts score at least ``need``; any pair reaches 0."""
    if matcher not in MATCHERS:
        raise ValueError(f"matcher must be one of {MATCHERS}")
    return (need <= 0) | within_edits(a, b, need) if matcher == "edit" else within_ratio(a, b, need)


def fuzzy_match(rule: Column, text: Column, threshold: int = THRESHOLD, matcher: str = "edit") -> Column:
    """Containment, or similarity at the threshold; an empty side never matches.

    Both sides are expected lower-cased and stripped.
    """
    return (
        F.when((rule == "") | (text == ""), F.lit(False))
        .when(F.contains(text, rule), F.lit(True))
        .otherwise(partial_score(rule, text, matcher) >= required_score(rule, threshold))
    )
