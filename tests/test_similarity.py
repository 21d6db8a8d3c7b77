"""Scores against plain loops, and the pre-filter against all pairs."""

import difflib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from coinsieve.functions.similarity import (
    block_ratio, fuzzy_match, may_reach_ratio, pairs_left, partial_edit_score, partial_ratio, piece_count, pieces, pieces_col,
    required_score, within_edits,
)

from coinsieve.operators.match import _ratio_candidates


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def edit_score(a, b):
    s, t = (a, b) if len(a) <= len(b) else (b, a)
    if not s:
        return 0
    best = 0
    for w in (len(s) - 1, len(s), len(s) + 1):
        if w < 1 or w > len(t):
            continue
        for i in range(len(t) - w + 1):
            m = max(len(s), w)
            best = max(best, (200 * (m - levenshtein(s, t[i:i + w])) + m) // (2 * m))
    return best


def random_words(n, seed, alphabet="abc ", longest=12):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, longest))).strip() or "a" for _ in range(n)]


@pytest.fixture(scope="module")
def pairs(spark):
    words = random_words(60, 1) + ["netflix", "netflx.com", "medium", "premium", "game", "games", "a", "ab"]
    data = [(a, b) for a, b in itertools.product(words, words)]
    return spark.createDataFrame(data, "a string, b string").cache()


def test_edit_score_equals_plain_loop(pairs):
    for r in pairs.withColumn("s", partial_edit_score(F.col("a"), F.col("b"))).collect():
        assert r.s == edit_score(r.a, r.b), r


@pytest.mark.parametrize("need", [60, 80, 90, 100])
def test_within_edits_equals_score_at_threshold(pairs, need):
    got = pairs.withColumn("hit", within_edits(F.col("a"), F.col("b"), F.lit(need)))
    for r in got.collect():
        assert r.hit == (edit_score(r.a, r.b) >= need), r


def test_ratio_function_equals_plain_calls(pairs):
    for r in pairs.withColumn("s", partial_ratio("a", "b")).collect():
        assert r.s == block_ratio(r.a, r.b)


def test_ratio_known_values():
    assert block_ratio("netflix", "netflx.com") == 86
    assert block_ratio("premium", "medium") == 80
    assert block_ratio("game", "games") == block_ratio("games", "game") == 100
    assert block_ratio("", "x") == 0


def test_ratio_of_equal_lengths_is_the_block_ratio_or_better():
    for a, b in [("abcd", "abxd"), ("kitten", "sittin")]:
        assert block_ratio(a, b) >= round(100 * difflib.SequenceMatcher(None, a, b).ratio())


@pytest.mark.parametrize("matcher, score", [("edit", edit_score), ("ratio", block_ratio)])
@pytest.mark.parametrize("threshold", [70, 80, 90])
def test_no_matching_pair_lacks_a_shared_piece(matcher, score, threshold):
    words = random_words(250, 7, "abcd", 14)
    hits = 0
    for a, b in itertools.combinations(words, 2):
        s, t = (a, b) if len(a) <= len(b) else (b, a)
        if score(s, t) >= threshold and piece_count(len(s), threshold, matcher) <= len(s):
            hits += 1
            assert any(p in t for p in pieces(s, threshold, matcher)), (s, t)
    assert hits > 20


@pytest.mark.parametrize("matcher", ["edit", "ratio"])
def test_piece_column_equals_piece_list(spark, matcher):
    words = random_words(80, 3, "abcdefgh", 30)
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for r in df.withColumn("p", pieces_col(F.col("w"), 80, matcher)).collect():
        assert r.p == pieces(r.w, 80, matcher)
        assert "".join(r.p) == r.w


def test_too_low_threshold_is_refused():
    with pytest.raises(ValueError):
        pieces("abc", 10, "ratio")


def test_empty_sides_never_match(spark):
    df = spark.createDataFrame([("", "abc"), ("abc", ""), ("", "")], "a string, b string")
    assert [r.m for r in df.select(fuzzy_match(F.col("a"), F.col("b")).alias("m")).collect()] == [False] * 3


def test_short_rules_need_ninety(spark):
    df = spark.createDataFrame([("ab", "xaby"), ("ab", "xacy"), ("abcde", "abcxe")], "a string, b string")
    got = df.select(
        fuzzy_match(F.col("a"), F.col("b")).alias("m"), required_score(F.col("a"), 80).alias("need")
    ).collect()
    assert [(r.m, r.need) for r in got] == [(True, 90), (False, 90), (True, 80)]


@pytest.mark.parametrize("threshold", [60, 80, 90, 100])
def test_too_few_pairs_of_letters_rule_out_by_ratio(pairs, threshold):
    """Nothing that reaches the threshold is ruled out."""
    got = pairs.withColumn("may", may_reach_ratio(F.col("a"), F.col("b"), threshold)).collect()
    missed = [(r.a, r.b) for r in got if block_ratio(r.a, r.b) >= threshold and not r.may]
    assert missed == []


def test_few_pairs_of_texts_are_left_to_score(spark):
    """Of 300 texts and 80 names, below 5 % meet by rare pairs of letters, and all that match."""
    rng = random.Random(3)
    syllables = ["net", "flix", "mar", "ket", "gro", "cer", "pay", "pal", "shop", "air", "line", "cof", "fee", "bo", "ok", "sta", "tion", "ga", "me", "z"]
    names = sorted({"".join(rng.choice(syllables) for _ in range(rng.randint(2, 4))) for _ in range(80)})
    texts = [" ".join([rng.choice(names)] + [str(rng.randint(100, 9999)) for _ in range(2)]) for _ in range(300)]
    texts = [t if rng.random() < 0.5 else t[:2] + rng.choice("abcdexyz") + t[3:] for t in texts]
    text = spark.createDataFrame([(str(i), 0, t) for i, t in enumerate(texts)], "text_key string, side int, text string")
    words = spark.createDataFrame(list(enumerate(names)), "entry bigint, word string")
    met = {(int(r.text_key), r.entry) for r in _ratio_candidates(text, words, 80).collect()}
    match = {(i, j) for i, t in enumerate(texts) for j, w in enumerate(names) if block_ratio(w, t) >= 80}
    assert match <= met
    joined = spark.createDataFrame([(texts[i], names[j]) for i, j in met], "text string, word string")
    left = joined.filter(may_reach_ratio(F.col("word"), F.col("text"), 80)).count()
    assert len(match) <= left < 0.05 * len(texts) * len(names)


def test_pairs_left_bounds_every_split_of_errors(spark):
    sizes = spark.range(1, 200).select(F.col("id").cast("int").alias("n"), *[pairs_left(F.col("id").cast("int"), t).alias(f"t{t}") for t in (60, 80, 95)])
    for row in sizes.collect():
        for threshold in (60, 80, 95):
            t, most = (threshold - 0.5) / 100, 0
            for shorter in range(row.n + 1):
                errors = int(row.n - t * (2 * row.n - shorter) / 2 + 1e-9)
                if errors >= shorter:
                    most = max(most, 3 * errors - shorter)
            assert row[f"t{threshold}"] <= row.n - 1 - most
