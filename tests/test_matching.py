"""Rule and keyword matching: brute force, and one test per known trap."""

import random

import pytest
from pyspark.sql import functions as F

from coinsieve.functions.similarity import block_ratio
from coinsieve.operators.match import match_keywords, match_keywords_exact, match_rules
from coinsieve.sources.tables import keyword_table, rules_table
from tests.test_similarity import edit_score

SCORES = {"edit": edit_score, "ratio": block_ratio}


def normalized(text):
    out = text.lower().strip()
    for noise in ("ach debit", "ach credit", "online", "payment", "*"):
        out = out.replace(noise, "")
    return " ".join(out.split())


def fuzzy(rule, text, score, threshold=80):
    rule, text = rule.lower().strip(), text.lower().strip()
    if not rule or not text:
        return False
    if rule in text:
        return True
    return score(rule, text) >= (max(threshold, 90) if len(rule) <= 2 else threshold)


def plain_keyword(text, table, score):
    norm, orig = normalized(text), text.lower()
    for category, words in table.items():
        if any(w.lower() in norm or w.lower() in orig for w in words):
            return category, "exact"
        if any(fuzzy(w, norm, score) or fuzzy(w, orig, score) for w in words):
            return category, "fuzzy"
    return None


def plain_rule(text, amount, day, rules, score):
    norm, orig = normalized(text), text.lower()
    for rule, wanted, days, category in rules:
        in_days = True if not days else day is not None and days[0] <= day <= days[1]
        if (fuzzy(rule, norm, score) or fuzzy(rule, orig, score)) and wanted in (None, amount) and in_days:
            exact = rule.lower() in norm or rule.lower() in orig
            return category, "exact" if exact else "fuzzy"
    return None


WORDS = ["netflix", "netflx", "uber *eats", "uber eats", "coffee", "cofee shop", "rent", "rest ", "the rest",
         "ONLINE payment", "medium", "premium", "gas", "ga", "monthly fee", "montly fe", "ACH debit zelle ", "x"]
TABLE = {
    "Fun": ["netflix", "medium", "game"], "Food": ["uber *eats", "rest ", "coffee"],
    "Subs": ["premium", "monthly fee"], "Home": ["rent", "zelle"], "Car": ["ga"],
}
RULES = [
    ("Coffee", None, [1, 10], "Early"), ("coffee", 4.5, None, "Exact price"), ("zelle ", None, [1, 31], "Transfer"),
    ("netflx", None, None, "TV"), ("ga", 3.0, [5, 5], "Gas"), ("monthly", None, [20, 10], "Never"),
]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for _ in range(250):
        text = " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3)))
        if rng.random() < 0.3:
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice("abcxyz ") + text[at + 1:]
        out.append((text, rng.choice([3.0, 4.5, 9.99]), rng.choice([None, "2024-01-05", "2024-01-15", "2024-01-31"])))
    return out


def found(df, column):
    return {
        r.seq: (r.c, r.m) if r.c else None
        for r in df.select("seq", F.col(f"{column}.category").alias("c"), F.col(f"{column}.match_type").alias("m")).collect()
    }


@pytest.mark.parametrize("matcher", ["edit", "ratio"])
@pytest.mark.parametrize("max_inline", [1000, 0])
def test_keywords_equal_brute_force(spark, txns, rows, matcher, max_inline):
    got = found(match_keywords(txns(rows), keyword_table(spark, TABLE), matcher=matcher, max_inline=max_inline), "keyword_match")
    want = {i: plain_keyword(t, TABLE, SCORES[matcher]) for i, (t, _, _) in enumerate(rows)}
    assert got == want
    assert {"exact", "fuzzy"} <= {w[1] for w in want.values() if w}


@pytest.mark.parametrize("matcher", ["edit", "ratio"])
@pytest.mark.parametrize("max_inline", [1000, 0])
def test_rules_equal_brute_force(spark, txns, rows, matcher, max_inline):
    got = found(match_rules(txns(rows), rules_table(spark, RULES), matcher=matcher, max_inline=max_inline), "rule_match")
    want = {
        i: plain_rule(t, a, int(d[-2:]) if d else None, RULES, SCORES[matcher])
        for i, (t, a, d) in enumerate(rows)
    }
    assert got == want
    assert {w[0] for w in want.values() if w} >= {"Early", "Exact price", "Transfer", "TV"}


@pytest.mark.parametrize("max_inline", [1000, 0])
def test_exact_keywords_equal_brute_force(spark, txns, rows, max_inline):
    got = found(match_keywords_exact(txns(rows), keyword_table(spark, TABLE), max_inline=max_inline), "keyword_match")

    def plain(text):
        for category, words in TABLE.items():
            if any(w in normalized(text) or w in text.lower() for w in words):
                return category, "exact"
        return None

    assert got == {i: plain(t) for i, (t, _, _) in enumerate(rows)}


def one(df, column="keyword_match"):
    r = df.select(f"{column}.*").first()
    return r.category, r.confidence, r.reasoning, r.match_type


def test_similar_keyword_of_earlier_category_beats_contained_one(spark, txns):
    table = keyword_table(spark, {"Entertainment": ["medium"], "Subscriptions": ["premium"]})
    df = match_keywords(txns([("premium", 1.0, None)]), table, matcher="ratio")
    assert one(df) == ("Entertainment", 0.9, "Matched hardcoded rule (fuzzy match)", "fuzzy")


def test_same_keyword_in_two_categories_goes_to_the_first(spark, txns):
    table = keyword_table(spark, {"Subscriptions": ["premium"], "Insurance": ["premium"]})
    assert one(match_keywords(txns([("car premium", 1.0, None)]), table))[:2] == ("Subscriptions", 1.0)


def test_original_text_is_tested_too(spark, txns):
    """Normalization deletes the star, so only the original text holds it."""
    table = keyword_table(spark, {"Food": ["uber *eats"]})
    assert one(match_keywords_exact(txns([("UBER *EATS 800", 1.0, None)]), table))[3] == "exact"


def test_blank_at_the_end_counts_only_for_containment(spark, txns):
    table = keyword_table(spark, {"Food": ["rest "]})
    df = match_keywords(txns([("the rest", 1.0, None), ("rest stop", 1.0, None)]), table, matcher="edit")
    assert [r.m for r in df.orderBy("seq").select(F.col("keyword_match.match_type").alias("m")).collect()] == ["fuzzy", "exact"]


def test_first_fitting_rule_wins(spark, txns):
    rules = rules_table(spark, [("zelle ", None, [1, 5], "Rent"), ("zelle", None, None, "Other")])
    df = match_rules(txns([("Zelle", 1.0, "2024-01-03"), ("Zelle", 1.0, "2024-01-09")]), rules)
    assert [r.c for r in df.orderBy("seq").select(F.col("rule_match.category").alias("c")).collect()] == ["Rent", "Other"]


def test_rule_order_is_rule_ord_not_row_order(spark, txns):
    rules = rules_table(spark, [("a", None, None, "First"), ("abc", None, None, "Second")]).orderBy(F.desc("rule_ord"))
    assert one(match_rules(txns([("abc", 1.0, None)]), rules), "rule_match")[0] == "First"


def test_null_date_fails_a_day_range_and_passes_none(spark, txns):
    with_days = rules_table(spark, [("shop", None, [1, 31], "A")])
    without = rules_table(spark, [("shop", None, None, "A")])
    row = txns([("shop", 1.0, None)])
    assert one(match_rules(row, with_days), "rule_match") == (None,) * 4
    assert one(match_rules(row, without), "rule_match")[0] == "A"


def test_amount_is_compared_exactly_with_its_sign(spark, txns):
    rules = rules_table(spark, [("rent", 850.0, None, "Rent")])
    df = match_rules(txns([("rent", 850.0, None), ("rent", -850.0, None), ("rent", 850.01, None), ("rent", None, None)]), rules)
    assert [r.c for r in df.orderBy("seq").select(F.col("rule_match.category").alias("c")).collect()] == ["Rent", None, None, None]


def test_label_uses_lower_case_unless_asked(spark, txns):
    rules = rules_table(spark, [("Chevron", None, None, "Travel")])
    row = txns([("CHEVRON 123", 1.0, None)])
    assert one(match_rules(row, rules), "rule_match")[1:] == (0.95, "Matched custom rule (exact match)", "exact")
    assert one(match_rules(row, rules, raw_label=True), "rule_match")[1:] == (0.9, "Matched custom rule (fuzzy match)", "fuzzy")


def test_short_text_matches_long_keyword(spark, txns):
    table = keyword_table(spark, {"Fun": ["games"]})
    assert one(match_keywords(txns([("game", 1.0, None)]), table))[3] == "fuzzy"


def test_threshold_is_a_parameter(spark, txns):
    table = keyword_table(spark, {"Fun": ["netflix"]})
    row = txns([("netfl1x", 1.0, None)])
    assert one(match_keywords(row, table, threshold=80))[3] == "fuzzy"
    assert one(match_keywords(row, table, threshold=95))[3] is None


def test_regex_characters_in_keywords_are_plain_text(spark, txns):
    table = keyword_table(spark, {"TV": ["disney+"], "Ride": ["uber (trip)"]})
    df = match_keywords_exact(txns([("DISNEY+ 1", 1.0, None), ("uber (trip) x", 1.0, None), ("disneyy", 1.0, None)]), table)
    assert [r.c for r in df.orderBy("seq").select(F.col("keyword_match.category").alias("c")).collect()] == ["TV", "Ride", None]


def test_blank_keywords_mean_the_same_in_short_and_long_lists(spark, txns):
    rows = txns([("rent due", 1.0, None), ("two  blanks", 1.0, None), ("", 1.0, None), (None, 1.0, None)])
    for words in ([""], [" "], ["  "], ["rent", ""], ["zzz"]):
        table = keyword_table(spark, {"A": words, "B": ["rent"]})
        results = []
        for many in (match_keywords_exact, lambda t, k, max_inline: match_keywords(t, k, matcher="edit", max_inline=max_inline)):
            for limit in (500, 0):
                got = many(rows, table, max_inline=limit).select("seq", "keyword_match.category", "keyword_match.match_type")
                results.append(sorted(got.collect(), key=str))
        assert all(r == results[0] for r in results), words


@pytest.mark.parametrize("threshold", [0, 30, 50, 101])
def test_useless_thresholds_are_refused_alike(spark, txns, threshold):
    rows, table = txns([("rent", 1.0, None)]), keyword_table(spark, {"A": ["k"]})
    for limit in (32, 0):
        with pytest.raises(ValueError, match="threshold"):
            match_keywords(rows, table, threshold, "edit", max_inline=limit)


@pytest.mark.parametrize("limit", [200_000, 1])
def test_containment_in_long_lists_with_and_without_automaton(spark, txns, monkeypatch, limit):
    from coinsieve.operators import match

    monkeypatch.setattr(match, "AUTOMATON_KEYWORDS", limit)
    rng = random.Random(8)
    table = {f"C{c}": ["".join(rng.choice("abc ") for _ in range(rng.randint(1, 4))) for _ in range(30)] for c in range(6)}
    table["C3"] += ["é", "ab" * 20]
    rows = [("".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 9))), 1.0, None) for _ in range(300)] + [("", 1.0, None)]
    got = found(match_keywords_exact(txns(rows), keyword_table(spark, table), max_inline=0), "keyword_match")

    def plain(text):
        return next(((c, "exact") for c, words in table.items() if any(w in normalized(text) or w in text.lower() for w in words)), None)

    assert got == {i: plain(t) for i, (t, _, _) in enumerate(rows)}
    empty = found(match_keywords_exact(txns(rows[:3]), keyword_table(spark, {"A": [""], "B": ["a"]}), max_inline=0), "keyword_match")
    assert set(empty.values()) == {("A", "exact")}


def test_no_shuffle_by_a_constant_for_blank_keywords(spark, txns):
    plan = match_keywords(txns([("a b", 1.0, None)]), keyword_table(spark, {"A": [" "], "B": ["xyz"]}), matcher="edit", max_inline=0)
    assert plan.first().keyword_match.category == "A"
