"""Rule mining, suggestion intake and batch review."""

import pytest
from pyspark.sql import functions as F

from coinsieve.operators.cache import add_entries, apply_corrections, resume_from, update_from
from coinsieve.operators.mining import (
    clear_consumed, ingest_suggestions, mine_corrections, mine_low_confidence, mine_uncategorized,
    rules_from_corrections, valid_suggestions,
)
from coinsieve.operators.order import append_rules
from coinsieve.operators.rows import enough_evidence, low_confidence
from coinsieve.plans.learn import learn_rules
from coinsieve.plans.review import read_answers, review_batch
from coinsieve.sources.tables import rules_table


def scored(txns, rows):
    """(description, amount, day, category, confidence) rows."""
    df = txns([r[:3] for r in rows])
    labels = df.sparkSession.createDataFrame(
        [(i, r[3], r[4], None) for i, r in enumerate(rows)], "seq bigint, category string, confidence double, reasoning string"
    )
    return df.join(labels, "seq")


def rules_of(df):
    return {(r.description, r.amount, tuple(r.day_range), r.category, r.confidence) for r in df.collect()}


def test_mine_uncategorized(txns):
    rows = [("acme store", 5.0, "2024-01-03", "Uncategorized", 0.0)] * 2 + [("acme shop", 5.0, "2024-01-09", "Uncategorized", 0.0)]
    known = [("acme", 1.0, None, "Shopping", 1.0)] * 3 + [("acme", 1.0, None, "Food", 1.0), ("store", 1.0, None, "Food", 1.0)]
    df = scored(txns, rows + known)
    confident = df.filter("confidence >= 0.9")
    assert rules_of(mine_uncategorized(df, confident)) == {("acme", 5.0, (3, 9), "Shopping", 0.75)}
    assert rules_of(mine_uncategorized(df, confident, min_conf=0.8)) == set()


def test_mine_corrections_needs_purity(txns):
    df = scored(txns, [("bus ride", float(i), "2024-01-01", "x", 0.0) for i in range(6)] + [("bus", 9.0, "2024-01-02", "x", 0.0)])
    told = df.withColumn("new_category", F.when(F.col("seq") < 6, "Travel").otherwise("Fees"))
    got = rules_of(mine_corrections(told))
    assert got == {("ride", None, (1, 1), "Travel", 1.0), ("bus", None, (1, 1), "Travel", 0.8571)}


def test_mine_low_confidence_needs_three_rows(txns):
    two = scored(txns, [("bus", 1.0, "2024-01-01", "Travel", 0.5)] * 2)
    assert mine_low_confidence(two, min_support=1).count() == 0
    assert mine_low_confidence(scored(txns, [("bus", 1.0, "2024-01-01", "Travel", 0.5)] * 3)).count() == 1


def test_evidence_counts_all_tables(txns):
    df = scored(txns, [("a", 1.0, None, "x", 0.0)] * 2)
    assert enough_evidence(df).count() == 0
    assert enough_evidence(df, df.limit(1)).count() == 2


def test_low_confidence_keeps_rows_without_category(txns):
    assert low_confidence(scored(txns, [("a", 1.0, None, None, 0.1), ("b", 1.0, None, "Uncategorized", 0.1)])).count() == 1


def test_consumed_corrections_are_cleared(spark, txns):
    df = txns([("a", 1.0, None)])
    assert clear_consumed(df, rules_table(spark, [("a", None, None, "A")])).count() == 0
    assert clear_consumed(df, rules_table(spark, [])).count() == 1


def test_suggestions_need_category_text_and_confidence(spark):
    df = spark.createDataFrame(
        [("a", "X", 0.9), ("b", "Uncategorized", 0.9), (None, "X", 0.9), ("c", "", 0.9), ("d", "X", 0.5), ("e", "X", None)],
        "description string, category string, confidence double",
    ).selectExpr("*", "cast(null as double) amount", "cast(null as array<int>) day_range", "cast(null as string) reasoning")
    assert {r.description for r in valid_suggestions(df, 0.85, 0.9).collect()} == {"a", "e"}
    assert {r.description for r in valid_suggestions(df).collect()} == {"a", "d", "e"}
    assert valid_suggestions(df).first().day_range == [1, 31]


REPLY = '[{"description": "a", "category": "X", "confidence": 0.95}, {"description": "a", "category": "X", "confidence": 0.95}, ' \
    '{"description": "old", "category": "O"}, 3, {"description": "b", "category": "X", "confidence": 0.82}]'


@pytest.mark.parametrize("origin, want", [
    ("uncategorized", ["old", "a", "a", "old", "b"]), ("corrections", ["old", "a"]), ("low_confidence", ["old", "a", "b"]),
])
def test_ingest_by_origin(spark, origin, want):
    rules = rules_table(spark, [("old", None, None, "O")])
    replies = spark.createDataFrame([(0, REPLY)], "reply_ord bigint, text string")
    got = ingest_suggestions(replies, rules, origin).orderBy("rule_ord").collect()
    assert [r.description for r in got] == want


def test_new_rules_go_to_the_end(spark):
    rules = rules_table(spark, [("a", None, None, "A"), ("b", None, None, "B")])
    new = rules.selectExpr("rule_ord suggestion_ord", "'n' description", "amount", "day_range", "category")
    assert [r.rule_ord for r in append_rules(rules, new).orderBy("rule_ord").collect()] == [0, 1, 2, 3]
    assert [r.rule_ord for r in append_rules(rules_table(spark, []), new).orderBy("rule_ord").collect()] == [0, 1]


def test_learned_rules_come_by_source(spark, txns):
    rows = [("acme", 5.0, "2024-01-03", "Uncategorized", 0.0)] * 3 + [("acme", 1.0, None, "Shopping", 1.0)] * 2
    rows += [("bus", 1.0, "2024-01-01", "Travel", 0.5)] * 9
    df = scored(txns, rows)
    told = df.filter("category = 'Uncategorized'").withColumn("new_category", F.lit("Gifts"))
    got = learn_rules(df, rules_table(spark, [("zelle", None, None, "Rent")]), told).orderBy("rule_ord").collect()
    assert [(r.rule_ord, r.description, r.category) for r in got] == [
        (0, "zelle", "Rent"), (1, "acme", "Shopping"), (2, "bus", "Travel"), (3, "acme", "Gifts"),
    ]


def test_rule_from_a_correction(txns):
    told = txns([("Coffee Bar", 4.5, "2024-01-30")]).withColumn("new_category", F.lit("Food"))
    r = rules_from_corrections(told).first()
    assert (r.description, r.amount, r.day_range, r.category) == ("coffee", None, [28, 31], "Food")
    answered = told.withColumns({"keyword": F.lit("bar"), "with_amount": F.lit("ok"), "days": F.lit("1-9")})
    r = rules_from_corrections(answered).first()
    assert (r.description, r.amount, r.day_range) == ("bar", 4.5, [1, 9])


def test_quit_ends_the_review(spark, txns):
    df = scored(txns, [("a", 1.0, "2024-01-01", "Food", 0.1), ("b", 1.0, "2024-01-01", "Food", 0.2), ("c", 1.0, "2024-01-01", "Food", 0.3),
                       ("d", 1.0, "2024-01-01", "Food", 0.9)])
    said = spark.createDataFrame([("0", "change to rent"), ("1", "quit"), ("2", "change to rent"), ("3", "change to rent")], "txn_id string, response string")
    assert [r.txn_id for r in read_answers(df, said).collect()] == ["0"]
    applied, corrections, rules = review_batch(df, said)
    assert [r.category for r in applied.orderBy("seq").collect()] == ["Rent", "Food", "Food", "Food"]
    assert corrections.count() == 1 and rules.first().description == "a"
    first = applied.orderBy("seq").first()
    assert (first.confidence, first.reasoning) == (1.0, "User override during interactive review")


def test_last_correction_counts(spark, txns):
    df = scored(txns, [("a", 1.0, None, "Food", 0.1)])
    told = spark.createDataFrame([("0", "Rent", 2), ("0", "Fees", 1)], "txn_id string, new_category string, correction_ord int")
    assert apply_corrections(df, told).first().category == "Rent"


def test_update_keeps_old_values_where_new_ones_are_null(spark, txns):
    df = scored(txns, [("a", 1.0, None, "Food", 0.1)])
    new = spark.createDataFrame([("0", None, 0.9)], "txn_id string, category string, confidence double")
    r = update_from(df, new).first()
    assert (r.category, r.confidence) == ("Food", 0.9)


def test_resume_takes_the_first_saved_row(txns):
    saved = scored(txns, [("a", 1.0, "2024-01-01", "First", 0.9), ("a", 1.0, "2024-01-01", "Second", 0.9), ("n", 1.0, None, "Null", 0.9)])
    now = txns([("a", 1.0, "2024-01-01"), ("b", 1.0, "2024-01-01"), ("n", 1.0, None)])
    got = resume_from(now, saved).orderBy("seq").collect()
    assert [(r.is_processed, r.category) for r in got] == [(True, "First"), (False, None), (False, None)]
    assert got[1].normalized_desc == "b"


def test_newer_cache_entries_replace_older_ones(spark):
    old = spark.createDataFrame([("k", "1"), ("l", "2")], "key string, result string")
    new = spark.createDataFrame([("k", "3")], "key string, result string")
    assert {r.key: r.result for r in add_entries(old, new).collect()} == {"k": "3", "l": "2"}
