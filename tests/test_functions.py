"""Parsing, keys, JSON repair and review answers."""

import datetime as dt
import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from coinsieve.functions import jsonfix, keys, parsing, review, text, usage
from coinsieve.functions.text import SPACES


def column(spark, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return lambda make: [r.o for r in df.select("i", make(F.col("v")).alias("o")).orderBy("i").collect()]


def test_strip_equals_python(spark):
    values = ["  a b ", " x ", "\x1cy\x85", "", "   ", "é　"]
    assert column(spark, values)(text.strip) == [v.strip() for v in values]
    assert all(c.isspace() for c in SPACES)


def test_normalize_deletes_in_order(spark):
    values = ["ACH Debit VENMO - PAYMENT", "UBER *EATS  800", "onpaymentline", None, " Online  Banking "]
    assert column(spark, values)(text.normalize_description) == ["venmo -", "uber eats 800", "online", None, "banking"]


def test_normalized_text_has_single_blanks(spark):
    @settings(max_examples=20, deadline=None)
    @given(st.lists(st.text(alphabet="aé *\t onlieACHdbtrpym", max_size=30), min_size=1, max_size=20))
    def check(values):
        for got in column(spark, values)(text.normalize_description):
            assert got == " ".join(got.split())

    check()


def test_dates_of_several_formats_in_one_column(spark):
    values = ["01/05/2024", "1/5/2024", "2024-01-05", "01/05/24", "5-Jan-2024", "Jan 5, 2024", "13/45/2024", "x", None, ""]
    day = dt.date(2024, 1, 5)
    assert column(spark, values)(parsing.parse_date) == [day] * 6 + [None] * 4


def test_amounts(spark):
    values = ["1,234.50", "-$12", "$.5", "+3", "1e3", "1.0d", "abc", "", None, " 7 "]
    got = column(spark, values)(lambda c: parsing.parse_amount(parsing.strip_currency(c)))
    assert got == [1234.5, -12.0, 0.5, 3.0, 1000.0, None, None, None, None, 7.0]


def test_net_amount_signs(spark):
    df = spark.createDataFrame([(5.0, None), (None, 3.0), (None, None)], "d double, c double")
    spend = [r.x for r in df.select(parsing.net_amount(F.col("d"), F.col("c")).alias("x")).collect()]
    income = [r.x for r in df.select(parsing.net_amount(F.col("d"), F.col("c"), "credit").alias("x")).collect()]
    assert spend == [5.0, -3.0, 0.0] and income == [-5.0, 3.0, 0.0]


def test_day_ranges(spark):
    df = spark.createDataFrame(
        [("any", "2024-01-10"), ("3-9", "2024-01-10"), ("", "2024-01-01"), ("x-y", "2024-01-31"), ("", None)], "a string, d string"
    )
    got = [r.x for r in df.select(parsing.parse_day_range(F.col("a"), F.to_date("d")).alias("x")).collect()]
    assert got == [[1, 31], [3, 9], [1, 3], [29, 31], None]


def test_keys_do_not_depend_on_number_printing(spark):
    df = spark.createDataFrame([(12345678.9, "a", dt.date(2024, 1, 2))], "m double, t string, d date")
    r = df.select(
        keys.txn_key(F.col("d"), F.col("t"), F.col("m")).alias("k"),
        keys.simple_key(F.col("t"), F.col("m"), F.col("d")).alias("s"),
    ).first()
    assert r.k == "01/02/2024:a:12345678.90"
    assert r.s == hashlib.md5(b"a12345678.9001/02/2024").hexdigest()


def test_fingerprint_follows_rules_and_their_order(spark):
    from coinsieve.sources.tables import rules_table

    def digest(rules):
        return keys.rules_fingerprint(rules_table(spark, rules).repartition(3)).first()[0]

    a, b = ("x", None, [1, 5], "A"), ("y", 2.0, None, "B")
    assert digest([a, b]) == digest([a, b])
    assert len({digest([a, b]), digest([b, a]), digest([a]), digest([])}) == 4


REPLIES = {
    '{"a": 1}': {"a": 1},
    '```json\n{"a": 1}\n```': {"a": 1},
    'Here it is: {"a": {"b": 2}} thanks': {"a": {"b": 2}},
    "so [1, 2] then": [1, 2],
    '{"a": 1}, {"b": 2}': None,
    '{"a": 1': None,
    "no json": None,
    "": None,
    '[{"a": 1}] trailing': None,
}


def test_parse_json_equals_strict_parsing(spark):
    got = column(spark, list(REPLIES))(lambda c: F.to_json(jsonfix.parse_json(c)))
    assert [json.loads(g) if g else None for g in got] == list(REPLIES.values())


def test_repair_array(spark):
    cases = {
        '{"a": 1}, {"b": 2}': '[{"a": 1}, {"b": 2}]',
        '[[{"a": 1}]]': '[{"a": 1}]',
        '[{"a": 1}': '[{"a": 1}]',
        '{"description": "x", "confidence": 0.90': '{"description": "x", "confidence": 0.90}',
        '[{"a": 1}]': '[{"a": 1}]',
        '{"a": 1}': '{"a": 1}',
    }
    assert column(spark, list(cases))(jsonfix.repair_array) == list(cases.values())


def test_suggestions_are_salvaged_one_by_one(spark):
    broken = '[{"description": "a", "category": "X"}, {"description": "b", "cat'
    got = column(spark, [broken, '[]', '{"k": 1}', "none"])(
        lambda c: F.to_json(F.transform(jsonfix.parse_suggestions(c), lambda v: F.to_json(v)))
    )
    assert json.loads(got[0]) == ['{"category":"X","description":"a"}']
    assert json.loads(got[1]) == [] and json.loads(got[2]) == ['{"k":1}'] and json.loads(got[3]) == []


def test_intents_in_order(spark):
    cases = {
        "Quit": "quit", "weekend": "quit", "change to food": "change", "this is correct": "change",
        "skip": "skip", "yes": "skip", "y": "accept", "okay": "accept", "hmm": "unknown",
    }
    assert column(spark, list(cases))(review.intent) == list(cases.values())


def test_category_mentions(spark):
    rows = [
        ("Change to Food, not travel", None), ("travel should be rent", None), ("change to", "4"),
        ("please edit", "12"), ("please edit", "13"), ("please edit", "insurance "), ("please edit", "nothing"),
        ("make it change to fees", None),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, e string")
    got = [r.c for r in df.select("i", review.mentioned_category(F.col("a"), F.col("e")).alias("c")).orderBy("i").collect()]
    assert got == ["Food", "Rent", "Shopping", "Uncategorized", "Uncategorized", "Insurance", "Uncategorized", "Fees"]


def test_suggested_category_is_read_from_the_reason(spark):
    values = ["Low confidence (0.50) for 'Food'. Original reasoning: x", "Matched", None, "Low confidence (0.50) for 'Food'."]
    assert column(spark, values)(review.suggested_category) == ["Food", None, None, None]


def test_usage_estimates(spark):
    df = spark.createDataFrame([("gpt-4o", "norm_batch:txn:", 300, 20), ("gpt-3.5-turbo", None, 30, 0)], "m string, c string, p long, r long")
    tokens = usage.token_estimate(F.col("p"), F.col("r"))
    got = df.select(
        tokens.alias("t"), F.round(usage.cost_estimate(F.col("m"), tokens), 8).alias("c"),
        usage.purpose(F.coalesce("c", F.lit(""))).alias("p"), usage.route_model(F.col("m"), F.col("c")).alias("r"),
    ).collect()
    assert [tuple(r) for r in got] == [(110.0, 0.0011, "normalization", "gpt-3.5-turbo"), (10.0, 0.00001, "other", "gpt-3.5-turbo")]


@pytest.mark.parametrize("path, stem", [("file:/x/y/Chase 2024.csv", "chase 2024"), ("s3://b/AccountHistory.v2.CSV", "accounthistory.v2"), ("a/b%20c.csv", "b c")])
def test_file_stem(spark, path, stem):
    assert column(spark, [path])(text.file_stem) == [stem]
