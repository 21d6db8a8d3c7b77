"""Pluggable functions: batches, failures, escalation, cascade with cache."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from coinsieve.operators.enrich import (
    align_replies, ask_batches, ask_rows, build_prompt, classify, empty_cache, enrich,
)
from coinsieve.operators.order import few_shot, static_examples
from coinsieve.plans.categorize import Model, cache_entries, categorize, recategorize
from coinsieve.schema import CATEGORIZE_CACHE
from coinsieve.sources.tables import keyword_table, rules_table

FAST = {"attempts": 1, "wait": (0.0, 0.0)}


def shout(texts):
    return "\n".join(t.upper() for t in texts)


def test_each_distinct_text_is_asked_once(spark, txns, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def counting(texts):
        import uuid

        (log / uuid.uuid4().hex).write_text("\n".join(texts))
        return shout(texts)

    df = txns([("a b", 1.0, None), ("a b", 2.0, None), ("c", 3.0, None)])
    rows, cache = enrich(df, counting, empty_cache(spark), **FAST)
    assert {r.seq: r.normalized_desc for r in rows.collect()} == {0: "A B", 1: "A B", 2: "C"}
    rows.count(), cache.count()
    asked = sorted(t for f in log.iterdir() for t in f.read_text().split("\n"))
    assert asked == ["a b", "c"]
    again, _ = enrich(df, counting, cache, **FAST)
    assert again.count() == 3
    assert sorted(t for f in log.iterdir() for t in f.read_text().split("\n")) == ["a b", "c"]


def test_batches_have_at_most_n_rows(spark):
    df = spark.createDataFrame([(f"t{i}",) for i in range(23)], "d string")
    sizes = [len(r["items"]) for r in ask_batches(df, "d", shout, batch_size=5, tasks=1, **FAST).collect()]
    assert sum(sizes) == 23 and sizes == [5, 5, 5, 5, 3]


def test_short_and_long_replies(spark):
    batches = spark.createDataFrame(
        [(["A Online", "B"], " x \n\n", None), (["C"], "c1\nc2", None), (["D payment"], None, "down")],
        "items array<string>, reply string, error string",
    )
    got = {r.original: (r.result, r.error, r.fallback_used) for r in align_replies(batches).collect()}
    assert got == {
        "A Online": ("x", None, False), "B": ("b", None, True), "C": ("c1", None, False), "D payment": ("d", "down", True),
    }


def test_failed_batch_falls_back_and_is_marked(spark, txns):
    def down(texts):
        raise RuntimeError("down")

    rows, cache = enrich(txns([("A Payment", 1.0, None)]), down, empty_cache(spark), **FAST)
    assert rows.first().normalized_desc == "a"
    entry = cache.first()
    assert (entry.error, entry.fallback_used, entry.hits) == ("down", True, 1)


def test_calls_are_retried(spark, tmp_path):
    mark = tmp_path / "tried"

    def second_time(texts):
        if not mark.exists():
            mark.write_text("x")
            raise RuntimeError("once")
        return shout(texts)

    df = spark.createDataFrame([("a",)], "d string")
    got = ask_batches(df, "d", second_time, attempts=3, wait=(0.0, 0.0), tasks=1).first()
    assert got.reply == "A" and got.error is None


def replies(mapping):
    def fn(frame: pd.DataFrame):
        return [mapping[d] for d in frame["description"]]

    return fn


def answer(category, confidence, reasoning="r"):
    return json.dumps({"category": category, "confidence": confidence, "reasoning": reasoning})


def test_escalation_takes_the_surer_answer(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c"), ("4", "d"), ("5", "e")], "text_key string, description string")
    first = replies({
        "a": answer("Food", 0.6), "b": answer("Uncategorized", 0.5), "c": answer("Uncategorized", 0.5),
        "d": "nonsense", "e": answer("Uncategorized", 0.5),
    })
    second = replies({"b": answer("Rent", 0.9), "c": answer("Rent", 0.4), "e": "broken"})
    got = {r.description: (r.category, r.confidence) for r in classify(df, first, second, **FAST).collect()}
    assert got == {
        "a": ("Food", 0.6), "b": ("Rent", 0.9), "c": ("Uncategorized", 0.5), "d": ("Uncategorized", 0.0),
        "e": ("Uncategorized", 0.5),
    }


def test_failures_say_why(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "text_key string, description string")
    fn = replies({"a": "not json", "b": '{"category": "Food"}'})
    got = {r.description: r.reasoning for r in classify(df, fn, **FAST).collect()}
    assert got == {"a": "Failed to parse LLM response: not json", "b": "Failed to categorize due to error: incomplete reply"}


def everything(category, confidence):
    return lambda frame: [answer(category, confidence) for _ in range(len(frame))]


def test_cascade_order_and_gate(spark, txns):
    rules = rules_table(spark, [("rent", None, None, "Home")])
    keywords = keyword_table(spark, {"Food": ["coffee"], "Home2": ["rent"]})
    df = txns([("rent", 1.0, None), ("coffee", 1.0, None), ("zzzz", 1.0, None), ("zzzz", 1.0, None)])
    got = categorize(df, rules, keywords, model=Model(everything("Odd", 0.5), calls=FAST)).orderBy("seq").collect()
    assert [(r.category, r.confidence, r.match_type) for r in got] == [
        ("Home", 0.95, "exact"), ("Food", 1.0, "exact"), ("Uncategorized", 0.5, "model"), ("Uncategorized", 0.5, "model"),
    ]
    assert got[2].reasoning == "Low confidence (0.50) for 'Odd'. Original reasoning: r"


def test_without_model_the_rest_is_uncategorized(spark, txns):
    got = categorize(txns([("zzzz", 1.0, None)]), keywords=keyword_table(spark, {"Food": ["coffee"]})).first()
    assert (got.category, got.confidence, got.reasoning, got.match_type) == ("Uncategorized", 0.0, "No rule matched", None)


def test_cached_model_results_pass_the_gate_again(spark, txns):
    df = txns([("zzzz", 1.0, "2024-01-01")])
    raw = df.selectExpr("*", "'Odd' category", "0.5D confidence", "'r' reasoning", "'model' match_type")
    got = categorize(df, cache=cache_entries(raw, None)).first()
    assert (got.category, got.match_type) == ("Uncategorized", "model")


def test_new_rules_make_cached_results_stale(spark, txns):
    df = txns([("rent", 1.0, "2024-01-01")])
    old, new = rules_table(spark, [("rent", None, None, "Old")]), rules_table(spark, [("rent", None, None, "New")])
    cache = cache_entries(categorize(df, old), old)
    assert categorize(df, new, cache=cache).first().category == "New"
    assert categorize(df, old, cache=cache).first().category == "Old"
    assert set(cache.columns) == {c.split(" ")[0] for c in CATEGORIZE_CACHE.replace("struct<category:string,confidence:double,reasoning:string>", "x").split(", ")}


def test_new_keywords_make_cached_results_stale(spark, txns):
    df = txns([("rent", 1.0, "2024-01-01")])
    old, new = keyword_table(spark, {"Old": ["rent"]}), keyword_table(spark, {"New": ["rent"]})
    cache = cache_entries(categorize(df, keywords=old), None, old)
    assert categorize(df, keywords=new, cache=cache).first().category == "New"


def test_every_row_gets_one_result(spark, txns):
    df = txns([(t, 1.0, None) for t in ["rent", "coffee", "rent", "", None, "x"]])
    got = categorize(df, rules_table(spark, [("rent", None, None, "R")]), keyword_table(spark, {"F": ["coffee"]}))
    assert sorted(r.txn_id for r in got.collect()) == ["0", "1", "2", "3", "4", "5"]


def test_rules_added_at_the_end_never_change_matched_rows(spark, txns):
    df = txns([("rent a car", 1.0, None), ("car", 1.0, None)])
    before = rules_table(spark, [("rent", None, None, "Rent")])
    after = rules_table(spark, [("rent", None, None, "Rent"), ("car", None, None, "Car")])
    assert [r.category for r in categorize(df, before).orderBy("seq").collect()] == ["Rent", "Uncategorized"]
    assert [r.category for r in categorize(df, after).orderBy("seq").collect()] == ["Rent", "Car"]


def test_recategorize_touches_only_uncategorized_rows(spark, txns):
    df = categorize(txns([("rent", 1.0, None), ("shop", 1.0, None)]), rules_table(spark, [("rent", None, None, "Rent")]))
    got = recategorize(df, rules_table(spark, [("rent", None, None, "Other"), ("shop", None, None, "Shop")]))
    assert [r.category for r in got.orderBy("seq").collect()] == ["Rent", "Shop"]


def test_few_shot_puts_corrections_first(spark):
    corrections = spark.createDataFrame(
        [("Food", 1, "bun", 1.0), ("Food", 2, "egg", 2.0), ("Food", 3, "pie", 3.0), ("Odd", 4, "x", 1.0), ("Rent", 5, "", 1.0), ("Rent", 6, "y", 0.0)],
        "new_category string, seq long, description string, amount double",
    )
    static = static_examples(spark, {"Food": ["s1", "s2", "s3"], "Rent": ["r1"]})
    got = few_shot(static, corrections).orderBy("category", "rank").collect()
    assert [(r.category, r.rank, r.example) for r in got] == [
        ("Food", 1, "bun $1.00"), ("Food", 2, "egg $2.00"), ("Food", 3, "s1"), ("Rent", 1, "r1"),
    ]


def test_prompt_holds_row_and_examples(spark, txns):
    prompt = build_prompt(txns([("Shop", 1.5, "2024-01-02")]), static_examples(spark, {"Food": ["corner bakery $4.20"]})).first().prompt
    for part in ("Food", "Uncategorized", "corner bakery $4.20 → Food", "Shop", "1.50", "01/02/2024"):
        assert part in prompt


@pytest.mark.parametrize("text", [None, ""])
def test_prompt_of_empty_rows(spark, txns, text):
    assert build_prompt(txns([(text, None, None)])).select(F.length("prompt").alias("n")).first().n > 0


# --- tasks, pace and the log of calls --------------------------------------------------


def test_tasks_follow_from_the_rows_alone(spark, tmp_path):
    """One core or eight: the same number of calls in every task."""
    import os
    import subprocess
    import sys
    import textwrap

    from tests.conftest import ROOT

    script = tmp_path / "tasks.py"
    script.write_text(textwrap.dedent("""
        import sys
        from pyspark import TaskContext
        from pyspark.sql import functions as F
        from coinsieve.operators.enrich import ask_batches
        from coinsieve.session import build_session

        spark = build_session("tasks", sys.argv[1], spark__sql__warehouse__dir=sys.argv[2], spark__driver__memory="1g")
        df = spark.range(1000).select(F.concat(F.lit("t"), "id").alias("d"))
        where = lambda items: str(TaskContext.get().partitionId())
        rows = ask_batches(df, "d", where, batch_size=20).groupBy("reply").count().collect()
        print("calls", sorted((int(r.reply), r["count"]) for r in rows))
    """))
    seen = []
    for cores in ("1", "8"):
        out = subprocess.run([sys.executable, str(script), cores, str(tmp_path / cores)], capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONPATH": ROOT})
        assert out.returncode == 0, out.stderr[-2000:]
        seen.append(next(line for line in out.stdout.splitlines() if line.startswith("calls")))
    assert seen[0] == seen[1] and seen[0].count("(") >= 10


def test_replies_of_many_tasks_are_read_by_few(spark):
    from coinsieve.operators import enrich as en

    df = spark.range(2000).select(F.concat(F.lit("t"), "id").alias("text_key"), F.lit("x").alias("description"))
    replies = en.ask_rows(df, lambda rows: ["r"] * len(rows), ["text_key"], batch_size=5, **FAST)
    assert replies.rdd.getNumPartitions() == 100
    done = en._asked(replies)
    assert done.rdd.getNumPartitions() == 7 and done.filter("reply = 'r'").count() == 2000
    assert en._tasks(10**9, 50) == en.MOST_TASKS


def test_rate_is_shared_by_all_tasks(spark):
    import time

    df = spark.createDataFrame([(f"t{i}",) for i in range(8)], "d string")
    start = time.monotonic()
    done = ask_batches(df, "d", shout, batch_size=1, tasks=2, rate=4.0, **FAST).count()
    assert done == 8 and time.monotonic() - start > 1.0  # the fuller task has at least four calls, half a second apart


def test_calls_are_noted_once_with_their_model(spark, txns, tmp_path):
    from coinsieve.operators.aggregate import usage_report
    from coinsieve.sources.tables import load_call_log

    log = str(tmp_path / "calls")
    assert load_call_log(spark, log).count() == 0
    rows, cache = enrich(txns([("a b", 1.0, None), ("c", 3.0, None)]), shout, empty_cache(spark), log=log, **FAST)
    rows.count(), rows.count(), cache.count()
    df = spark.createDataFrame([("1", "dd"), ("2", "e")], "text_key string, description string")

    def failing(frame):
        raise RuntimeError("down")

    classify(df, failing, log=log, models=("gpt-4o", "x"), **FAST).count()
    noted = sorted((r.model, r.context, r.prompt_chars, r.response_chars, r.error, r.tries) for r in load_call_log(spark, log).collect())
    # Batches for normalization go to the cheaper model.
    assert noted[:2] == [("gpt-3.5-turbo", "norm_batch", 6, 5, None, 1)] + noted[1:2]
    assert noted[1:] == [("gpt-4o", "txn:", 1, 0, "down", 1), ("gpt-4o", "txn:", 2, 0, "down", 1)]
    report = {(r.family, r.purpose): r.calls for r in usage_report(load_call_log(spark, log)).collect()}
    assert report == {("gpt-3.5", "normalization"): 1, ("gpt-4", "categorization"): 2}


def test_questions_are_measured(spark):
    df = spark.createDataFrame([("1", "long question"), ("2", None)], "k string, prompt string")
    got = ask_rows(df, lambda f: ["yes"] * len(f), ["k"], **FAST).collect()
    assert sorted((r.prompt_chars, r.response_chars, r.tries) for r in got) == [(0, 3, 1), (13, 3, 1)]
