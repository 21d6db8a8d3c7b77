"""Duplicate semantics."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from coinsieve.operators.dedupe import dedupe_adjudicated, dedupe_exact, duplicate_groups, flag_duplicates, group_members
from coinsieve.operators.enrich import GroupJudge, adjudicate, adjudicate_streamed
from coinsieve.plans.dedupe import dedupe

FAST = {"attempts": 1, "wait": (0.0, 0.0)}


@pytest.fixture
def rows(txns):
    return txns(
        [
            ("Coffee", 4.0, "2024-01-01"), ("coffee ", -4.0, "2024-01-01"), ("Tea", 2.0, "2024-01-01"),
            ("Rent", 9.0, None), ("Milk", 1.0, None), ("Tea", 2.0, "2024-01-02"), ("Tea", 2.0, "2024-01-02"),
        ]
    )


def by_seq(df, *columns):
    return {r.seq: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def test_charge_and_refund_of_equal_size_collide(rows):
    assert by_seq(flag_duplicates(rows), "is_duplicate") == {0: True, 1: True, 2: False, 3: True, 4: True, 5: True, 6: True}


def test_survivor_keeps_flag_and_reason(rows):
    got = by_seq(dedupe_exact(rows), "is_duplicate", "dedupe_reasoning")
    assert set(got) == {0, 2, 3, 4, 5}
    assert got[0] == (True, "Basic deduplication") and got[2] == (False, "Basic deduplication")
    assert got[3] == got[4] == (False, "Basic deduplication")


def test_null_keys_collapse_when_asked(rows):
    assert set(by_seq(dedupe_exact(rows, "collapse"), "is_duplicate")) == {0, 2, 3, 5}


def test_first_means_seq_not_row_order(rows):
    assert set(by_seq(dedupe_exact(rows.orderBy(rows.seq.desc())), "is_duplicate")) == {0, 2, 3, 4, 5}


def test_dedupe_twice_changes_nothing(rows):
    once = dedupe_exact(rows).select(rows.columns)
    assert sorted(map(str, dedupe_exact(once).select(rows.columns).collect())) == sorted(map(str, once.collect()))


def test_amount_zero_and_minus_zero_are_equal(txns):
    assert dedupe_exact(txns([("a", 0.0, "2024-01-01"), ("a", -0.0, "2024-01-01")])).count() == 1


def judge(frame: pd.DataFrame):
    out = []
    for records in frame["records"]:
        if "offee" in records:
            out.append('{"is_duplicate": true, "reasoning": "same"}')
        else:
            out.append('{"reasoning": "unsure"}')
    return out


def failing(frame: pd.DataFrame):
    raise RuntimeError("down")


def test_verdicts(rows):
    got = by_seq(dedupe(rows, "adjudicated", judge, **FAST), "is_duplicate", "dedupe_reasoning")
    assert got[0] == (True, "Kept as primary. same") and 1 not in got
    # A reply without a verdict means not a duplicate; all rows stay.
    assert got[5] == got[6] == (False, "Not a duplicate. unsure")
    # Rows without a key are flagged, never dropped.
    assert got[3] == got[4] == (True, "")
    assert got[2] == (False, "")


def test_failing_judge_falls_back_to_keeping_the_first(rows):
    got = by_seq(dedupe(rows, "adjudicated", failing, **FAST), "dedupe_reasoning")
    assert set(got) == {0, 2, 3, 4, 5}
    assert got[0] == "Kept as primary (fallback to basic deduplication due to error)"


def test_unparsable_reply_counts_as_duplicate(rows):
    got = by_seq(dedupe(rows, "adjudicated", lambda f: ["?"] * len(f), **FAST), "dedupe_reasoning")
    assert set(got) == {0, 2, 3, 4, 5} and got[0].startswith("Kept as primary. Fallback: JSON parsing error")


def test_group_in_parts_is_duplicate_only_if_every_part_is(txns):
    rows = txns([("Coffee", 4.0, "2024-01-01")] * 40)

    def half(frame):
        flags = iter(range(len(frame)))
        return ['{"is_duplicate": %s, "reasoning": "r"}' % ("false" if i == 0 else "true") for i in flags]

    groups = duplicate_groups(rows, members_per_part=5)
    assert groups.count() > 2
    mixed = adjudicate(groups, half, tasks=1, **FAST)
    assert dedupe_adjudicated(rows, mixed).count() == 40
    same = adjudicate(groups, judge, **FAST)
    assert dedupe_adjudicated(rows, same).count() == 1


def test_missing_verdict_keeps_the_first(rows, spark):
    none = spark.createDataFrame(
        [], "key_date date, key_amount double, key_desc string, is_duplicate boolean, reasoning string, failed boolean"
    )
    assert set(by_seq(dedupe_adjudicated(rows, none), "is_duplicate")) == {0, 2, 3, 4, 5}


def test_a_large_group_reaches_the_judge_whole(txns):
    rows = txns([("Coffee", 4.0, "2024-01-01")] * 200 + [("Tea", 2.0, "2024-01-01")])
    (group,) = duplicate_groups(rows).collect()
    assert [m.seq for m in group.members] == list(range(200))
    kept = dedupe(rows, "adjudicated", lambda f: ['{"is_duplicate": true, "reasoning": "same"}'] * len(f), **FAST)
    assert sorted(r.seq for r in kept.collect()) == [0, 200]


# --- groups as streams -------------------------------------------------------------------


class Counting(GroupJudge):
    """Notes how many members came, in which order, and the memory of its process."""

    def __init__(self):
        self.n, self.last, self.ordered, self.largest = 0, -1, True, 0

    def add(self, members):
        seq = members["seq"]
        self.ordered &= bool(seq.is_monotonic_increasing) and seq.iloc[0] > self.last
        self.n, self.last, self.largest = self.n + len(seq), seq.iloc[-1], max(self.largest, len(seq))

    def reply(self):
        import json
        import resource

        megabytes = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024
        return json.dumps({"is_duplicate": True, "reasoning": f"{self.n} {self.ordered} {self.largest} {megabytes}"})


def test_streams_give_the_verdicts_of_whole_groups(rows):
    class Streamed(GroupJudge):
        def __init__(self):
            self.kind = None

        def add(self, members):
            self.kind = members["description"].iloc[0]

        def reply(self):
            import pandas as pd

            return judge(pd.DataFrame({"records": [self.kind]}))[0]

    want = by_seq(dedupe(rows, "adjudicated", judge, **FAST), "is_duplicate", "dedupe_reasoning")
    assert by_seq(dedupe(rows, "adjudicated", Streamed, **FAST), "is_duplicate", "dedupe_reasoning") == want


def test_a_million_members_are_judged_whole_and_in_order(spark):
    n = 1_000_000
    hot = spark.range(n).select(
        F.col("id").cast("string").alias("txn_id"), F.col("id").alias("seq"), F.to_date(F.lit("2024-01-01")).alias("date"),
        F.lit(4.0).alias("amount"), F.lit("Coffee at the corner").alias("description"), F.lit("coffee at the corner").alias("normalized_desc"),
        F.lit("src").alias("source"), F.lit("f").alias("file"),
    )
    pairs = hot.filter("seq < 40").withColumns({"seq": F.col("seq") + n, "normalized_desc": F.concat(F.lit("tea "), F.floor(F.col("seq") / 2))})
    verdicts = adjudicate_streamed(group_members(hot.unionByName(pairs)), Counting, **FAST)
    got = {r.key_desc: r.reasoning.split(" ") for r in verdicts.collect()}
    assert len(got) == 21 and all(g[:2] == ["2", "True"] for k, g in got.items() if k.startswith("tea"))
    count, ordered, largest, megabytes = got["coffee at the corner"]
    assert (count, ordered) == (str(n), "True")
    assert int(largest) <= 10_000 and int(megabytes) < 1000


def test_streaming_tasks_follow_from_the_groups(spark, monkeypatch):
    """Calls are made per group, however many members there are."""
    from coinsieve.operators import enrich as en

    tasks, asked = [], en._asked
    monkeypatch.setattr(en, "_asked", lambda df: tasks.append(df.rdd.getNumPartitions()) or asked(df))
    rows = spark.range(6000).select(
        F.col("id").cast("string").alias("txn_id"), F.col("id").alias("seq"), F.to_date(F.lit("2024-01-01")).alias("date"),
        F.lit(4.0).alias("amount"), F.lit("x").alias("description"), F.concat(F.lit("tea "), F.col("id") % 40).alias("normalized_desc"),
        F.lit("src").alias("source"), F.lit("f").alias("file"),
    )
    verdicts = adjudicate_streamed(group_members(rows), Counting, **FAST).collect()
    assert tasks == [1] and len(verdicts) == 40
    assert all(r.reasoning.split(" ")[:2] == ["150", "True"] for r in verdicts)


def test_a_frame_that_fails_is_tried_again(rows):
    class Shaky(Counting):
        failed = False

        def add(self, members):
            if not self.failed:
                self.failed = True
                raise RuntimeError("once")
            super().add(members)

    kept = by_seq(dedupe(rows, "adjudicated", Shaky, attempts=2, wait=(0.0, 0.0)), "dedupe_reasoning")
    assert kept[0].startswith("Kept as primary. 2 True")
    lost = by_seq(dedupe(rows, "adjudicated", Shaky, **FAST), "dedupe_reasoning")
    assert lost[0] == "Kept as primary (fallback to basic deduplication due to error)"
