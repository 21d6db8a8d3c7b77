"""Joins and numbering with hot keys, under several partition counts."""

import pytest
from pyspark.sql import functions as F

from coinsieve.operators.dedupe import (
    dedupe_exact, duplicate_groups, flag_duplicates,
)
from coinsieve.operators.skew import attach, hot_keys, skew_join, with_row_number


@pytest.fixture(scope="module")
def left(spark):
    """One key has a third of all rows, some keys are NULL."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 17 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))
    )
    return spark.range(3000).select("id", key.alias("key")).cache()


@pytest.fixture(scope="module")
def right(spark):
    return spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), (None, 4), ("zz", 5)], "key string, v int")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("rows_per_task", [7, 100, 1_000_000])
def test_skew_join_equals_join(left, right, how, rows_per_task):
    got = skew_join(left, right, "key", "id", how, rows_per_task)
    want = left.join(right, "key", how)
    assert rows(got.select(*want.columns)) == rows(want)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_null_safe_skew_join_matches_nulls(left, right, how):
    got = skew_join(left, right, "key", "id", how, 10, null_safe=True)
    other = right.withColumnRenamed("key", "k2")
    want = left.join(other, F.col("key").eqNullSafe(F.col("k2")), how).select("id", "key", "v")
    assert rows(got.select("id", "key", "v")) == rows(want)


def test_hot_keys_are_spread_over_tasks(left):
    """1000 rows of the hot key and 118 of the NULL key, 100 rows per task."""
    assert sorted(hot_keys(left, ["key"], 100).values()) == [2, 10]
    assert hot_keys(left, ["key"], 10_000) == {}


def test_attach_equals_join(left, right):
    assert rows(attach(left, right, "key", "id").select("id", "key", "v")) == rows(left.join(right, "key", "left").select("id", "key", "v"))


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_row_numbers_are_global(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("x"))
        got = with_row_number(df, [F.col("x").desc()], "n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = {r.x: i for i, r in enumerate(sorted(got, key=lambda r: -r.x), 1)}
    assert {r.x: r.n for r in got} == want


def test_hot_keys_leave_no_task_with_all_rows_of_a_key(spark):
    """200,000 rows of two short keys; tasks are neither one per key nor merged by size."""
    rows = spark.range(200_000).select("id", F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("key"))
    names = spark.createDataFrame([("a", 1), ("b", 2)], "key string, value int")
    got = skew_join(rows, names, "key", "id", "left")
    per_task = got.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert sum(r.n for r in per_task) == 200_000
    assert max(r.n for r in per_task) < 150_000
    assert got.filter("value = if(key = 'a', 1, 2)").count() == 200_000


def test_a_join_has_as_many_tasks_as_its_rows_ask_for(spark):
    rows = spark.range(3000).select("id", (F.col("id") % 2).alias("key"))
    names = spark.createDataFrame([(0, 1), (1, 2)], "key bigint, value int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 2)
    try:
        got = skew_join(rows, names, "key", "id", "left", rows_per_task=50)
        per_task = got.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(r.n for r in per_task) == 3000
    assert len(per_task) > 4 and max(r.n for r in per_task) < 1500


def test_row_numbers_of_an_empty_table(spark):
    assert with_row_number(spark.range(0), [F.col("id")]).count() == 0


@pytest.fixture
def copies(txns):
    return txns(
        [("Coffee", 4.0, "2024-01-01")] * 60 + [("Tea", 2.0, "2024-01-01"), ("Tea", -2.0, "2024-01-01"), ("Milk", 1.0, "2024-01-02")]
    )


def test_hot_group_is_flagged_with_salted_keys(copies):
    got = flag_duplicates(copies, rows_per_task=5)
    assert got.filter("is_duplicate").count() == 62
    assert got.count() == 63


def test_hot_group_comes_in_parts_and_whole(copies):
    parts = duplicate_groups(copies, members_per_part=10, rows_per_task=5).collect()
    coffee = [p for p in parts if p.key_desc == "coffee"]
    assert len(coffee) > 1
    members = sorted(m.seq for p in coffee for m in p.members)
    assert members == list(range(60))
    assert {p.n for p in coffee} == {60} and {p.first_seq for p in coffee} == {0}


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_dedupe_keeps_the_first_under_any_partitioning(spark, copies, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = sorted(r.seq for r in dedupe_exact(copies.repartition(partitions, "seq")).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == [0, 60, 62]
