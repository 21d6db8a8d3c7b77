"""Ordering, batches, samples and rule lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coinsieve.operators.rows import confident, review_candidates
from coinsieve.operators.skew import with_row_number

BATCH_SIZE = 50
EXAMPLES_USED = 3
EXAMPLE_POOL = 5


def review_queue(df: DataFrame) -> DataFrame:
    """Rows to review, least confident first, categories together."""
    return review_candidates(df).orderBy("confidence", "category", "seq")


def batched(df: DataFrame, order: str, n: int = BATCH_SIZE) -> DataFrame:
    """Add ``batch``: consecutive groups of n rows in the given order."""
    numbered = with_row_number(df, [F.col(order)], "_rn")
    return numbered.withColumn("batch", F.floor((F.col("_rn") - 1) / n).cast("bigint")).drop("_rn")


def sample_examples(df: DataFrame, k: int = 2, seed: str = "", key: str = "txn_id") -> DataFrame:
    """At most k confident rows per category, chosen by a hash of their id.

    Spark keeps the first k of each category before the shuffle, so a large
    category does not travel to one task.
    """
    draw = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    w = Window.partitionBy("category").orderBy(draw, key)
    return confident(df).withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k).drop("_rank")


def few_shot(
    static: DataFrame, corrections: DataFrame, k: int = EXAMPLES_USED, pool: int = EXAMPLE_POOL
) -> DataFrame:
    """(category, rank, example): corrections first, then the fixed examples.

    ``static``: category, rank, example. ``corrections``: new_category, seq,
    description, amount. The pool of a category holds its fixed examples and as
    many corrections as still fit; k of it are used.
    """
    told = corrections.filter(
        "description IS NOT NULL AND description <> '' AND amount IS NOT NULL AND amount <> 0"
    ).select(
        F.col("new_category").alias("category"), F.col("seq").alias("at"),
        F.format_string("%s $%.2f", "description", "amount").alias("example"),
    )
    room = static.groupBy("category").agg((F.lit(pool) - F.count(F.lit(1))).alias("room"))
    # Spark keeps the first rows of each category before the shuffle.
    by_order = Window.partitionBy("category").orderBy("at")
    first = told.withColumn("n", F.row_number().over(by_order)).filter(F.col("n") <= pool)
    fitting = first.join(room, "category").filter(F.col("n") <= F.col("room"))
    both = fitting.select("category", "example", F.lit(0).alias("tier"), "at").unionByName(
        static.select("category", "example", F.lit(1).alias("tier"), F.col("rank").cast("bigint").alias("at"))
    )
    w = Window.partitionBy("category").orderBy("tier", "at")
    return (
        both.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select("category", "rank", "example")
    )


def static_examples(spark: SparkSession, examples: dict[str, list[str]]) -> DataFrame:
    """Example transactions for prompts, by category, in the given order."""
    rows = [
        (category, rank, text)
        for category, texts in examples.items()
        for rank, text in enumerate(texts, 1)
    ]
    return spark.createDataFrame(rows, "category string, rank bigint, example string")


def load_examples(spark: SparkSession, path: str) -> DataFrame:
    """``static_examples`` from a JSON file ``{"Category": ["example", ...]}``."""
    listed = spark.read.text(path, wholetext=True).select(
        F.explode(F.from_json("value", "map<string,array<string>>")).alias("category", "texts")
    )
    return listed.select("category", F.posexplode("texts").alias("at", "example")).select(
        "category", (F.col("at") + 1).cast("bigint").alias("rank"), "example"
    )


def new_rules_only(suggestions: DataFrame, rules: DataFrame) -> DataFrame:
    """Suggestions whose text and category no rule has yet."""
    known = rules.select(F.col("description").alias("_d"), F.col("category").alias("_c")).distinct()
    same = F.col("description").eqNullSafe(F.col("_d")) & F.col("category").eqNullSafe(F.col("_c"))
    return suggestions.join(known, same, "left_anti")


def first_of_each(suggestions: DataFrame, order: str = "suggestion_ord") -> DataFrame:
    """One suggestion per text and category: the earliest."""
    row = F.struct(*suggestions.columns)
    return (
        suggestions.groupBy("description", "category")
        .agg(F.min_by(row, order).alias("row"))
        .select("row.*")
    )


def append_rules(rules: DataFrame, new: DataFrame, order: str = "suggestion_ord") -> DataFrame:
    """Rules followed by the new ones, so existing rules keep winning."""
    last: Column = F.coalesce(rules.agg(F.max("rule_ord").alias("m")).scalar(), F.lit(-1))
    added = new.select(
        (last + 1 + F.col(order)).cast("bigint").alias("rule_ord"),
        "description", "amount", "day_range", "category",
    )
    return rules.select("rule_ord", "description", "amount", "day_range", "category").unionByName(added)
