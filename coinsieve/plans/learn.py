"""Rule learning from everything that is known about a result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinsieve.operators.mining import (
    mine_corrections, mine_low_confidence, mine_uncategorized, ordered_suggestions,
)
from coinsieve.operators.order import append_rules, first_of_each, new_rules_only
from coinsieve.operators.rows import confident

FIELDS = ["description", "amount", "day_range", "category", "confidence", "reasoning", "support"]


def learn_rules(
    df: DataFrame, rules: DataFrame, corrections: DataFrame | None = None, min_support: int = 3
) -> DataFrame:
    """Rules with those learned from uncategorized rows, low-confidence rows and
    corrections appended in that order; known text-category pairs are skipped."""
    sources = [
        mine_uncategorized(df, confident(df), min_support),
        mine_low_confidence(df, min_support),
    ]
    if corrections is not None:
        sources.append(mine_corrections(corrections, min_support))
    # An earlier source comes first whatever the support.
    mined = None
    for tier, part in enumerate(sources):
        tagged = part.select(*FIELDS, F.lit(-tier).alias("tier"))
        mined = tagged if mined is None else mined.unionByName(tagged)
    return append_rules(rules, new_rules_only(number_learned(mined), rules))


def number_learned(mined: DataFrame) -> DataFrame:
    """One suggestion per text and category, numbered by source and support."""
    rank = F.struct(-F.col("tier"), -F.col("support"), F.col("description"), F.col("category"))
    single = first_of_each(mined.withColumn("_rank", rank), "_rank").drop("_rank")
    # Sources are far apart in the sort key, so support orders within a source.
    keyed = single.withColumn("support", F.col("support") + F.col("tier").cast("bigint") * F.lit(1 << 60))
    return ordered_suggestions(keyed)
