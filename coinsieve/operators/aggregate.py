"""Counts, distributions and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coinsieve.functions.text import percent
from coinsieve.functions.usage import cost_estimate, model_family, purpose, token_estimate
from coinsieve.operators.rows import LOW_CONFIDENCE, category_desc, is_uncategorized

# Fixed value: assumed price of one model call that a similarity match saves.
SAVED_PER_MATCH = 0.0001


def _rows():
    return F.count(F.lit(1))


def pattern_counts(df: DataFrame) -> DataFrame:
    return df.filter("normalized_desc IS NOT NULL").groupBy("normalized_desc").agg(_rows().alias("n"))


def category_pattern_counts(df: DataFrame) -> DataFrame:
    labelled = df.withColumn("category_desc", category_desc()).filter("category_desc IS NOT NULL")
    return labelled.groupBy("category_desc").agg(_rows().alias("n"))


def top_patterns(counts: DataFrame, label: str, k: int = 5) -> DataFrame:
    return counts.orderBy(F.col("n").desc(), F.col(label)).limit(k)


def category_distribution(df: DataFrame) -> DataFrame:
    """Count and share of all rows per category, largest first. Rows without a
    category have no line of their own but count in the whole."""
    counts = df.groupBy("category").agg(_rows().alias("n"))
    # The window runs over one row per category, so the input is read once.
    total = F.sum("n").over(Window.partitionBy())
    return (
        counts.withColumn("pct", percent(F.col("n"), total))
        .filter("category IS NOT NULL")
        .orderBy(F.col("n").desc(), "category")
    )


def confidence_summary(df: DataFrame, below: float = LOW_CONFIDENCE) -> DataFrame:
    low = F.count_if(F.col("confidence") < below)
    return df.agg(
        _rows().alias("n"),
        F.round(F.avg("confidence"), 4).alias("avg_confidence"),
        low.alias("low_n"),
        percent(low, _rows()).alias("low_pct"),
    )


def corrections_by_category(corrections: DataFrame) -> DataFrame:
    return corrections.groupBy("new_category").agg(_rows().alias("n"))


def uncategorized_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    count = F.count_if(is_uncategorized())
    earlier = before.agg(count.alias("n")).scalar()
    return after.agg(count.alias("after")).select(earlier.alias("before"), "after")


def match_type_stats(df: DataFrame, unit_cost: float = SAVED_PER_MATCH) -> DataFrame:
    """How rows were categorized, and what similarity matching saved."""
    counts = df.agg(
        *[F.count_if(F.col("match_type") == kind).alias(f"{kind}_n") for kind in ("exact", "fuzzy", "model")]
    )
    exact, fuzzy, model = F.col("exact_n"), F.col("fuzzy_n"), F.col("model_n")
    total = exact + fuzzy + model
    return counts.select(
        "exact_n", "fuzzy_n", "model_n",
        percent(exact, total).alias("exact_pct"),
        percent(fuzzy, total).alias("fuzzy_pct"),
        percent(model, total).alias("model_pct"),
        percent(fuzzy, exact + fuzzy).alias("fuzzy_of_rules_pct"),
        F.round(fuzzy * F.lit(unit_cost), 4).alias("estimated_saving"),
    )


def with_usage(call_log: DataFrame) -> DataFrame:
    """Add family, purpose, tokens and cost to model calls."""
    tokens = token_estimate(F.col("prompt_chars"), F.col("response_chars"))
    return call_log.withColumns(
        {
            "family": F.coalesce(model_family(F.col("model")), F.lit("other")),
            "purpose": purpose(F.coalesce("context", F.lit(""))),
            "tokens": tokens,
            "cost": cost_estimate(F.col("model"), tokens),
        }
    )


def usage_report(call_log: DataFrame) -> DataFrame:
    """Calls, tokens and cost by model family and purpose."""
    return (
        with_usage(call_log)
        .groupBy("family", "purpose")
        .agg(
            _rows().alias("calls"),
            F.sum("prompt_chars").alias("prompt_chars"),
            F.sum("response_chars").alias("response_chars"),
            F.round(F.sum("tokens"), 2).alias("tokens"),
            F.round(F.sum("cost"), 8).alias("cost"),
        )
    )
