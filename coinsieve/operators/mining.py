"""New rules from categorized, corrected and unmatched transactions.

Every step is an aggregate over (token, category), which partial aggregation
combines before the shuffle; a token in a third of all rows costs no more than
a rare one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinsieve.functions.jsonfix import parse_suggestions
from coinsieve.functions.parsing import default_day_range, parse_day_range
from coinsieve.functions.review import affirmative
from coinsieve.functions.text import first_word, tokens
from coinsieve.operators.order import append_rules, first_of_each, new_rules_only
from coinsieve.operators.rows import enough_evidence, low_confidence, uncategorized
from coinsieve.operators.skew import with_row_number
from coinsieve.schema import UNCATEGORIZED

MIN_SUPPORT = 3
# Least confidence of a suggestion, and the one assumed when it
# names none, by where it comes from.
MIN_CONFIDENCE = {"uncategorized": None, "corrections": 0.85, "low_confidence": 0.8}
DEFAULT_CONFIDENCE = {"uncategorized": 0.8, "corrections": 0.9, "low_confidence": 0.85}

TOKEN_FACTS = ["support", "amount", "low", "high"]


def _by_token(df: DataFrame) -> DataFrame:
    return df.withColumn("token", F.explode(tokens(F.lower("normalized_desc"))))


def _token_facts() -> list[Column]:
    """Support, the amount if it is always the same, and the span of days."""
    same = (F.min("amount") == F.max("amount")) & (F.count("amount") == F.count(F.lit(1)))
    day = F.dayofmonth("date")
    return [
        F.count(F.lit(1)).alias("support"),
        F.when(same, F.min("amount")).alias("amount"),
        F.min(day).alias("low"),
        F.max(day).alias("high"),
    ]


def _majority(df: DataFrame, label: str) -> DataFrame:
    """(token, category, n, total): the most frequent label of each token."""
    counts = _by_token(df).groupBy("token", label).agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by(label, F.struct("n", F.col(label))).alias("category")
    return counts.groupBy("token").agg(best, F.max("n").alias("n"), F.sum("n").alias("total"))


def _as_rules(found: DataFrame, reasoning: str) -> DataFrame:
    """Suggestions with facts; the span is the whole month when unknown."""
    days = F.when(F.col("low").isNotNull(), F.array("low", "high"))
    return found.select(
        F.col("token").alias("description"),
        "amount",
        default_day_range(days).alias("day_range"),
        "category",
        F.round(F.col("confidence"), 4).alias("confidence"),
        F.format_string(reasoning, "support").alias("reasoning"),
        "support",
    )


def mine_uncategorized(
    df: DataFrame, confident: DataFrame, min_support: int = MIN_SUPPORT, min_conf: float = 0.7
) -> DataFrame:
    """Tokens of uncategorized rows, with the category that confident rows with
    the same token mostly have."""
    facts = _by_token(uncategorized(df)).groupBy("token").agg(*_token_facts())
    votes = _majority(confident, "category").withColumn("confidence", F.col("n") / F.col("total"))
    found = facts.filter(F.col("support") >= min_support).join(
        votes.filter(F.col("confidence") >= min_conf).select("token", "category", "confidence"), "token"
    )
    return _as_rules(found, "Token of %d uncategorized rows")


def _mine_pure(df: DataFrame, label: str, min_support: int, min_conf: float, reasoning: str) -> DataFrame:
    """Tokens that nearly always go with one label."""
    votes = _majority(df, label).withColumn("confidence", F.col("n") / F.col("total"))
    pure = votes.filter((F.col("confidence") >= min_conf) & (F.col("n") >= min_support)).filter(
        F.col("category") != UNCATEGORIZED
    )
    facts = _by_token(df).groupBy("token", F.col(label).alias("category")).agg(*_token_facts())
    return _as_rules(pure.select("token", "category", "confidence").join(facts, ["token", "category"]), reasoning)


def mine_corrections(
    corrections: DataFrame, min_support: int = MIN_SUPPORT, min_conf: float = 0.85
) -> DataFrame:
    return _mine_pure(corrections, "new_category", min_support, min_conf, "Token of %d corrected rows")


def mine_low_confidence(
    df: DataFrame, min_support: int = MIN_SUPPORT, min_conf: float = 0.8
) -> DataFrame:
    """From rows with a category but little confidence, if there are enough."""
    rows = enough_evidence(low_confidence(df).filter("category IS NOT NULL"))
    return _mine_pure(rows, "category", min_support, min_conf, "Token of %d low-confidence rows")


def ordered_suggestions(mined: DataFrame) -> DataFrame:
    """Number mined rules: best supported first, then by text."""
    order = [F.col("support").desc(), F.col("description"), F.col("category")]
    numbered = with_row_number(mined, order, "_n")
    return numbered.withColumn("suggestion_ord", (F.col("_n") - 1).cast("bigint")).drop("_n")


def clear_consumed(corrections: DataFrame, learned: DataFrame) -> DataFrame:
    """Corrections still to be used: none once a rule came out of them."""
    n = learned.agg(F.count(F.lit(1)).alias("n")).scalar()
    return corrections.filter(n == 0)


def rules_from_corrections(corrections: DataFrame) -> DataFrame:
    """One rule per correction: first word, optionally the amount, day +-2.

    Optional columns: keyword, with_amount, days (answers of the review).
    """
    answers = {c: F.col(c) if c in corrections.columns else F.lit(None).cast("string")
               for c in ("keyword", "with_amount", "days")}
    word = F.coalesce(F.when(answers["keyword"] != "", answers["keyword"]), first_word(F.col("description")))
    return corrections.select(
        "txn_id", "seq",
        word.alias("description"),
        F.when(F.coalesce(affirmative(answers["with_amount"]), F.lit(False)), F.col("amount")).alias("amount"),
        parse_day_range(F.coalesce(answers["days"], F.lit("")), F.col("date")).alias("day_range"),
        F.col("new_category").alias("category"),
    )


def parse_replies(replies: DataFrame, order: str = "reply_ord") -> DataFrame:
    """One suggestion per object in reply texts; other values are left out."""
    item = F.col("item")
    objects = replies.select(
        F.col(order), F.posexplode(parse_suggestions(F.col("text"))).alias("pos", "item")
    ).filter(F.startswith(F.schema_of_variant(item), F.lit("OBJECT")))

    def field(name: str, kind: str) -> Column:
        return F.try_variant_get(item, f"$.{name}", kind).alias(name)

    return objects.select(
        order, "pos", field("description", "string"), field("amount", "double"),
        field("day_range", "array<int>"), field("category", "string"),
        field("confidence", "double"), field("reasoning", "string"),
    )


def valid_suggestions(
    suggestions: DataFrame, min_confidence: float | None = None, default_confidence: float = 0.8
) -> DataFrame:
    """Suggestions with a real category, a text and enough confidence."""
    score = F.coalesce("confidence", F.lit(default_confidence))
    kept = suggestions.filter(
        "category IS NOT NULL AND category <> '' AND description IS NOT NULL"
    ).filter(F.col("category") != UNCATEGORIZED)
    kept = kept.withColumns(
        {
            "confidence": score,
            "reasoning": F.coalesce("reasoning", F.lit("Pattern identified in transactions")),
            "day_range": default_day_range(F.col("day_range")),
        }
    )
    return kept if min_confidence is None else kept.filter(F.col("confidence") >= min_confidence)


def ingest_suggestions(
    replies: DataFrame,
    rules: DataFrame,
    origin: str = "uncategorized",
    dedupe: bool | None = None,
    min_confidence: float | None = None,
) -> DataFrame:
    """Rules with the valid suggestions of reply texts appended.

    ``origin`` sets the defaults: suggestions from uncategorized rows are taken
    as they come, the other origins have a confidence limit and skip rules that
    exist already.
    """
    least = MIN_CONFIDENCE[origin] if min_confidence is None else min_confidence
    valid = valid_suggestions(parse_replies(replies), least, DEFAULT_CONFIDENCE[origin])
    numbered = with_row_number(valid, [F.col("reply_ord"), F.col("pos")], "_n").withColumn(
        "suggestion_ord", F.col("_n") - 1
    )
    if dedupe if dedupe is not None else origin != "uncategorized":
        numbered = new_rules_only(first_of_each(numbered.drop("_n")), rules)
    return append_rules(rules, numbered)
