"""Batch review: a queue, a table of answers, and what follows from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinsieve.functions.review import affirmative, intent, mentioned_category, suggested_category
from coinsieve.operators.cache import apply_corrections
from coinsieve.operators.mining import rules_from_corrections
from coinsieve.operators.rows import review_candidates

PLACE = ["confidence", "category", "seq"]


def review_items(df: DataFrame) -> DataFrame:
    """Rows to review with the category the model had thought of."""
    return review_candidates(df).withColumn("suggested", suggested_category(F.col("reasoning")))


def read_answers(df: DataFrame, responses: DataFrame) -> DataFrame:
    """Queue rows with intent and chosen category, up to the first quit.

    Responses: txn_id, response and optionally entry (asked-for category).
    """
    entry = F.col("entry") if "entry" in responses.columns else None
    heard = review_candidates(df).join(responses, "txn_id")
    read = heard.withColumn("intent", intent(F.col("response"))).withColumn(
        "new_category", F.when(F.col("intent") == "change", mentioned_category(F.col("response"), entry))
    )
    place = F.struct(*PLACE)
    stop = read.filter("intent = 'quit'").agg(F.min(place).alias("p")).scalar()
    return read.filter(stop.isNull() | (place < stop))


def review_batch(df: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with corrections applied, corrections, rules to add).

    A rule comes out of each correction whose ``make_rule`` answer is a yes.
    """
    answers = read_answers(df, responses).filter("intent = 'change'")
    corrections = answers.withColumns(
        {"original_category": F.col("category"), "correction_ord": F.col("seq")}
    )
    applied = apply_corrections(df, corrections)
    wanted = corrections
    if "make_rule" in responses.columns:
        wanted = corrections.filter(F.coalesce(affirmative(F.col("make_rule")), F.lit(False)))
    return applied, corrections, rules_from_corrections(wanted)
