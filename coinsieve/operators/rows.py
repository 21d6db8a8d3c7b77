"""Row-level projections and filters on transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinsieve.functions.keys import txn_key
from coinsieve.functions.text import fixed_point, normalize_description
from coinsieve.schema import UNCATEGORIZED

# Confidence limits.
LOW_CONFIDENCE = 0.7
REVIEW_BELOW = 0.8
CONFIDENT_FROM = 0.9
MIN_EVIDENCE = 3


def ensure_columns(df: DataFrame, schema: str) -> DataFrame:
    """Add the columns of a schema that are missing, filled with NULL."""
    missing = [f for f in T.StructType.fromDDL(schema).fields if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df


def normalized(df: DataFrame) -> DataFrame:
    return df.withColumn("normalized_desc", normalize_description(F.col("description")))


def with_txn_key(df: DataFrame) -> DataFrame:
    return df.withColumn("txn_key", txn_key(F.col("date"), F.col("description"), F.col("amount")))


def category_desc() -> Column:
    return F.concat(F.col("category"), F.lit(": "), F.col("normalized_desc"))


def is_uncategorized() -> Column:
    return F.coalesce(F.col("category") == UNCATEGORIZED, F.lit(False))


def reset_uncategorized(df: DataFrame) -> DataFrame:
    """Forget the result of uncategorized rows, so they can be tried again."""
    kept = {
        c: F.when(~is_uncategorized(), F.col(c)) for c in ("category", "confidence", "reasoning")
    }
    return df.withColumns(kept)


def uncategorized(df: DataFrame) -> DataFrame:
    return df.filter(F.col("category") == UNCATEGORIZED)


def low_confidence(df: DataFrame, below: float = LOW_CONFIDENCE) -> DataFrame:
    """Low score but a category; a NULL category is not the default label."""
    return df.filter(
        (F.col("confidence") < below) & ~F.col("category").eqNullSafe(F.lit(UNCATEGORIZED))
    )


def review_candidates(df: DataFrame, below: float = REVIEW_BELOW) -> DataFrame:
    return df.filter(F.col("confidence") < below)


def confident(df: DataFrame, least: float = CONFIDENT_FROM) -> DataFrame:
    return df.filter((F.col("confidence") >= least) & (F.col("category") != UNCATEGORIZED))


def pending(df: DataFrame) -> DataFrame:
    return df.filter(F.col("category").isNull() | F.col("confidence").isNull())


def enough_evidence(df: DataFrame, *also: DataFrame, least: int = MIN_EVIDENCE) -> DataFrame:
    """All rows when the tables hold enough of them together, else none."""
    counts = [t.agg(F.count(F.lit(1)).alias("n")).scalar() for t in (df, *also)]
    total = counts[0]
    for n in counts[1:]:
        total = total + n
    return df.filter(total >= least)


def confidence_gate(df: DataFrame, least: float = REVIEW_BELOW, when: Column | None = None) -> DataFrame:
    """Results below the limit become uncategorized; score and reason stay."""
    weak = F.col("confidence") < least
    if when is not None:
        weak = weak & when
    reason = F.concat(
        F.lit("Low confidence ("), fixed_point(F.col("confidence")), F.lit(") for '"),
        F.coalesce(F.col("category"), F.lit("None")), F.lit("'. Original reasoning: "),
        F.coalesce(F.col("reasoning"), F.lit("None")),
    )
    return df.withColumns(
        {
            "category": F.when(weak, F.lit(UNCATEGORIZED)).otherwise(F.col("category")),
            "reasoning": F.when(weak, reason).otherwise(F.col("reasoning")),
        }
    )


def filter_log(df: DataFrame, level: str = "ALL", contains: str | None = None) -> DataFrame:
    """Log records of a level whose line holds a text."""
    if level != "ALL":
        df = df.filter(F.col("level") == level)
    return df.filter(F.contains("value", F.lit(contains))) if contains else df


def tail_log(df: DataFrame, n: int = 50, place: tuple[str, ...] = ("file", "block", "line_no")) -> DataFrame:
    """The last n records, oldest first."""
    last = df.orderBy(*[F.col(c).desc() for c in place]).limit(n)
    return last.orderBy(*place)
