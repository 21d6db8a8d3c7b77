"""Identity, cache and grouping keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinsieve.functions.parsing import format_date

KEY_PARTS = ["key_date", "key_amount", "key_desc"]


def cents(amount: Column) -> Column:
    """Amount with two decimals as text, equal in every engine."""
    return F.round(amount, 2).cast("decimal(18,2)").cast("string")


def txn_key(date: Column, description: Column, amount: Column) -> Column:
    """'MM/DD/YYYY:description:amount', NULL when a part is."""
    return F.concat(format_date(date), F.lit(":"), description, F.lit(":"), cents(amount))


def with_dedupe_key(df: DataFrame) -> DataFrame:
    """Three key columns; all NULL when the date or the text is unknown.

    The amount takes part without its sign, so a charge and its refund meet.
    """
    known = F.col("date").isNotNull() & F.col("normalized_desc").isNotNull()
    return df.withColumns(
        {
            "key_date": F.when(known, F.col("date")),
            "key_amount": F.when(known, F.abs("amount")),
            "key_desc": F.when(known, F.col("normalized_desc")),
        }
    )


def description_key(description: Column) -> Column:
    return F.md5(description)


def prompt_key(model: Column, prompt: Column) -> Column:
    return F.md5(F.concat(model, prompt))


def simple_key(description: Column, amount: Column, date: Column) -> Column:
    return F.md5(F.concat(description, cents(amount), format_date(date)))


def full_key(df_cols: list[Column], rules_hash: Column) -> Column:
    """Row content plus rule fingerprint, so new rules invalidate old entries."""
    parts = [F.coalesce(c.cast("string"), F.lit("\u0000")) for c in df_cols]
    return F.md5(F.concat_ws("\u0001", *parts, rules_hash))


def rules_fingerprint(rules: DataFrame) -> DataFrame:
    """Digest of an ordered rule list."""
    days = F.concat_ws("-", F.col("day_range").cast("array<string>"))
    return fingerprint(
        rules,
        [F.col("rule_ord"), F.col("description"), cents(F.col("amount")), days, F.col("category")],
    )


def keywords_fingerprint(keywords: DataFrame) -> DataFrame:
    """Digest of an ordered keyword table."""
    return fingerprint(keywords, [F.col(c) for c in ("cat_ord", "kw_ord", "category", "keyword")])


def fingerprint(df: DataFrame, columns: list[Column], name: str = "fingerprint") -> DataFrame:
    """One-row digest of a whole table that partial aggregation can build.

    Each row becomes a 60-bit number from its md5; the table's digest is the
    md5 of their count and sum. Row order counts only through an order column.
    """
    row = F.md5(
        F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("-")) for c in columns])
    )
    number = F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(
        F.md5(
            F.concat_ws(
                ":",
                F.count(F.lit(1)).cast("string"),
                F.coalesce(F.sum(number), F.lit(0)).cast("string"),
            )
        ).alias(name)
    )
