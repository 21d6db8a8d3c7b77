"""Dates, amounts and signs from raw text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from coinsieve.functions.text import strip

DATE_FORMATS = ["M/d/yyyy", "yyyy-M-d", "M/d/yy", "yyyy/M/d", "d-MMM-yyyy", "MMM d, yyyy"]
SINK_DATE = "MM/dd/yyyy"


def parse_date(col: Column, formats: list[str] | None = None) -> Column:
    """First format that fits the value decides; NULL when none does."""
    text = strip(col)
    return F.coalesce(
        *[F.try_to_timestamp(text, F.lit(fmt)).cast("date") for fmt in formats or DATE_FORMATS]
    )


def format_date(col: Column) -> Column:
    return F.date_format(col, SINK_DATE)


def strip_currency(col: Column) -> Column:
    """'-$1,234.50' -> '-1234.50'."""
    return F.translate(col, "$,", "")


def parse_amount(col: Column) -> Column:
    """Plain decimal or exponent notation to double, anything else NULL."""
    text = strip(col)
    return F.when(
        text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
        text.try_cast("double"),
    )


def net_amount(debit: Column, credit: Column, sign: str = "debit") -> Column:
    """Signed amount of a split pair; 'debit' counts spending as positive."""
    out, into = F.coalesce(debit, F.lit(0.0)), F.coalesce(credit, F.lit(0.0))
    return out - into if sign == "debit" else into - out


def default_day_range(col: Column) -> Column:
    return F.coalesce(col, F.array(F.lit(1), F.lit(31)))


def day_window(date: Column, margin: int = 2) -> Column:
    """[day - margin, day + margin] kept inside 1..31."""
    day = F.dayofmonth(date)
    return F.when(
        day.isNotNull(),
        F.array(F.greatest(F.lit(1), day - margin), F.least(F.lit(31), day + margin)),
    )


# Answers that mean the whole month.
WHOLE_MONTH = ["any", "all", "full", "month", "every"]


def parse_day_range(answer: Column, date: Column) -> Column:
    """'any' -> [1,31]; 'a-b' -> [a,b]; anything else -> the day +-2."""
    low = F.regexp_extract(answer, r"^\s*([+]?\d+)\s*-\s*([+]?\d+)\s*$", 1).try_cast("int")
    high = F.regexp_extract(answer, r"^\s*([+]?\d+)\s*-\s*([+]?\d+)\s*$", 2).try_cast("int")
    return (
        F.when(F.lower(answer).rlike("|".join(WHOLE_MONTH)), F.array(F.lit(1), F.lit(31)))
        .when(low.isNotNull() & high.isNotNull(), F.array(low, high))
        .otherwise(day_window(date))
    )
