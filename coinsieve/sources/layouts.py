"""Column layouts of statement exports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from coinsieve.functions.parsing import net_amount, parse_amount, strip_currency
from coinsieve.functions.text import contains_any


@dataclass(frozen=True)
class Layout:
    """Which columns of an export hold the date, the text and the amount."""

    source: str
    date: str
    description: str
    amount: str | None = None
    debit: str | None = None
    credit: str | None = None
    sign: str = "debit"

    @property
    def required(self) -> list[str]:
        money = [self.amount] if self.amount else [self.debit, self.credit]
        return [self.date, self.description, *money]


# Header names of the known exports.
LAYOUTS = {
    "boa": Layout("BoA", "Posted Date", "Payee", "Amount"),
    "sfcu": Layout("SFCU", "Post Date", "Description", debit="Debit", credit="Credit"),
    "citi": Layout("Citi", "Posted Date", "Payee", "Amount"),
    "chase": Layout("Chase", "Transaction Date", "Description", "Amount"),
    "amex": Layout("AMEX", "Date", "Description", "Amount"),
    "discover": Layout("Discover", "Trans. Date", "Description", "Amount"),
    "capital_one": Layout("Capital One", "Transaction Date", "Description", "Debit"),
}

# Parts of a file stem that name the bank, tested in this order.
STEM_MARKS = [
    (["boa", "estmt"], "BoA"),
    (["sfcu", "accounthistory"], "SFCU"),
    (["citi"], "Citi"),
    (["chase"], "Chase"),
    (["amex", "american"], "AMEX"),
    (["discover"], "Discover"),
    (["capital", "cap1"], "Capital One"),
]
# The same for extracted statement tables.
TABLE_STEM_MARKS = [
    (["apple"], "Apple"),
    (["estmt", "boa"], "BoA"),
    (["sfcu"], "SFCU"),
    (["citi"], "Citi"),
]
# Page text that names the bank, tested in this order.
PAGE_MARKS = [("Citi", "Citi"), ("Bank of America", "BoA")]
UNKNOWN = "Unknown"

# Parts of column names that tell what a column holds.
DATE_MARKS = ["date", "post"]
TEXT_MARKS = ["desc", "payee", "narration"]
AMOUNT_MARKS = ["amount", "debit", "credit"]


def _first_mark(stem: Column, marks: list[tuple[list[str], str]]) -> Column:
    name = F.lower(stem)
    return F.coalesce(
        *[F.when(contains_any(name, words), F.lit(source)) for words, source in marks],
        F.lit(UNKNOWN),
    )


def identify_source(stem: Column) -> Column:
    return _first_mark(stem, STEM_MARKS)


def identify_table_source(stem: Column) -> Column:
    return _first_mark(stem, TABLE_STEM_MARKS)


def page_source(page_text: Column) -> Column:
    return F.coalesce(
        *[F.when(F.contains(page_text, F.lit(mark)), F.lit(source)) for mark, source in PAGE_MARKS]
    )


def quoted(name: str) -> Column:
    """Column by its literal name, dots included."""
    return F.col(f"`{name}`")


def infer_layout(columns: list[str], source: str = UNKNOWN) -> Layout | None:
    """Layout from column names; None when a part is missing.

    With both a debit and a credit column and no amount column the two are
    netted (credit - debit), otherwise the first amount-like column counts.
    """

    def first(marks: list[str]) -> str | None:
        return next((c for c in columns if any(m in c.lower() for m in marks)), None)

    date, text, money = first(DATE_MARKS), first(TEXT_MARKS), first(AMOUNT_MARKS)
    if not (date and text and money):
        return None
    debit, credit = first(["debit"]), first(["credit"])
    if debit and credit and not first(["amount"]):
        return Layout(source, date, text, debit=debit, credit=credit, sign="credit")
    return Layout(source, date, text, money)


def raw_amount(layout: Layout, cell, net_credit: bool = False) -> Column:
    """Amount of one row; ``cell`` turns a header name into a column."""
    def money(name: str) -> Column:
        return parse_amount(strip_currency(cell(name)))

    if layout.amount and not (net_credit and layout.credit):
        return money(layout.amount)
    return net_amount(money(layout.debit), money(layout.credit), layout.sign)
