"""Transactions from extracted statement tables.

Input rows: file, page, table_no, row_no, cells array<string>, page_text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinsieve.functions.parsing import strip_currency
from coinsieve.functions.text import file_stem
from coinsieve.operators.skew import skew_join
from coinsieve.sources.layouts import UNKNOWN, identify_table_source, page_source

# First cell of a table that is a heading.
HEADINGS = ["Transaction", "Trans.", "Date", ""]
# Fixed value: amount of a two-cell fee line, which names none itself.
FEE_DEFAULT = "0.47"

TABLE = ["file", "page", "table_no"]


def identify_source_text(pages: DataFrame) -> DataFrame:
    """Add ``source``: from the file name, else from the first page that names
    a bank; pages before that one stay Unknown, later ones keep its bank.

    Pages: file, page, page_text. The first naming page of a file is an
    aggregate, so a file with very many pages is not sorted in one task.
    """
    named = pages.select("file", "page", page_source(F.col("page_text")).alias("hit"))
    first = (
        named.filter("hit IS NOT NULL")
        .groupBy("file")
        .agg(F.min(F.struct("page", "hit")).alias("_first"))
    )
    stem = identify_table_source(file_stem(F.col("file")))
    later = F.when(F.col("page") >= F.col("_first.page"), F.col("_first.hit"))
    return (
        skew_join(pages, first, "file", ["file", "page"], "left")
        .withColumn("source", F.when(stem != UNKNOWN, stem).otherwise(F.coalesce(later, F.lit(UNKNOWN))))
        .drop("_first")
    )


def drop_header_tables(cells: DataFrame) -> DataFrame:
    """Leave out whole tables whose first cell is a heading."""
    first = cells.groupBy(*TABLE).agg(F.min(F.struct("row_no", F.get("cells", F.lit(0)).alias("cell"))).alias("top"))
    headed = first.filter(F.coalesce(F.col("top.cell"), F.lit("-")).isin(HEADINGS)).select(*TABLE)
    return skew_join(cells, headed, TABLE, [*TABLE, "row_no"], "left_anti")


def _filled(*cols: Column) -> Column:
    test = F.lit(True)
    for col in cols:
        test = test & F.coalesce(col != "", F.lit(False))
    return test


def complete_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.filter(_filled(*[F.col(c) for c in columns]))


def shape_rows(cells: DataFrame, source: str | None = None, fee_default: str = FEE_DEFAULT) -> DataFrame:
    """(raw_date, description, raw_amount) of the rows that hold a transaction.

    ``source`` names the layout of all rows; without it the column ``source``
    decides row by row. Sources without a layout give no rows.
    """
    df = cells.withColumn("source", F.lit(source)) if source else cells
    size, row = F.size("cells"), [F.get("cells", F.lit(i)) for i in range(6)]

    def shaped(date: Column, text: Column, amount: Column) -> Column:
        return F.struct(
            date.alias("raw_date"), text.alias("description"), strip_currency(amount).alias("raw_amount")
        )

    undated = F.regexp_replace(row[0], r"^\$+|\$+$", "")
    posted = F.when(_filled(row[1]), row[1]).otherwise(row[0])
    apple = F.when(
        (size == 3) & F.contains(row[1], F.lit("ACH Deposit")), shaped(undated, row[1], row[2])
    ).when((size == 4) & _filled(row[3]), shaped(undated, row[1], row[3]))
    boa = F.when((size >= 6) & _filled(row[1], row[2], row[5]), shaped(row[1], row[2], row[5]))
    citi = F.when(
        (size == 4) & _filled(posted, row[2], row[3]), shaped(posted, row[2], row[3])
    ).when(
        (size == 2) & F.contains(row[1], F.lit("FEE")), shaped(row[0], row[1], F.lit(fee_default))
    )
    picked = (
        F.when(F.col("source") == "Apple", apple)
        .when(F.col("source") == "BoA", boa)
        .when(F.col("source") == "Citi", citi)
    )
    return (
        df.withColumn("_row", picked)
        .filter("_row IS NOT NULL")
        .select(*[c for c in df.columns if c not in ("cells", "page_text")], "_row.*")
    )


def statement_rows(cells: DataFrame) -> DataFrame:
    """Typed-as-text transactions of all extracted tables: bank by file or page
    text, heading tables left out, rows shaped by the bank's layout. A page
    without tables is a row without cells; its text still names the bank."""
    return shape_rows(drop_header_tables(identify_source_text(cells)))
