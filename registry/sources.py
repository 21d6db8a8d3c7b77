"""Statement files, extracted tables, rule files and report files.

The files are written by Spark from the given tables into the shared folder
and read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from coinsieve.operators.match import match_rules
from coinsieve.plans.dedupe import dedupe
from coinsieve.plans.run import prior_as_txns, run
from coinsieve.session import release, scratch_path
from coinsieve.sources import cells as ce
from coinsieve.sources.layouts import LAYOUTS
from coinsieve.sources.sinks import final_columns, write_combined, write_deduped, write_rules
from coinsieve.sources.statements import read_inferred, read_layout, scan_statements, statement_name, typed
from coinsieve.sources.tables import (
    DEDUPED_COLUMNS, builtin_keywords, keyword_table, load_prior, load_rules, rules_table, starter_rules,
)
from registry.core import query
from registry.duplicates import SUGGESTED, suggested_rules
from registry.views import SCORED, scored_events, table

# --- exports per bank --------------------------------------------------------------


def exported(spark, sf, layout):
    """Orders as an export of one bank, with a column more and another order."""
    day = F.when(F.col("o_orderkey") % 50 == 0, "n/a").otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    price = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    back = F.col("o_orderstatus") == "F"
    money = (
        [price.alias(layout.amount)] if layout.amount
        else [F.when(~back, price).alias(layout.debit), F.when(back, price).alias(layout.credit)]
    )
    if layout.source == "Capital One":
        money = [F.when(~back, price).alias(layout.amount), F.when(back, price).alias("Credit")]
    return table(spark, sf, "orders").select(
        F.concat_ws(", ", F.lit("Order"), "o_orderpriority").alias(layout.description),
        *money, day.alias(layout.date), F.col("o_orderkey").alias("Reference"),
    )


BY_DAY = "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END"
AMOUNTS = {
    "one": "o_totalprice",
    "debit_credit": "CASE WHEN o_orderstatus <> 'F' THEN o_totalprice ELSE 0 - o_totalprice END",
    "debit": "CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END",
}


def _layout_sql(source: str, money: str) -> str:
    return f"""
SELECT {BY_DAY} AS date, 'Order, ' || o_orderpriority AS description, {AMOUNTS[money]} AS amount, '{source}' AS source
FROM orders"""


for _key, _layout in LAYOUTS.items():
    _money = "debit_credit" if not _layout.amount else "debit" if _key == "capital_one" else "one"

    def _read(spark, sf, key=_key, layout=_layout):
        path = scratch_path(spark, key)
        exported(spark, sf, layout).write.option("header", True).csv(path)
        return typed(read_layout(spark, path, key)).select("date", "description", "amount", "source")

    query(f"read_layout_{_key}", _layout_sql(_layout.source, _money))(_read)


@query("read_layout_net_credit", _layout_sql("Capital One", "debit_credit"))
def _(spark, sf):
    path = scratch_path(spark, "capital_one")
    exported(spark, sf, LAYOUTS["capital_one"]).write.option("header", True).csv(path)
    rows = typed(read_layout(spark, path, "capital_one", net_credit=True))
    return rows.select("date", "description", "amount", "source")


@query("read_inferred_layout", """
SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS description,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 - o_totalprice END AS amount, 'Unknown' AS source
FROM orders""")
def _(spark, sf):
    path = scratch_path(spark, "other")
    back = F.col("o_orderstatus") == "F"
    table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Ref"), F.col("o_orderpriority").alias("Narration"),
        F.when(~back, F.col("o_totalprice")).alias("Debit Value"),
        F.when(back, F.col("o_totalprice")).alias("Credit Value"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Posting"),
    ).write.option("header", True).csv(path)
    return typed(read_inferred(spark, path)).select("date", "description", "amount", "source")


def statement_folder(spark, sf):
    """One folder with exports of four banks, an unknown one and a broken one."""
    base = scratch_path(spark, "statements")
    for key, name in (("chase", "Chase_2024.csv"), ("sfcu", "AccountHistory.csv"),
                      ("discover", "discover.csv"), ("capital_one", "cap1.csv")):
        exported(spark, sf, LAYOUTS[key]).write.option("header", True).csv(f"{base}/{name}")
    orders = table(spark, sf, "orders")
    orders.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Post day"), F.col("o_orderpriority").alias("PAYEE"),
        F.col("o_totalprice").alias("Amount (USD)"),
    ).write.option("header", True).csv(f"{base}/other.csv")
    orders.select("o_orderkey", F.col("o_totalprice").alias("Amount")).write.option("header", True).csv(
        f"{base}/broken.csv"
    )
    return base


@query("scan_statements", " UNION ALL ".join([
    _layout_sql("Chase", "one"), _layout_sql("SFCU", "debit_credit"), _layout_sql("Discover", "one"),
    _layout_sql("Capital One", "debit"),
    "SELECT CAST(o_orderdate AS DATE), o_orderpriority, o_totalprice, 'Unknown' FROM orders",
]))
def _(spark, sf):
    rows, _ = scan_statements(spark, statement_folder(spark, sf), name_from_folder=True)
    return typed(rows).select("date", "description", "amount", "source")


@query("rejected_files", """
SELECT 'o_orderpriority=' || lower(o_orderpriority) AS name, 'missing column: ?, ?' AS problem, CAST(1 AS BIGINT) AS files
FROM orders GROUP BY o_orderpriority
UNION ALL SELECT 'o_orderstatus=' || lower(o_orderstatus), 'a quoted cell has no end', 1 FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'nothing', 'empty or unreadable file', count(*) FROM (SELECT 1 FROM orders LIMIT 1)""")
def _(spark, sf):
    """A file per order priority lacks columns, one per order status ends inside a cell, one is empty."""
    base = scratch_path(spark, "statements")
    orders = table(spark, sf, "orders")
    exported(spark, sf, LAYOUTS["chase"]).write.option("header", True).csv(f"{base}/chase.csv")
    one = orders.coalesce(1)
    one.select("o_orderkey", F.col("o_totalprice").alias("Amount"), "o_orderpriority").write.partitionBy("o_orderpriority").option(
        "header", True
    ).csv(f"{base}/broken.csv")
    first = orders.groupBy("o_orderstatus").agg(F.min("o_orderkey").alias("key")).coalesce(1)
    first.select(F.concat(F.lit('Date,Description,Amount,"'), "key"), "o_orderstatus").write.partitionBy("o_orderstatus").option(
        "quote", ""
    ).csv(f"{base}/open.csv")
    orders.filter("o_orderkey < 0").select("o_orderpriority").coalesce(1).write.csv(f"{base}/nothing.csv")
    _, rejected = scan_statements(spark, base, name_from_folder=True)
    return rejected.groupBy(statement_name(F.col("file"), True).alias("name"), "problem").agg(F.count(F.lit(1)).alias("files"))


# --- cells that need quotes, and many columns ---------------------------------------------

TRICKY = """'say "' || event_type || '", twice' || chr(10) || chr(10) || 'on K' || event_id"""
TRICKY_SQL = f"""
SELECT CAST(ts AS DATE) AS date, {TRICKY} AS description, round(value) AS amount, 'Chase' AS source FROM events"""


def tricky_export(spark, sf, folder):
    """Events with quotes, commas and line breaks in their descriptions."""
    path = scratch_path(spark, "tricky")
    text = F.concat(
        F.lit('say "'), "event_type", F.lit('", twice\n\non K'), F.col("event_id").cast("string")
    )
    table(spark, sf, "events").select(
        text.alias("Description"), F.round("value").alias("Amount"),
        F.date_format("ts", "MM/dd/yyyy").alias("Transaction Date"),
    ).write.options(header=True, escape='"').csv(f"{path}/{folder}")
    return path


def _read_tricky(spark, sf):
    return read_layout(spark, f"{tricky_export(spark, sf, 'chase.csv')}/chase.csv", "chase")


def _infer_tricky(spark, sf):
    path = f"{tricky_export(spark, sf, 'any.csv')}/any.csv"
    return read_inferred(spark, path).withColumn("source", F.lit("Chase"))


def _scan_tricky(spark, sf):
    return scan_statements(spark, tricky_export(spark, sf, "chase.csv"), name_from_folder=True)[0]


for _name, _reader in (("layout", _read_tricky), ("inferred", _infer_tricky), ("scan", _scan_tricky)):

    def _quoted(spark, sf, reader=_reader):
        return typed(reader(spark, sf)).select("date", "description", "amount", "source")

    query(f"read_quoted_{_name}", TRICKY_SQL)(_quoted)


@query("scan_wide_statements", """
SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS description, o_totalprice AS amount FROM orders""")
def _(spark, sf):
    """Exports with 90 columns more than the three that count."""
    base = scratch_path(spark, "wide")
    more = [F.col("o_orderkey").alias(f"extra {i}") for i in range(90)]
    table(spark, sf, "orders").select(
        *more, F.date_format("o_orderdate", "MM/dd/yyyy").alias("Transaction Date"),
        F.col("o_orderpriority").alias("Description"), F.col("o_totalprice").alias("Amount"),
    ).write.option("header", True).csv(f"{base}/chase.csv")
    rows, _ = scan_statements(spark, base, name_from_folder=True)
    return typed(rows).select("date", "description", "amount")


# --- keyword file and starter rules ---------------------------------------------------------


@query("keyword_file", """
SELECT CAST(dense_rank() OVER (ORDER BY n_regionkey) - 1 AS INTEGER) AS cat_ord, r_name AS category,
       CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name) - 1 AS INTEGER) AS kw_ord, lower(n_name) AS keyword
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def _(spark, sf):
    """A keyword file with the regions as categories and their nations as keywords."""
    path = scratch_path(spark, "keywords")
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    lists = nations.groupBy("n_regionkey", "r_name").agg(F.sort_array(F.collect_list(F.lower("n_name"))).alias("words"))
    whole = lists.agg(F.sort_array(F.collect_list(F.struct("n_regionkey", "r_name", "words"))).alias("all"))
    entries = F.transform("all", lambda e: F.struct(e["r_name"].alias("key"), e["words"].alias("value")))
    whole.select(F.to_json(F.map_from_entries(entries)).alias("value")).coalesce(1).write.text(path)
    return builtin_keywords(spark, path)


@query("match_starter_rules", """
SELECT CAST(event_id AS VARCHAR) AS txn_id,
  CASE WHEN event_type = 'purchase' AND day(CAST(ts AS DATE)) <= 5 THEN 'Rent' WHEN event_type = 'view' THEN 'Food'
       WHEN event_type = 'click' THEN 'Shopping' WHEN event_type = 'signup' THEN 'Entertainment' END AS category
FROM events""")
def _(spark, sf):
    kind = F.col("event_type")
    text = (
        F.when(kind == "purchase", "Zelle to landlord").when(kind == "view", "VENMO 123").when(kind == "click", "paypal *shop")
        .when(kind == "signup", "Cash App 7").otherwise("grumble")
    )
    rows = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("txn_id"), F.to_date("ts").alias("date"), F.col("value").alias("amount"),
        text.alias("description"), F.lower(text).alias("normalized_desc"),
    )
    matched = match_rules(rows, starter_rules(spark), matcher="edit")
    return matched.select("txn_id", F.col("rule_match.category").alias("category"))


# --- extracted tables ------------------------------------------------------------------

PAGE_TEXT = """
page AS (
  SELECT CASE WHEN source = 'src1' THEN 'eStmt ' ELSE 'scan ' END || source || '.pdf' AS file, doc_id AS page,
    text || CASE WHEN doc_id % 37 = 5 THEN ' Citi' WHEN doc_id % 41 = 7 THEN ' Bank of America' ELSE '' END AS page_text
  FROM documents)"""


@query("source_from_pages", f"""
WITH {PAGE_TEXT},
hit AS (
  SELECT *, CASE WHEN contains(page_text, 'Citi') THEN 'Citi' WHEN contains(page_text, 'Bank of America') THEN 'BoA' END AS h
  FROM page),
first AS (SELECT file, min(page) AS page, min_by(h, page) AS h FROM hit WHERE h IS NOT NULL GROUP BY 1)
SELECT p.file, p.page, CASE WHEN contains(lower(p.file), 'estmt') THEN 'BoA' WHEN p.page >= f.page THEN f.h ELSE 'Unknown' END AS source
FROM page p LEFT JOIN first f USING (file)""")
def _(spark, sf):
    page = F.col("doc_id")
    mark = F.when(page % 37 == 5, " Citi").when(page % 41 == 7, " Bank of America").otherwise("")
    name = F.concat(F.when(F.col("source") == "src1", "eStmt ").otherwise("scan "), "source", F.lit(".pdf"))
    pages = table(spark, sf, "documents").select(
        name.alias("file"), page.alias("page"), F.concat("text", mark).alias("page_text")
    )
    return ce.identify_source_text(pages).select("file", "page", "source")


def cell_rows(spark, sf, cells):
    """Line items as rows of extracted tables: one page per order."""
    return table(spark, sf, "lineitem").select(
        F.lit("a.pdf").alias("file"), F.col("l_orderkey").alias("page"), F.col("l_suppkey").alias("table_no"),
        F.struct("l_linenumber", "l_partkey", "l_extendedprice").alias("row_no"), cells.alias("cells"),
        F.lit("").alias("page_text"),
    )


_DAY = "date_format(l_shipdate, 'MM/dd/yyyy')"
_PRICE = "format_number(l_extendedprice, 2)"
_DAY_SQL = "strftime(l_shipdate, '%m/%d/%Y')"
_KEYS = "l_orderkey AS page, l_suppkey AS table_no"

APPLE = f"""CASE WHEN l_returnflag = 'A' THEN array(concat('$', {_DAY}), 'ACH Deposit pay', concat('-$', {_PRICE}))
             WHEN l_returnflag = 'R' THEN array({_DAY}, 'Shop', '2%', concat('$', {_PRICE}))
             WHEN l_linestatus = 'O' THEN array({_DAY}, 'Other', concat('$', {_PRICE}))
             ELSE array({_DAY}, 'Shop', '2%', '') END"""
BOA = f"""CASE WHEN l_returnflag = 'A' THEN array('x', {_DAY}, 'Shop', 'r', 'a', concat('$', {_PRICE}))
                WHEN l_returnflag = 'R' THEN array('x', {_DAY}, '', 'r', 'a', concat('$', {_PRICE}), 'more')
                ELSE array({_DAY}, 'Shop', concat('$', {_PRICE})) END"""
CITI = f"""CASE WHEN l_returnflag = 'A' THEN array({_DAY}, '', 'Shop', concat('-$', {_PRICE}))
                 WHEN l_returnflag = 'R' THEN array('01/01/1990', {_DAY}, 'Shop', concat('$', {_PRICE}))
                 WHEN l_linestatus = 'O' THEN array({_DAY}, 'LATE FEE')
                 ELSE array({_DAY}, NULL) END"""


@query("shape_rows_apple", f"""
SELECT {_KEYS}, {_DAY_SQL} AS raw_date, CASE l_returnflag WHEN 'A' THEN 'ACH Deposit pay' ELSE 'Shop' END AS description,
       CASE l_returnflag WHEN 'A' THEN '-' ELSE '' END || printf('%.2f', l_extendedprice) AS raw_amount
FROM lineitem WHERE l_returnflag IN ('A', 'R')""")
def _(spark, sf):
    return ce.shape_rows(cell_rows(spark, sf, F.expr(APPLE)), "Apple").select(
        "page", "table_no", "raw_date", "description", "raw_amount"
    )


@query("shape_rows_boa", f"""
SELECT {_KEYS}, {_DAY_SQL} AS raw_date, 'Shop' AS description, printf('%.2f', l_extendedprice) AS raw_amount
FROM lineitem WHERE l_returnflag = 'A'""")
def _(spark, sf):
    return ce.shape_rows(cell_rows(spark, sf, F.expr(BOA)), "BoA").select(
        "page", "table_no", "raw_date", "description", "raw_amount"
    )


@query("shape_rows_citi", f"""
SELECT {_KEYS}, {_DAY_SQL} AS raw_date, CASE WHEN l_returnflag = 'N' THEN 'LATE FEE' ELSE 'Shop' END AS description,
       CASE l_returnflag WHEN 'N' THEN '0.47' WHEN 'A' THEN '-' || printf('%.2f', l_extendedprice)
            ELSE printf('%.2f', l_extendedprice) END AS raw_amount
FROM lineitem WHERE l_returnflag IN ('A', 'R') OR l_linestatus = 'O'""")
def _(spark, sf):
    return ce.shape_rows(cell_rows(spark, sf, F.expr(CITI)), "Citi").select(
        "page", "table_no", "raw_date", "description", "raw_amount"
    )


@query("drop_header_tables", """
WITH top AS (
  SELECT l_orderkey, l_suppkey, min_by(l_returnflag, (l_linenumber, l_partkey, l_extendedprice)) AS flag
  FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey AS page, l_suppkey AS table_no, count(*) AS n FROM lineitem JOIN top USING (l_orderkey, l_suppkey)
WHERE flag <> 'R' GROUP BY 1, 2""")
def _(spark, sf):
    first = F.when(F.col("l_returnflag") == "R", "Trans.").otherwise(F.col("l_returnflag"))
    kept = ce.drop_header_tables(cell_rows(spark, sf, F.array(first)))
    return kept.groupBy("page", "table_no").agg(F.count(F.lit(1)).alias("n"))


@query("complete_rows", """
SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE text <> '' AND quality IS NOT NULL""")
def _(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    text = docs.select("doc_id", "text", F.col("quality").cast("string").alias("quality"))
    return ce.complete_rows(text, "text", "quality").select("doc_id")


# --- rule files and report files -----------------------------------------------------------


def _rules(spark, sf):
    return suggested_rules(spark, sf).withColumnRenamed("suggestion_ord", "rule_ord")


@query("rules_round_trip", f"""
WITH {SUGGESTED} SELECT suggestion_ord AS rule_ord, description, category, '1-31' AS days FROM suggested""")
def _(spark, sf):
    path = scratch_path(spark, "rules")
    write_rules(_rules(spark, sf), path)
    loaded = load_rules(spark, path)
    return loaded.select(
        "rule_ord", "description", "category", F.array_join(F.col("day_range").cast("array<string>"), "-").alias("days")
    )


@query("rules_document_round_trip", f"""
WITH {SUGGESTED}
SELECT row_number() OVER (ORDER BY suggestion_ord) - 1 AS rule_ord, description, category FROM suggested""")
def _(spark, sf):
    path = scratch_path(spark, "rules")
    write_rules(_rules(spark, sf), path, "document")
    return load_rules(spark, path).select("rule_ord", "description", "category")


def reported(spark, sf):
    return dedupe(scored_events(spark, sf).withColumn("file", F.concat(F.lit("in/"), "source")))


FINAL = SCORED + """,
kept AS (SELECT *, count(*) OVER (PARTITION BY date, abs(amount), normalized_desc) > 1 AS dup FROM scored
         QUALIFY row_number() OVER (PARTITION BY date, abs(amount), normalized_desc ORDER BY seq) = 1)"""


@query("final_columns", f"""
WITH {FINAL}
SELECT strftime(date, '%m/%d/%Y') AS "Date", description AS "Description", normalized_desc AS "NormalizedDesc",
  amount AS "Amount", source AS "Source", 'in/' || source AS "File", category AS "Category", confidence AS "Confidence",
  reasoning AS "Reasoning", dup AS "IsDuplicate", 'Basic deduplication' AS "DedupeReasoning" FROM kept""")
def _(spark, sf):
    return final_columns(reported(spark, sf))


@query("deduped_report_round_trip", f"""
WITH {FINAL}
SELECT strftime(date, '%m/%d/%Y') AS "Date", description AS "Description", category AS "Category",
       CAST(dup AS VARCHAR) AS "IsDuplicate" FROM kept""")
def _(spark, sf):
    path = scratch_path(spark, "deduped")
    write_deduped(reported(spark, sf), path)
    return load_prior(spark, path, DEDUPED_COLUMNS).select("Date", "Description", "Category", "IsDuplicate")


@query("combined_report_round_trip", f"""
WITH {SCORED} SELECT txn_id, strftime(date, '%m/%d/%Y') AS date, amount, reasoning FROM scored""")
def _(spark, sf):
    path = scratch_path(spark, "combined")
    write_combined(scored_events(spark, sf), path)
    saved = load_prior(spark, path, ["txn_id"])
    return saved.select("txn_id", "date", F.col("amount").try_cast("double").alias("amount"), "reasoning")


# --- the whole run ---------------------------------------------------------------------------

RUN = """
txn AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, 'Order ' || o_orderpriority AS description,
         lower('order ' || o_orderpriority) AS normalized_desc, o_totalprice AS amount FROM orders),
done AS (
  SELECT *, CASE WHEN contains(normalized_desc, 'urgent') AND day(date) BETWEEN 1 AND 10 THEN 'Rush'
       WHEN contains(normalized_desc, 'low') THEN 'Low'
       WHEN contains(normalized_desc, 'medium') OR contains(normalized_desc, 'high') THEN 'Mid'
       ELSE 'Uncategorized' END AS category FROM txn)"""


@query("run_statements", f"""
WITH {RUN}
SELECT DISTINCT ON (date, abs(amount), normalized_desc) date, description, amount, category,
  CASE category WHEN 'Rush' THEN 0.95::DOUBLE WHEN 'Uncategorized' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS confidence
FROM done""")
def _(spark, sf):
    base, out = scratch_path(spark, "inputs"), scratch_path(spark, "outputs")
    table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("Transaction Date"),
        F.concat(F.lit("Order "), "o_orderpriority").alias("Description"),
        F.format_number("o_totalprice", 2).alias("Amount"),
    ).write.option("header", True).csv(f"{base}/chase.csv")
    rules = rules_table(spark, [("urgent", None, [1, 10], "Rush")])
    keywords = keyword_table(spark, {"Low": ["low"], "Mid": ["medium", "high"]})
    _, kept, _ = run(spark, base, out, rules, keywords, matcher="edit", name_from_folder=True)
    return kept.select("date", "description", "amount", "category", "confidence")


def order_class(descriptions):
    """Stands in for a model that cleans descriptions."""
    return "\n".join(d.lower().removeprefix("order ") for d in descriptions)


def no_calls(descriptions):
    """Fails the second run's rows if anything is asked again."""
    return "\n".join("asked again" for _ in descriptions)


@query("run_twice", """
SELECT CAST(o_orderdate AS DATE) AS date, 'Order ' || o_orderpriority AS description, lower(o_orderpriority) AS normalized_desc,
  CASE WHEN contains(lower(o_orderpriority), 'low') THEN 'Low' WHEN contains(lower(o_orderpriority), 'urgent') THEN 'Rush'
       ELSE 'Uncategorized' END AS category
FROM orders""")
def _(spark, sf):
    """The second run finds all texts and results of the first in the caches."""
    base, out, caches = (scratch_path(spark, n) for n in ("inputs", "outputs", "caches"))
    table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("Transaction Date"),
        F.concat(F.lit("Order "), "o_orderpriority").alias("Description"), F.col("o_totalprice").alias("Amount"),
    ).write.option("header", True).csv(f"{base}/chase.csv")
    keywords = keyword_table(spark, {"Low": ["low"], "Rush": ["urgent"]})
    options = {"keywords": keywords, "matcher": "edit", "name_from_folder": True, "caches": caches}
    first, _, _ = run(spark, base, f"{out}/1", normalizer=order_class, **options)
    release(first)
    rows, _, _ = run(spark, base, f"{out}/2", normalizer=no_calls, **options)
    return rows.select("date", "description", "normalized_desc", "category")


@query("run_incremental", f"""
WITH {RUN}
SELECT date, description, amount, category FROM done""")
def _(spark, sf):
    """The second run reads only the files that have come since the first."""
    base, out, store = (scratch_path(spark, n) for n in ("inputs", "outputs", "store"))
    rules = rules_table(spark, [("urgent", None, [1, 10], "Rush")])
    keywords = keyword_table(spark, {"Low": ["low"], "Mid": ["medium", "high"]})
    rows = None
    for turn, where in enumerate(("o_orderdate < '1998-01-01'", "o_orderdate >= '1998-01-01'")):
        table(spark, sf, "orders").filter(where).select(
            F.date_format("o_orderdate", "MM/dd/yyyy").alias("Transaction Date"),
            F.concat(F.lit("Order "), "o_orderpriority").alias("Description"),
            F.format_number("o_totalprice", 2).alias("Amount"),
        ).write.mode("append").option("header", True).csv(f"{base}/chase.csv")
        rows, _, _ = run(spark, base, f"{out}/{turn}", rules, keywords, matcher="edit", name_from_folder=True, store=store)
    return rows.select("date", "description", "amount", "category")


@query("run_resumed", f"""
WITH {RUN}
SELECT DISTINCT ON (date, abs(amount), normalized_desc) date, description, amount,
  CASE WHEN date < DATE '1998-01-01' THEN 'Earlier' ELSE category END AS category
FROM done""")
def _(spark, sf):
    """A run that finds the results of older orders in a saved report."""
    base, out, old = (scratch_path(spark, n) for n in ("inputs", "outputs", "prior"))
    orders = table(spark, sf, "orders")
    text = F.concat(F.lit("Order "), "o_orderpriority")
    orders.select(
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("Transaction Date"), text.alias("Description"),
        F.format_number("o_totalprice", 2).alias("Amount"),
    ).write.option("header", True).csv(f"{base}/chase.csv")
    orders.filter("o_orderdate < '1998-01-01'").select(
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("Date"), text.alias("Description"),
        F.lower(text).alias("NormalizedDesc"), F.col("o_totalprice").cast("decimal(18,2)").alias("Amount"),
        F.lit("Earlier").alias("Category"), F.lit(1.0).alias("Confidence"), F.lit("kept").alias("Reasoning"),
    ).write.option("header", True).csv(old)
    rules = rules_table(spark, [("urgent", None, [1, 10], "Rush")])
    keywords = keyword_table(spark, {"Low": ["low"], "Mid": ["medium", "high"]})
    prior = prior_as_txns(load_prior(spark, old))
    _, kept, _ = run(spark, base, out, rules, keywords, prior=prior, matcher="edit", name_from_folder=True)
    return kept.select("date", "description", "amount", "category")
