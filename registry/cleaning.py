"""Parsing, normalization, keys, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from coinsieve.functions import keys, parsing, review, text, usage
from coinsieve.functions.similarity import partial_edit_score
from coinsieve.operators import rows
from coinsieve.operators.aggregate import with_usage
from coinsieve.sources.layouts import identify_source, identify_table_source, infer_layout
from coinsieve.sources.statements import apply_layout
from registry.core import query
from registry.views import (
    CORRECTED, LINE, PARSE_AMOUNT_SQL, PARSE_DATE_SQL, RAW_LINE, RAW_ORDERS, SCORED, TXN,
    corrected_events, edit_scores_sql, raw_orders, raw_split, scored_events, table, txn_events, txn_lineitem,
)

SPACES = r"[\s\p{Z}\x0b\x1c-\x1f\x85]"


@query("normalize_description", f"""
WITH {TXN} SELECT txn_id, description, normalized_desc FROM txn""")
def _(spark, sf):
    return txn_events(spark, sf).select("txn_id", "description", "normalized_desc")


@query("normalize_documents", f"""
SELECT doc_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(
  regexp_replace(lower(text), '^{SPACES}+|{SPACES}+$', '', 'g'),
  'ach debit',''),'ach credit',''),'online',''),'payment',''),'*',''), '{SPACES}+', ' ', 'g'))) AS digest
FROM documents""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.md5(text.normalize_description(F.col("text"))).alias("digest"))


@query("strip_lower", f"""
SELECT doc_id, md5(regexp_replace(lower(text), '^{SPACES}+|{SPACES}+$', '', 'g')) AS digest,
       length(regexp_replace(lower(text), '^{SPACES}+|{SPACES}+$', '', 'g')) AS chars
FROM documents""")
def _(spark, sf):
    clean = text.strip(F.lower("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(clean).alias("digest"), F.length(clean).cast("bigint").alias("chars")
    )


@query("collapse_whitespace", f"""
SELECT doc_id, md5(trim(regexp_replace(text, '{SPACES}+', ' ', 'g'))) AS digest FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(text.collapse_spaces(F.col("text"))).alias("digest")
    )


@query("ordered_replace", f"""
WITH {TXN}
SELECT txn_id, replace(replace(replace(replace(replace(lower(description),
  'ach debit',''),'ach credit',''),'online',''),'payment',''),'*','') AS bare FROM txn""")
def _(spark, sf):
    bare = text.delete_literals(F.lower("description"), text.NOISE)
    return txn_events(spark, sf).select("txn_id", bare.alias("bare"))


@query("substring_flags", f"""
WITH {TXN}
SELECT txn_id, contains(lower(description), 'online  *k4') AS raw_hit,
       contains(normalized_desc, 'purchase') AS clean_hit FROM txn""")
def _(spark, sf):
    return txn_events(spark, sf).select(
        "txn_id",
        F.contains(F.lower("description"), F.lit("online  *k4")).alias("raw_hit"),
        F.contains("normalized_desc", F.lit("purchase")).alias("clean_hit"),
    )


@query("first_word", f"""
WITH {LINE}
SELECT description, split_part(trim(lower(description)), ' ', 1) AS word, count(*) AS n FROM line GROUP BY 1, 2""")
def _(spark, sf):
    return txn_lineitem(spark, sf).groupBy(
        "description", text.first_word(F.col("description")).alias("word")
    ).agg(F.count(F.lit(1)).alias("n"))


@query("parse_date", f"""
WITH {RAW_ORDERS}
SELECT o_orderkey, {PARSE_DATE_SQL.format(c='"Order Date"')} AS date,
       strftime({PARSE_DATE_SQL.format(c='"Order Date"')}, '%m/%d/%Y') AS shown FROM raw""")
def _(spark, sf):
    day = parsing.parse_date(F.col("Order Date"))
    return raw_orders(spark, sf).select(
        "o_orderkey", day.alias("date"), parsing.format_date(day).alias("shown")
    )


@query("parse_amount", f"""
WITH {RAW_ORDERS}
SELECT o_orderkey, replace(replace("Order Amount", '$', ''), ',', '') AS bare,
       {PARSE_AMOUNT_SQL.format(c='"Order Amount"')} AS amount FROM raw""")
def _(spark, sf):
    bare = parsing.strip_currency(F.col("Order Amount"))
    return raw_orders(spark, sf).select(
        "o_orderkey", bare.alias("bare"), parsing.parse_amount(bare).alias("amount")
    )


@query("strip_currency", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       replace(replace(CASE WHEN l_returnflag = 'R' THEN '-$' ELSE '$' END
         || format('{:,.2f}', l_extendedprice), '$', ''), ',', '') AS bare
FROM lineitem""")
def _(spark, sf):
    shown = F.concat(
        F.when(F.col("l_returnflag") == "R", "-$").otherwise("$"), F.format_number("l_extendedprice", 2)
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", parsing.strip_currency(shown).alias("bare")
    )


@query("net_amount_debit", f"""
WITH {RAW_LINE} SELECT l_orderkey, l_linenumber, coalesce(debit, 0) - coalesce(credit, 0) AS amount FROM raw""")
def _(spark, sf):
    return raw_split(spark, sf, "debit").select("l_orderkey", "l_linenumber", "amount")


@query("net_amount_credit", f"""
WITH {RAW_LINE} SELECT l_orderkey, l_linenumber, coalesce(credit, 0) - coalesce(debit, 0) AS amount FROM raw""")
def _(spark, sf):
    return raw_split(spark, sf, "credit").select("l_orderkey", "l_linenumber", "amount")


@query("fill_nulls", f"""
WITH {RAW_LINE} SELECT l_orderkey, l_linenumber, coalesce(debit, 0) AS debit, coalesce(credit, 0) AS credit FROM raw""")
def _(spark, sf):
    return raw_split(spark, sf, "debit").select(
        "l_orderkey", "l_linenumber",
        F.coalesce("debit", F.lit(0.0)).alias("debit"), F.coalesce("credit", F.lit(0.0)).alias("credit"),
    )


@query("absolute_amount", f"""
WITH {LINE} SELECT txn_id, amount, abs(amount) AS abs_amount FROM line""")
def _(spark, sf):
    return txn_lineitem(spark, sf).select("txn_id", "amount", F.abs("amount").alias("abs_amount"))


@query("day_of_month", f"""
WITH {LINE}
SELECT txn_id, CAST(day(date) AS INTEGER) AS day, day(date) BETWEEN 3 AND 9 AS in_range FROM line""")
def _(spark, sf):
    day = F.dayofmonth("date")
    return txn_lineitem(spark, sf).select("txn_id", day.alias("day"), day.between(3, 9).alias("in_range"))


@query("day_window", """
WITH a AS (
  SELECT o_orderkey, CAST(day(o_orderdate) AS INTEGER) AS d,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'any' WHEN '2-HIGH' THEN '3-9'
              WHEN '3-MEDIUM' THEN 'every day' WHEN '5-LOW' THEN 'a-b' ELSE '' END AS answer
  FROM orders)
SELECT o_orderkey,
       CASE WHEN answer IN ('any', 'every day') THEN 1 WHEN answer = '3-9' THEN 3 ELSE greatest(1, d - 2) END AS low,
       CASE WHEN answer IN ('any', 'every day') THEN 31 WHEN answer = '3-9' THEN 9 ELSE least(31, d + 2) END AS high
FROM a""")
def _(spark, sf):
    level = F.col("o_orderpriority")
    answer = (
        F.when(level == "1-URGENT", "any").when(level == "2-HIGH", "3-9")
        .when(level == "3-MEDIUM", "every day").when(level == "5-LOW", "a-b").otherwise("")
    )
    days = parsing.parse_day_range(answer, F.to_date("o_orderdate"))
    return table(spark, sf, "orders").select("o_orderkey", days.alias("days")).select(
        "o_orderkey", F.get("days", F.lit(0)).alias("low"), F.get("days", F.lit(1)).alias("high")
    )


@query("txn_key", f"""
WITH {TXN}
SELECT txn_id, strftime(date, '%m/%d/%Y') || ':' || description || ':'
  || CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR) AS txn_key FROM txn""")
def _(spark, sf):
    return rows.with_txn_key(txn_events(spark, sf)).select("txn_id", "txn_key")


@query("dedupe_key", f"""
WITH {TXN}
SELECT date AS key_date, abs(amount) AS key_amount, normalized_desc AS key_desc, count(*) AS n, min(seq) AS first_seq
FROM txn GROUP BY 1, 2, 3""")
def _(spark, sf):
    from coinsieve.operators.dedupe import key_counts

    return key_counts(txn_events(spark, sf))


@query("category_label", f"""
WITH {SCORED} SELECT txn_id, category || ': ' || normalized_desc AS category_desc FROM scored""")
def _(spark, sf):
    return scored_events(spark, sf).select("txn_id", rows.category_desc().alias("category_desc"))


@query("reset_uncategorized", f"""
WITH {SCORED}
SELECT txn_id, CASE WHEN category IS DISTINCT FROM 'Uncategorized' THEN category END AS category,
       CASE WHEN category IS DISTINCT FROM 'Uncategorized' THEN confidence END AS confidence,
       CASE WHEN category IS DISTINCT FROM 'Uncategorized' THEN reasoning END AS reasoning FROM scored""")
def _(spark, sf):
    return rows.reset_uncategorized(scored_events(spark, sf)).select(
        "txn_id", "category", "confidence", "reasoning"
    )


@query("ensure_columns", f"""
WITH {TXN} SELECT txn_id, NULL::VARCHAR AS category, NULL::DOUBLE AS confidence, NULL::VARCHAR AS reasoning FROM txn""")
def _(spark, sf):
    wide = rows.ensure_columns(
        txn_events(spark, sf), "category string, confidence double, reasoning string, source string"
    )
    return wide.select("txn_id", "category", "confidence", "reasoning")


FILTERS = {
    "uncategorized_rows": (rows.uncategorized, "category = 'Uncategorized'"),
    "low_confidence_rows": (rows.low_confidence, "confidence < 0.7 AND category IS DISTINCT FROM 'Uncategorized'"),
    "review_candidates": (rows.review_candidates, "confidence < 0.8"),
    "confident_rows": (rows.confident, "confidence >= 0.9 AND category <> 'Uncategorized'"),
    "pending_rows": (rows.pending, "category IS NULL OR confidence IS NULL"),
}
for _name, (_fn, _where) in FILTERS.items():

    def _run(spark, sf, fn=_fn):
        return fn(scored_events(spark, sf)).select("txn_id", "category", "confidence")

    query(_name, f"WITH {SCORED} SELECT txn_id, category, confidence FROM scored WHERE {_where}")(_run)


@query("enough_evidence", f"""
WITH {CORRECTED}
SELECT txn_id FROM scored WHERE category = 'Uncategorized'
  AND (SELECT count(*) FROM scored WHERE category = 'Uncategorized') + (SELECT count(*) FROM corrected) >= 3""")
def _(spark, sf):
    scored = scored_events(spark, sf)
    return rows.enough_evidence(rows.uncategorized(scored), corrected_events(spark, sf)).select("txn_id")


@query("confidence_gate", f"""
WITH {SCORED}
SELECT txn_id, confidence,
  CASE WHEN confidence < 0.8 THEN 'Uncategorized' ELSE category END AS category,
  CASE WHEN confidence < 0.8 THEN 'Low confidence (' || printf('%.2f', confidence) || ') for '''
    || coalesce(category, 'None') || '''. Original reasoning: ' || reasoning ELSE reasoning END AS reasoning
FROM scored""")
def _(spark, sf):
    return rows.confidence_gate(scored_events(spark, sf)).select(
        "txn_id", "confidence", "category", "reasoning"
    )


@query("suggested_category", f"""
WITH {SCORED}
SELECT txn_id, nullif(regexp_extract(reasoning, 'Low confidence \\([0-9.]+\\) for ''([^'']+)''', 1), '') AS suggested
FROM scored""")
def _(spark, sf):
    return scored_events(spark, sf).select(
        "txn_id", review.suggested_category(F.col("reasoning")).alias("suggested")
    )


@query("md5_keys", """
SELECT doc_id, md5(text) AS text_key, md5('gpt-4o' || text) AS prompt_key FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", keys.description_key(F.col("text")).alias("text_key"),
        keys.prompt_key(F.lit("gpt-4o"), F.col("text")).alias("prompt_key"),
    )


@query("simple_cache_key", f"""
WITH {TXN}
SELECT txn_id, md5(description || CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR) || strftime(date, '%m/%d/%Y')) AS key
FROM txn""")
def _(spark, sf):
    return txn_events(spark, sf).select(
        "txn_id", keys.simple_key(F.col("description"), F.col("amount"), F.col("date")).alias("key")
    )


@query("table_fingerprint", """
SELECT md5(count(*) || ':' || CAST(sum(('0x' || substr(md5(concat_ws('|', p_partkey, p_name, p_brand, p_type)), 1, 15))
  ::BIGINT::HUGEINT) AS VARCHAR)) AS fingerprint FROM part""")
def _(spark, sf):
    return keys.fingerprint(
        table(spark, sf, "part"), [F.col(c) for c in ("p_partkey", "p_name", "p_brand", "p_type")]
    )


@query("edit_score", f"""
WITH {TXN},
pairs AS (SELECT DISTINCT normalized_desc AS text, w.word FROM txn,
  (VALUES ('purchse'), ('k4'), ('a very long keyword indeed'), ('viw')) w(word)),
{edit_scores_sql('pairs')}
SELECT text, word, CAST(score AS INTEGER) AS score FROM score""")
def _(spark, sf):
    words = F.array(*[F.lit(w) for w in ("purchse", "k4", "a very long keyword indeed", "viw")])
    pairs = txn_events(spark, sf).select(F.col("normalized_desc").alias("text")).distinct()
    return pairs.withColumn("word", F.explode(words)).withColumn(
        "score", partial_edit_score(F.col("word"), F.col("text"))
    )


@query("source_from_name", """
SELECT event_id,
  CASE WHEN event_type = 'view' THEN 'BoA' WHEN event_type = 'click' THEN 'SFCU'
       WHEN event_type = 'error' THEN 'AMEX' WHEN event_type = 'signup' THEN 'Capital One' ELSE 'Unknown' END AS source,
  CASE WHEN event_type = 'view' THEN 'BoA' ELSE 'Unknown' END AS table_source
FROM events""")
def _(spark, sf):
    kind = F.col("event_type")
    stem = (
        F.when(kind == "view", "eStmt_2025").when(kind == "click", "AccountHistory")
        .when(kind == "error", "American_2024").when(kind == "signup", "cap1-export").otherwise("other")
    )
    return table(spark, sf, "events").select(
        "event_id", identify_source(stem).alias("source"), identify_table_source(stem).alias("table_source")
    )


@query("infer_layout", f"""
WITH {RAW_ORDERS}
SELECT o_orderkey, "Order Date" AS raw_date, "Order Desc" AS description,
       {PARSE_AMOUNT_SQL.format(c='"Order Amount"')} AS amount FROM raw""")
def _(spark, sf):
    raw = raw_orders(spark, sf)
    return apply_layout(raw, infer_layout(raw.columns), "o_orderkey")


@query("percentages", f"""
WITH {SCORED}
SELECT source, printf('%.2f', round(avg(k), 6)) AS avg_text,
       round(count(*) FILTER (WHERE confidence < 0.7) * 100.0 / count(*), 1)::DOUBLE AS low_pct
FROM scored GROUP BY source""")
def _(spark, sf):
    low = F.count_if(F.col("confidence") < 0.7)
    return scored_events(spark, sf).groupBy("source").agg(
        text.fixed_point(F.round(F.avg("k"), 6)).alias("avg_text"),
        text.percent(low, F.count(F.lit(1))).alias("low_pct"),
    )


# --- model call estimates and review answers over conversations ---------------------

CALLS = """
calls AS (
  SELECT conv_id, turn, CASE role WHEN 'user' THEN 'gpt-4o' WHEN 'assistant' THEN 'gpt-3.5-turbo' ELSE 'local' END AS model,
         CASE turn % 5 WHEN 0 THEN 'norm_batch:0-50' WHEN 1 THEN 'txn:[coffee...4.5]' WHEN 2 THEN 'rule_suggestions'
              WHEN 3 THEN 'dedupe:[x]' ELSE 'user_corrections_analysis' END AS context,
         length(text) AS prompt_chars, CAST(turn * 10 AS BIGINT) AS response_chars
  FROM conversations)"""


def call_log(spark, sf):
    turn, role = F.col("turn"), F.col("role")
    return table(spark, sf, "conversations").select(
        "conv_id", "turn",
        F.when(role == "user", "gpt-4o").when(role == "assistant", "gpt-3.5-turbo").otherwise("local").alias("model"),
        F.when(turn % 5 == 0, "norm_batch:0-50").when(turn % 5 == 1, "txn:[coffee...4.5]")
        .when(turn % 5 == 2, "rule_suggestions").when(turn % 5 == 3, "dedupe:[x]")
        .otherwise("user_corrections_analysis").alias("context"),
        F.length("text").cast("bigint").alias("prompt_chars"),
        (turn * 10).cast("bigint").alias("response_chars"),
    )


@query("call_estimates", f"""
WITH {CALLS}
SELECT conv_id, turn, round(prompt_chars / 3.0::DOUBLE + response_chars / 2.0::DOUBLE, 4) AS tokens,
  round((prompt_chars / 3.0::DOUBLE + response_chars / 2.0::DOUBLE)
    * CASE model WHEN 'gpt-4o' THEN 0.00001::DOUBLE WHEN 'gpt-3.5-turbo' THEN 0.000001::DOUBLE ELSE 0 END, 8) AS cost,
  CASE WHEN contains(context, 'norm') THEN 'normalization' WHEN contains(context, 'txn:') THEN 'categorization'
       WHEN contains(context, 'rule') THEN 'rule_generation' WHEN contains(context, 'dedupe') THEN 'deduplication'
       ELSE 'other' END AS purpose,
  CASE WHEN contains(context, 'norm_batch') AND model = 'gpt-4o' THEN 'gpt-3.5-turbo' ELSE model END AS routed
FROM calls""")
def _(spark, sf):
    routed = usage.route_model(F.col("model"), F.col("context"))
    return with_usage(call_log(spark, sf)).select(
        "conv_id", "turn", F.round("tokens", 4).alias("tokens"), F.round("cost", 8).alias("cost"),
        "purpose", routed.alias("routed"),
    )


SENTENCES = """
said AS (
  SELECT conv_id, turn, CAST(row_number() OVER () AS BIGINT) AS x, trim(lower(s)) AS said
  FROM (SELECT conv_id, turn, unnest(string_split(replace(text, chr(10), ' '), '. ')) AS s FROM conversations))"""


def sentences(spark, sf):
    parts = F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), r"\. "))
    return table(spark, sf, "conversations").select("conv_id", "turn", parts.alias("said"))


def _any(words: list[str], col: str = "said") -> str:
    return "(" + " OR ".join(f"contains({col}, '{w}')" for w in words) + ")"


@query("review_intent", f"""
WITH {SENTENCES}
SELECT conv_id, turn,
  CASE WHEN {_any(review.QUIT)} THEN 'quit' WHEN {_any(review.CHANGE)} THEN 'change'
       WHEN {_any(review.SKIP)} THEN 'skip' WHEN {_any(review.ACCEPT)} THEN 'accept' ELSE 'unknown' END AS intent,
  {_any(review.YES)} AS yes, count(*) AS n
FROM said GROUP BY ALL""")
def _(spark, sf):
    return sentences(spark, sf).groupBy(
        "conv_id", "turn", review.intent(F.col("said")).alias("intent"),
        review.affirmative(F.col("said")).alias("yes"),
    ).agg(F.count(F.lit(1)).alias("n"))


_NAMES = ["en", "re", "an", "ou"]


def _first_named(col: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({col}, '{c}') THEN '{c.title()}'" for c in _NAMES) + \
        f" WHEN contains({col}, 'uncategorized') THEN 'Uncategorized' END"


@query("category_mention", f"""
WITH {SENTENCES}, told AS (SELECT conv_id, turn, 'please change to ' || said AS full_text, trim(said) AS said FROM said
  UNION ALL SELECT conv_id, turn, said AS full_text, NULL AS said FROM said)
SELECT conv_id, turn,
  coalesce({_first_named('said')}, {_first_named('full_text')}, 'Uncategorized') AS category, count(*) AS n
FROM told GROUP BY ALL""")
def _(spark, sf):
    said = sentences(spark, sf)
    both = F.explode(F.array(F.concat(F.lit("please change to "), text.strip(F.lower("said"))), F.col("said")))
    named = review.mentioned_category(F.col("answer"), categories=[c.title() for c in _NAMES])
    return said.select("conv_id", "turn", both.alias("answer")).groupBy(
        "conv_id", "turn", named.alias("category")
    ).agg(F.count(F.lit(1)).alias("n"))
