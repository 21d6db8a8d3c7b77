"""Rule and keyword matching, and the categorization cascade."""

from __future__ import annotations

from pyspark.sql import functions as F

from coinsieve.operators.match import match_keywords, match_keywords_exact, match_rules
from coinsieve.operators.aggregate import category_distribution
from coinsieve.operators.skew import with_row_number
from coinsieve.plans.categorize import cache_entries, categorize, recategorize
from registry.core import query
from registry.views import (
    KW, LINE, RULE, SCORED, TXN, edit_scores_sql, fixture_keywords, fixture_rules, ratio_scores_sql, scored_events,
    table, txn_events, txn_lineitem,
)

# --- keywords over events ------------------------------------------------------------

EXACT_KW = f"""
WITH {TXN}, {KW},
texts AS (SELECT DISTINCT description, normalized_desc FROM txn),
hits AS (
  SELECT description, normalized_desc, min_by(category, cat_ord) AS category FROM texts, kw
  WHERE contains(lower(description), keyword) OR contains(normalized_desc, keyword) GROUP BY ALL)"""



def fuzzy_ctes(scores: str) -> str:
    return f"""
{KW},
texts AS (SELECT DISTINCT description, normalized_desc FROM txn),
sides AS (
  SELECT description, normalized_desc, unnest([trim(lower(description)), trim(normalized_desc)]) AS text FROM texts),
pairs AS (SELECT DISTINCT text, trim(keyword) AS word FROM sides, kw),
{scores},
kw_hits AS (
  SELECT s.description, s.normalized_desc, k.category, k.cat_ord, k.kw_ord,
    CASE WHEN contains(lower(s.description), k.keyword) OR contains(s.normalized_desc, k.keyword) THEN 0 ELSE 1 END AS rank
  FROM sides s JOIN score c USING (text) JOIN kw k ON trim(k.keyword) = c.word
  WHERE contains(s.text, c.word) OR c.score >= CASE WHEN length(c.word) <= 2 THEN 90 ELSE 80 END),
kw_best AS (
  SELECT DISTINCT ON (description, normalized_desc) * FROM kw_hits
  ORDER BY description, normalized_desc, cat_ord, rank, kw_ord)"""


FUZZY_CTES, RATIO_CTES = fuzzy_ctes(edit_scores_sql("pairs")), fuzzy_ctes(ratio_scores_sql("pairs"))

KEYWORD_RESULT = """
  category, CASE rank WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.9::DOUBLE END AS confidence,
  CASE rank WHEN 0 THEN 'Matched hardcoded rule (exact match)' WHEN 1 THEN 'Matched hardcoded rule (fuzzy match)' END AS reasoning,
  CASE rank WHEN 0 THEN 'exact' WHEN 1 THEN 'fuzzy' END AS match_type"""


def shown(df, struct):
    return df.select(
        "txn_id", *[F.col(f"{struct}.{c}").alias(c) for c in ("category", "confidence", "reasoning", "match_type")]
    )


@query("match_keywords_exact", f"""
{EXACT_KW}
SELECT txn_id, h.category FROM txn LEFT JOIN hits h USING (description, normalized_desc)""")
def _(spark, sf):
    df = match_keywords_exact(txn_events(spark, sf), fixture_keywords(spark))
    return df.select("txn_id", F.col("keyword_match.category").alias("category"))


@query("match_keywords_edit", f"""
WITH {TXN}, {FUZZY_CTES}
SELECT txn_id, {KEYWORD_RESULT} FROM txn LEFT JOIN kw_best USING (description, normalized_desc)""")
def _(spark, sf):
    return shown(match_keywords(txn_events(spark, sf), fixture_keywords(spark), matcher="edit"), "keyword_match")


@query("match_keywords_edit_joined", f"""
WITH {TXN}, {FUZZY_CTES}
SELECT txn_id, {KEYWORD_RESULT} FROM txn LEFT JOIN kw_best USING (description, normalized_desc)""")
def _(spark, sf):
    """The way for keyword tables too large to inline, forced on a small one."""
    df = match_keywords(txn_events(spark, sf), fixture_keywords(spark), matcher="edit", max_inline=0)
    return shown(df, "keyword_match")


@query("match_keywords_ratio", f"""
WITH RECURSIVE {TXN}, {RATIO_CTES}
SELECT txn_id, {KEYWORD_RESULT} FROM txn LEFT JOIN kw_best USING (description, normalized_desc)""")
def _(spark, sf):
    return shown(match_keywords(txn_events(spark, sf), fixture_keywords(spark)), "keyword_match")


@query("match_keywords_ratio_joined", f"""
WITH RECURSIVE {TXN}, {RATIO_CTES}
SELECT txn_id, {KEYWORD_RESULT} FROM txn LEFT JOIN kw_best USING (description, normalized_desc)""")
def _(spark, sf):
    """The way for keyword tables too large to inline: candidates by rare pairs of letters."""
    df = match_keywords(txn_events(spark, sf), fixture_keywords(spark), max_inline=0)
    return shown(df, "keyword_match")


PART_KW = """
kw AS (
  SELECT CAST(dense_rank() OVER (ORDER BY p_type) AS INTEGER) AS cat_ord, p_type AS category,
         CAST(row_number() OVER (PARTITION BY p_type ORDER BY p_name) AS INTEGER) AS kw_ord, lower(p_name) AS keyword
  FROM (SELECT p_type, p_name FROM part GROUP BY 1, 2))"""


def part_keywords(spark, sf):
    """Part names as keywords of their part type, types in order of their text."""
    names = table(spark, sf, "part").groupBy("p_type", F.lower("p_name").alias("keyword")).agg(F.min("p_partkey").alias("first"))
    types = with_row_number(names.select("p_type").distinct(), [F.col("p_type")], "place")
    return names.join(types, "p_type").select(
        F.col("place").cast("int").alias("cat_ord"), F.col("p_type").alias("category"),
        F.col("first").cast("int").alias("kw_ord"), "keyword",
    )


@query("match_part_keywords", f"""
WITH {LINE}, {PART_KW},
texts AS (SELECT DISTINCT description, normalized_desc FROM line),
hits AS (
  SELECT description, min_by(category, cat_ord) AS category FROM texts, kw
  WHERE contains(lower(description), keyword) OR contains(normalized_desc, keyword) GROUP BY ALL)
SELECT txn_id, h.category FROM line LEFT JOIN hits h USING (description)""")
def _(spark, sf):
    df = match_keywords_exact(txn_lineitem(spark, sf), part_keywords(spark, sf), max_inline=100)
    return df.select("txn_id", F.col("keyword_match.category").alias("category"))


# --- rules over line items ---------------------------------------------------------------

def rule_ctes(scores: str) -> str:
    return f"""
{RULE},
texts AS (SELECT DISTINCT description, normalized_desc FROM line),
rule_sides AS (
  SELECT description, normalized_desc, unnest([trim(lower(description)), trim(normalized_desc)]) AS text FROM texts),
rule_pairs AS (SELECT DISTINCT s.text, trim(lower(r.description)) AS word FROM rule_sides s, rule r),
{scores},
similar_texts AS (
  SELECT DISTINCT s.description, s.normalized_desc, r.rule_ord FROM rule_sides s
  JOIN score c USING (text) JOIN rule r ON trim(lower(r.description)) = c.word
  WHERE contains(s.text, c.word) OR c.score >= CASE WHEN length(c.word) <= 2 THEN 90 ELSE 80 END),
fits AS (
  SELECT l.txn_id, r.rule_ord, r.category, r.description AS rule_text, l.description, l.normalized_desc
  FROM line l JOIN similar_texts t ON t.description = l.description AND t.normalized_desc = l.normalized_desc
  JOIN rule r USING (rule_ord)
  WHERE (r.amount IS NULL OR r.amount = l.amount)
    AND (r.low IS NULL OR coalesce(day(l.date) BETWEEN r.low AND r.high, false))),
first_rule AS (SELECT DISTINCT ON (txn_id) * FROM fits ORDER BY txn_id, rule_ord)"""


RULE_CTES, RATIO_RULE_CTES = rule_ctes(edit_scores_sql("rule_pairs")), rule_ctes(ratio_scores_sql("rule_pairs"))


def rule_result(contained: str) -> str:
    return f"""
  f.category, CASE WHEN f.txn_id IS NULL THEN NULL WHEN {contained} THEN 0.95::DOUBLE ELSE 0.9::DOUBLE END AS confidence,
  CASE WHEN f.txn_id IS NULL THEN NULL WHEN {contained} THEN 'Matched custom rule (exact match)'
       ELSE 'Matched custom rule (fuzzy match)' END AS reasoning,
  CASE WHEN f.txn_id IS NULL THEN NULL WHEN {contained} THEN 'exact' ELSE 'fuzzy' END AS match_type"""


LOWERED = "(contains(lower(f.description), lower(f.rule_text)) OR contains(f.normalized_desc, lower(f.rule_text)))"
AS_WRITTEN = "(contains(lower(f.description), f.rule_text) OR contains(f.normalized_desc, f.rule_text))"


@query("match_rules_edit", f"""
WITH {LINE}, {RULE_CTES}
SELECT l.txn_id, {rule_result(LOWERED)} FROM line l LEFT JOIN first_rule f ON f.txn_id = l.txn_id""")
def _(spark, sf):
    return shown(match_rules(txn_lineitem(spark, sf), fixture_rules(spark), matcher="edit"), "rule_match")


@query("match_rules_raw_label", f"""
WITH {LINE}, {RULE_CTES}
SELECT l.txn_id, {rule_result(AS_WRITTEN)} FROM line l LEFT JOIN first_rule f ON f.txn_id = l.txn_id""")
def _(spark, sf):
    df = match_rules(txn_lineitem(spark, sf), fixture_rules(spark), matcher="edit", raw_label=True)
    return shown(df, "rule_match")


@query("match_rules_edit_joined", f"""
WITH {LINE}, {RULE_CTES}
SELECT l.txn_id, {rule_result(LOWERED)} FROM line l LEFT JOIN first_rule f ON f.txn_id = l.txn_id""")
def _(spark, sf):
    df = match_rules(txn_lineitem(spark, sf), fixture_rules(spark), matcher="edit", max_inline=0)
    return shown(df, "rule_match")


@query("match_rules_ratio", f"""
WITH RECURSIVE {LINE}, {RATIO_RULE_CTES}
SELECT l.txn_id, {rule_result(LOWERED)} FROM line l LEFT JOIN first_rule f ON f.txn_id = l.txn_id""")
def _(spark, sf):
    return shown(match_rules(txn_lineitem(spark, sf), fixture_rules(spark)), "rule_match")


# --- the cascade ------------------------------------------------------------------------------

EVENT_RULES = [
    ("Signup", None, [1, 10], "Welcome"),
    ("purchase", 25.0, None, "Snack"),
    ("view", None, [28, 31], "Late"),
]
EVENT_RULE_CTE = "erule AS (SELECT * FROM (VALUES (0, 'signup', NULL::DOUBLE, 1, 10, 'Welcome'), " \
    "(1, 'purchase', 25.0::DOUBLE, NULL, NULL, 'Snack'), (2, 'view', NULL::DOUBLE, 28, 31, 'Late')) " \
    "v(rule_ord, word, amount, low, high, category))"


def event_rules(spark):
    from coinsieve.sources.tables import rules_table

    return rules_table(spark, EVENT_RULES)


def cascade(ctes: str) -> str:
    return f"""
{ctes}, {EVENT_RULE_CTE},
rule_hit AS (
  SELECT DISTINCT ON (t.txn_id) t.txn_id, r.category FROM txn t JOIN erule r ON contains(t.normalized_desc, r.word)
    AND (r.amount IS NULL OR r.amount = t.amount) AND (r.low IS NULL OR day(t.date) BETWEEN r.low AND r.high)
  ORDER BY t.txn_id, r.rule_ord),
cascade AS (
  SELECT t.txn_id, t.seq, t.source, t.date, t.amount, t.normalized_desc,
    coalesce(r.category, b.category, 'Uncategorized') AS category,
    CASE WHEN r.category IS NOT NULL THEN 0.95::DOUBLE WHEN b.rank = 0 THEN 1.0::DOUBLE WHEN b.rank = 1 THEN 0.9::DOUBLE
         ELSE 0.0::DOUBLE END AS confidence,
    CASE WHEN r.category IS NOT NULL THEN 'Matched custom rule (exact match)'
         WHEN b.rank = 0 THEN 'Matched hardcoded rule (exact match)'
         WHEN b.rank = 1 THEN 'Matched hardcoded rule (fuzzy match)' ELSE 'No rule matched' END AS reasoning,
    CASE WHEN r.category IS NOT NULL OR b.rank = 0 THEN 'exact' WHEN b.rank = 1 THEN 'fuzzy' END AS match_type
  FROM txn t LEFT JOIN rule_hit r USING (txn_id) LEFT JOIN kw_best b USING (description, normalized_desc))"""


CASCADE = cascade(FUZZY_CTES)

RESULT = ["txn_id", "category", "confidence", "reasoning", "match_type"]


@query("categorize", f"""
WITH {TXN}, {CASCADE} SELECT txn_id, category, confidence, reasoning, match_type FROM cascade""")
def _(spark, sf):
    df = categorize(txn_events(spark, sf), event_rules(spark), fixture_keywords(spark), matcher="edit")
    return df.select(*RESULT)


@query("categorize_cached", f"""
WITH {TXN}, {CASCADE} SELECT txn_id, category, confidence, reasoning, match_type FROM cascade""")
def _(spark, sf):
    """A second run that finds part of its results in the cache: the same table."""
    rules, keywords = event_rules(spark), fixture_keywords(spark)
    df = txn_events(spark, sf)
    earlier = categorize(df.filter("date < '2024-01-16'"), rules, keywords, matcher="edit")
    cache = cache_entries(earlier.filter("match_type IS NOT NULL"), rules, keywords)
    return categorize(df, rules, keywords, cache, matcher="edit").select(*RESULT)


@query("categorize_ratio", f"""
WITH RECURSIVE {TXN}, {cascade(RATIO_CTES)} SELECT txn_id, category, confidence, reasoning, match_type FROM cascade""")
def _(spark, sf):
    return categorize(txn_events(spark, sf), event_rules(spark), fixture_keywords(spark)).select(*RESULT)


@query("keyword_distribution", f"""
{EXACT_KW},
labelled AS (SELECT h.category FROM txn LEFT JOIN hits h USING (description, normalized_desc))
SELECT category, count(*) AS n,
       round(count(*) * 100.0 / (SELECT count(*) FROM labelled), 1)::DOUBLE AS pct
FROM labelled WHERE category IS NOT NULL GROUP BY category""")
def keyword_distribution(spark, sf):
    df = match_keywords_exact(txn_events(spark, sf), fixture_keywords(spark))
    return category_distribution(df.select(F.col("keyword_match.category").alias("category")))


@query("recategorize", f"""
WITH {SCORED}, {EVENT_RULE_CTE.replace("'view'", "'error'")},
hit AS (
  SELECT DISTINCT ON (t.txn_id) t.txn_id, r.category FROM scored t JOIN erule r ON contains(t.normalized_desc, r.word)
    AND (r.amount IS NULL OR r.amount = t.amount) AND (r.low IS NULL OR day(t.date) BETWEEN r.low AND r.high)
  WHERE t.category = 'Uncategorized' ORDER BY t.txn_id, r.rule_ord)
SELECT txn_id,
  CASE WHEN s.category = 'Uncategorized' THEN coalesce(h.category, 'Uncategorized') ELSE s.category END AS category,
  CASE WHEN s.category = 'Uncategorized' THEN CASE WHEN h.category IS NULL THEN 0.0::DOUBLE ELSE 0.95::DOUBLE END
       ELSE confidence END AS confidence,
  CASE WHEN s.category = 'Uncategorized' THEN CASE WHEN h.category IS NULL THEN 'No rule matched'
       ELSE 'Matched custom rule (exact match)' END ELSE reasoning END AS reasoning
FROM scored s LEFT JOIN hit h USING (txn_id)""")
def _(spark, sf):
    from coinsieve.sources.tables import rules_table

    rules = rules_table(spark, [*EVENT_RULES[:2], ("error", None, [28, 31], "Late")])
    return recategorize(scored_events(spark, sf), rules, matcher="edit").select(
        "txn_id", "category", "confidence", "reasoning"
    )
