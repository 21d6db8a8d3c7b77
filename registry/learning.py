"""Rule mining, suggestion replies and batch review."""

from __future__ import annotations

from pyspark.sql import functions as F

from coinsieve.functions.jsonfix import parse_json, repair_array
from coinsieve.operators import mining as mi
from coinsieve.operators.rows import confident
from coinsieve.plans.learn import learn_rules
from coinsieve.plans.review import read_answers, review_batch, review_items
from registry.core import query
from registry.views import (
    LINE, RULE, SCORED, SCORED_LINE, fixture_rules, scored_events,
    scored_lineitem, table, txn_lineitem,
)


def shown(df):
    days = F.array_join(F.col("day_range").cast("array<string>"), "-")
    return df.withColumn("day_range", days).drop("reasoning")


TOKENS = """
tok_{t} AS (SELECT *, unnest(list_distinct(string_split(lower(normalized_desc), ' '))) AS token FROM {t})"""
FACTS = """
  count(*) AS support, CASE WHEN min(amount) = max(amount) AND count(amount) = count(*) THEN min(amount) END AS amount,
  min(day(date)) || '-' || max(day(date)) AS day_range"""
VOTES = """
votes AS (
  SELECT token, max_by(label, (n, label)) AS category, max(n) AS n, sum(n) AS total
  FROM (SELECT token, {label} AS label, count(*) AS n FROM {t} GROUP BY 1, 2) GROUP BY 1)"""

UNCATEGORIZED_MINED = f"""
unknown AS (SELECT * FROM scored WHERE category = 'Uncategorized'),
known AS (SELECT * FROM scored WHERE confidence >= 0.9 AND category <> 'Uncategorized'),
{TOKENS.format(t='unknown')}, {TOKENS.format(t='known')}, {VOTES.format(label='category', t='tok_known')},
facts AS (SELECT token, {FACTS} FROM tok_unknown GROUP BY 1),
mined_unknown AS (
  SELECT token AS description, amount, day_range, category, round(n / total, 4)::DOUBLE AS confidence, support
  FROM facts JOIN votes USING (token) WHERE support >= 3 AND n / total >= {{conf}})"""


@query("mine_uncategorized", f"""
WITH {SCORED_LINE}, {UNCATEGORIZED_MINED.format(conf=0.3)} SELECT * FROM mined_unknown""")
def _(spark, sf):
    scored = scored_lineitem(spark, sf)
    return shown(mi.mine_uncategorized(scored, confident(scored), min_conf=0.3))


def _pure(name: str, t: str, label: str, conf: float) -> str:
    return f"""
{TOKENS.format(t=t)},
{name}_votes AS (
  SELECT token, max_by(label, (n, label)) AS category, max(n) AS n, sum(n) AS total
  FROM (SELECT token, {label} AS label, count(*) AS n FROM tok_{t} GROUP BY 1, 2) GROUP BY 1),
{name}_facts AS (SELECT token, {label} AS category, {FACTS} FROM tok_{t} GROUP BY 1, 2),
{name} AS (
  SELECT token AS description, amount, day_range, category, round(n / total, 4)::DOUBLE AS confidence, support
  FROM {name}_votes JOIN {name}_facts USING (token, category)
  WHERE n / total >= {conf} AND n >= 3 AND category <> 'Uncategorized')"""


# Returned line items are corrected to the last word of their part.
LINE_CORRECTED = LINE + """,
told AS (SELECT *, split_part(p_name, ' ', -1) AS new_category FROM line WHERE source = 'R')"""


def corrected_lines(spark, sf):
    rows = txn_lineitem(spark, sf).filter("source = 'R'")
    return rows.withColumn("new_category", F.element_at(F.split("p_name", " "), -1))


@query("mine_corrections", f"""
WITH {LINE_CORRECTED}, {_pure('mined', 'told', 'new_category', 0.85)} SELECT * FROM mined""")
def _(spark, sf):
    return shown(mi.mine_corrections(corrected_lines(spark, sf)))


@query("mine_low_confidence", f"""
WITH {SCORED_LINE}, low AS (SELECT * FROM scored WHERE confidence < 0.7 AND category <> 'Uncategorized'),
{_pure('mined', 'low', 'category', 0.8)} SELECT * FROM mined""")
def _(spark, sf):
    return shown(mi.mine_low_confidence(scored_lineitem(spark, sf)))


@query("clear_consumed_corrections", f"""
WITH {LINE_CORRECTED}, {_pure('mined', 'told', 'new_category', 0.85)}
SELECT txn_id FROM told WHERE (SELECT count(*) FROM mined) = 0""")
def _(spark, sf):
    told = corrected_lines(spark, sf)
    return mi.clear_consumed(told, mi.mine_corrections(told)).select("txn_id")


@query("learn_rules", f"""
WITH {SCORED_LINE}, {RULE}, {UNCATEGORIZED_MINED.format(conf=0.7)},
low AS (SELECT * FROM scored WHERE confidence < 0.7 AND category <> 'Uncategorized'),
{_pure('mined_low', 'low', 'category', 0.8)},
told AS (SELECT *, split_part(p_name, ' ', -1) AS new_category FROM line WHERE source = 'R'),
{_pure('mined_told', 'told', 'new_category', 0.85)},
together AS (
  SELECT 0 AS tier, * FROM mined_unknown UNION ALL SELECT 1, * FROM mined_low UNION ALL SELECT 2, * FROM mined_told),
single AS (SELECT DISTINCT ON (description, category) * FROM together ORDER BY description, category, tier, support DESC),
numbered AS (SELECT *, row_number() OVER (ORDER BY tier, support DESC, description, category) - 1 AS ord FROM single)
SELECT CAST(rule_ord AS BIGINT) AS rule_ord, description, amount, category FROM rule
UNION ALL SELECT (SELECT max(rule_ord) FROM rule) + 1 + ord, description, amount, category FROM numbered n
WHERE NOT EXISTS (SELECT 1 FROM rule r WHERE r.description = n.description AND r.category = n.category)""")
def _(spark, sf):
    learned = learn_rules(scored_lineitem(spark, sf), fixture_rules(spark), corrected_lines(spark, sf))
    return learned.select("rule_ord", "description", "amount", "category")


@query("rules_from_corrections", f"""
WITH {LINE_CORRECTED}
SELECT txn_id, split_part(lower(description), ' ', 1) AS description,
       CASE WHEN p_type = 'PROMO' THEN amount END AS amount,
       CASE WHEN p_type = 'LARGE' THEN '1-31'
            ELSE greatest(1, day(date) - 2) || '-' || least(31, day(date) + 2) END AS day_range,
       new_category AS category
FROM told""")
def _(spark, sf):
    answered = corrected_lines(spark, sf).withColumns(
        {
            "keyword": F.lit(""),
            "with_amount": F.when(F.col("p_type") == "PROMO", "yes please").otherwise("no"),
            "days": F.when(F.col("p_type") == "LARGE", "the full month").otherwise(""),
        }
    )
    made = mi.rules_from_corrections(answered)
    return made.select(
        "txn_id", "description", "amount",
        F.array_join(F.col("day_range").cast("array<string>"), "-").alias("day_range"), "category",
    )


# --- reply texts: each part, written the way replies come --------------------------------

def replies(spark, sf):
    """Clean array, fenced array, bare objects, doubled array, an object cut off
    inside its confidence, an array cut off the same way (which stays lost)."""
    obj = F.format_string(
        '{"description": "%s", "amount": null, "day_range": [1, 5], "category": "%s", "confidence": 0.%s}',
        "p_name", "p_type", F.when(F.col("p_size") > 25, "9").otherwise("75"),
    )
    other = F.format_string('{"description": "%s", "category": "Uncategorized"}', "p_brand")
    cut = F.format_string('{"description": "%s", "category": "%s", "confidence": 0.90', "p_name", "p_type")
    style = F.col("p_partkey") % 6
    text = (
        F.when(style == 0, F.concat(F.lit("["), obj, F.lit(", "), other, F.lit("]")))
        .when(style == 1, F.concat(F.lit("```json\n["), obj, F.lit("]\n```")))
        .when(style == 2, F.concat(obj, F.lit(", "), other))
        .when(style == 3, F.concat(F.lit("[["), obj, F.lit("]]")))
        .when(style == 4, cut)
        .otherwise(F.concat(F.lit("["), cut))
    )
    return table(spark, sf, "part").select(F.col("p_partkey").alias("reply_ord"), text.alias("text"), "p_size")


TEXTS = """
obj AS (
  SELECT p_partkey AS reply_ord, p_partkey % 6 AS style,
    '{"description": "' || p_name || '", "amount": null, "day_range": [1, 5], "category": "' || p_type
      || '", "confidence": 0.' || CASE WHEN p_size > 25 THEN '9' ELSE '75' END || '}' AS o,
    '{"description": "' || p_brand || '", "category": "Uncategorized"}' AS u,
    '{"description": "' || p_name || '", "category": "' || p_type || '", "confidence": 0.90' AS c
  FROM part)"""


@query("repair_json", f"""
WITH {TEXTS}
SELECT reply_ord, CASE style WHEN 0 THEN '[' || o || ', ' || u || ']' WHEN 1 THEN '```json' || chr(10) || '[' || o || ']' || chr(10) || '```'
  WHEN 2 THEN '[' || o || ', ' || u || ']' WHEN 3 THEN '[' || o || ']' WHEN 4 THEN c || '}}' ELSE '[' || c || ']' END AS repaired
FROM obj""")
def _(spark, sf):
    return replies(spark, sf).select("reply_ord", repair_array(F.col("text")).alias("repaired"))


@query("parse_json", """
SELECT p_partkey AS reply_ord,
  CASE p_partkey % 6 WHEN 0 THEN 'array' WHEN 1 THEN 'object' WHEN 3 THEN 'array' ELSE 'none' END AS kind
FROM part""")
def _(spark, sf):
    kind = F.schema_of_variant(parse_json(F.col("text")))
    return replies(spark, sf).select(
        "reply_ord",
        F.when(F.startswith(kind, F.lit("ARRAY")), "array")
        .when(F.startswith(kind, F.lit("OBJECT")), "object").otherwise("none").alias("kind"),
    )


@query("parse_suggestions", """
SELECT p_partkey AS reply_ord, p_name AS description, p_type AS category,
       CASE WHEN p_partkey % 6 = 4 OR p_size > 25 THEN 0.9::DOUBLE ELSE 0.75::DOUBLE END AS confidence
FROM part WHERE p_partkey % 6 <> 5
UNION ALL SELECT p_partkey, p_brand, 'Uncategorized', NULL FROM part WHERE p_partkey % 6 IN (0, 2)""")
def _(spark, sf):
    return mi.parse_replies(replies(spark, sf)).select("reply_ord", "description", "category", "confidence")


def _ingested(least: str, dedupe: bool) -> str:
    chosen = f"""
chosen AS (
  SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS ord, p_name AS description, p_type AS category FROM part
  WHERE p_partkey % 6 <> 5 AND ({least}))"""
    once = "chosen" if not dedupe else \
        "(SELECT min(ord) AS ord, description, category FROM chosen GROUP BY 2, 3)"
    return f"""
WITH {RULE}, {chosen}
SELECT CAST(rule_ord AS BIGINT) AS rule_ord, description, category FROM rule
UNION ALL SELECT (SELECT max(rule_ord) FROM rule) + 1 + ord, description, category FROM {once}"""


@query("ingest_suggestions", _ingested("true", False))
def _(spark, sf):
    return mi.ingest_suggestions(replies(spark, sf), fixture_rules(spark)).select("rule_ord", "description", "category")


@query("ingest_correction_suggestions", _ingested("p_partkey % 6 = 4 OR p_size > 25", True))
def _(spark, sf):
    return mi.ingest_suggestions(replies(spark, sf), fixture_rules(spark), "corrections").select(
        "rule_ord", "description", "category"
    )


# --- review --------------------------------------------------------------------------------


def responses(spark, sf):
    """Answers by the row's number; rows scored 0.78 end the review. A plain
    "yes" holds an "s", which is tested before it and skips."""
    k, turn = F.col("k"), F.col("k") % 6
    said = (
        F.when(k == 78, "Quit")
        .when(turn == 0, "Change to Food").when(turn == 1, "this should be Travel")
        .when(turn == 2, "yes").when(turn == 3, "okay").when(turn == 4, "please change it")
        .otherwise("update: rent")
    )
    return scored_events(spark, sf).select(
        "txn_id", said.alias("response"), (k % 14).cast("string").alias("entry"),
        F.when(k % 2 == 0, "yes").otherwise("no").alias("make_rule"),
    )


ANSWERS = SCORED + """,
queue AS (
  SELECT *, CASE WHEN k = 78 THEN 'quit' ELSE ['change','change','skip','accept','change','change'][k % 6 + 1] END AS intent,
    CASE WHEN k = 78 THEN 'x' WHEN k % 6 = 0 THEN 'Food' WHEN k % 6 = 1 THEN 'Travel' WHEN k % 6 = 5 THEN 'Rent'
         ELSE coalesce(['Entertainment','Food','Payments','Shopping','Travel','Fees','Subscriptions','Insurance',
           'Investments','Rent','Income','Uncategorized'][nullif(k % 14, 0)], 'Uncategorized') END AS new_category
  FROM scored WHERE confidence < 0.8),
stop AS (SELECT confidence, coalesce(category, '') AS category, seq FROM queue WHERE intent = 'quit'
         ORDER BY confidence, category, seq LIMIT 1),
heard AS (
  SELECT * FROM queue q WHERE NOT EXISTS (SELECT 1 FROM stop s
    WHERE (q.confidence, coalesce(q.category, ''), q.seq) >= (s.confidence, s.category, s.seq)))"""


@query("review_items", f"""
WITH {SCORED}
SELECT txn_id, nullif(regexp_extract(reasoning, 'Low confidence \\([0-9.]+\\) for ''([^'']+)''', 1), '') AS suggested
FROM scored WHERE confidence < 0.8""")
def _(spark, sf):
    return review_items(scored_events(spark, sf)).select("txn_id", "suggested")


@query("review_answers", f"""
WITH {ANSWERS} SELECT txn_id, intent FROM heard""")
def _(spark, sf):
    return read_answers(scored_events(spark, sf), responses(spark, sf)).select("txn_id", "intent")


@query("review_batch", f"""
WITH {ANSWERS}, fixed AS (SELECT txn_id, new_category FROM heard WHERE intent = 'change')
SELECT txn_id, coalesce(new_category, category) AS category,
       CASE WHEN new_category IS NOT NULL THEN 1.0::DOUBLE ELSE confidence END AS confidence
FROM scored LEFT JOIN fixed USING (txn_id)""")
def _(spark, sf):
    applied, _, _ = review_batch(scored_events(spark, sf), responses(spark, sf))
    return applied.select("txn_id", "category", "confidence")


@query("review_corrections", f"""
WITH {ANSWERS} SELECT txn_id, category AS original_category, new_category FROM heard WHERE intent = 'change'""")
def _(spark, sf):
    _, corrections, _ = review_batch(scored_events(spark, sf), responses(spark, sf))
    return corrections.select("txn_id", "original_category", "new_category")


@query("review_rules", f"""
WITH {ANSWERS}
SELECT txn_id, source AS description, new_category AS category,
       greatest(1, day(date) - 2) || '-' || least(31, day(date) + 2) AS day_range
FROM heard WHERE intent = 'change' AND k % 2 = 0""")
def _(spark, sf):
    _, _, rules = review_batch(scored_events(spark, sf), responses(spark, sf))
    return rules.select(
        "txn_id", "description", "category",
        F.array_join(F.col("day_range").cast("array<string>"), "-").alias("day_range"),
    )
