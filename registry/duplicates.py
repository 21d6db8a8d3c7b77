"""Duplicates, ordering, batches, samples, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from coinsieve.functions.keys import KEY_PARTS
from coinsieve.operators import dedupe as dd
from coinsieve.operators import order, rows
from coinsieve.operators.aggregate import pattern_counts, top_patterns
from coinsieve.plans.dedupe import dedupe
from coinsieve.sources.statements import combine
from registry.core import query
from registry.views import (
    LINE, RAW_ORDERS, RULE, SCORED, TXN, fixture_rules, raw_orders, scored_events, table, txn_events,
    txn_lineitem,
)

# Events of one type, day and rounded value count as copies of each other.
DUP = TXN.replace("txn AS (", "every AS (", 1) + ",\ntxn AS (SELECT * REPLACE (source AS normalized_desc) FROM every)"


def dup_events(spark, sf):
    return txn_events(spark, sf).withColumn("normalized_desc", F.col("source"))


KEY_SQL = "date, abs(amount), normalized_desc"
SHOWN = ["txn_id", "date", "amount", "description", "is_duplicate", "dedupe_reasoning"]


@query("flag_duplicates", f"""
WITH {DUP} SELECT txn_id, count(*) OVER (PARTITION BY {KEY_SQL}) > 1 AS is_duplicate FROM txn""")
def _(spark, sf):
    return dd.flag_duplicates(dup_events(spark, sf)).select("txn_id", "is_duplicate")


@query("duplicate_rows", f"""
WITH {DUP} SELECT txn_id, description FROM txn QUALIFY count(*) OVER (PARTITION BY {KEY_SQL}) > 1""")
def _(spark, sf):
    return dd.duplicates(dd.flag_duplicates(dup_events(spark, sf))).select("txn_id", "description")


@query("dedupe_exact", f"""
WITH {DUP}
SELECT txn_id, date, amount, description, n > 1 AS is_duplicate, 'Basic deduplication' AS dedupe_reasoning
FROM (SELECT *, count(*) OVER (PARTITION BY {KEY_SQL}) AS n,
             row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY seq) AS rn FROM txn) WHERE rn = 1""")
def _(spark, sf):
    return dedupe(dup_events(spark, sf)).select(*SHOWN)


UNDATED = DUP + ", undated AS (SELECT * REPLACE (CASE WHEN k % 10 = 0 THEN NULL ELSE date END AS date) FROM txn)"


def undated_events(spark, sf):
    return dup_events(spark, sf).withColumn("date", F.when(F.col("k") % 10 != 0, F.col("date")))


@query("dedupe_keep_null_keys", f"""
WITH {UNDATED}
SELECT txn_id, date, amount, description, n > 1 AND date IS NOT NULL AS is_duplicate,
       'Basic deduplication' AS dedupe_reasoning
FROM (SELECT *, count(*) OVER (PARTITION BY {KEY_SQL}) AS n,
             row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY seq) AS rn FROM undated)
WHERE rn = 1 OR date IS NULL""")
def _(spark, sf):
    return dedupe(undated_events(spark, sf)).select(*SHOWN)


@query("dedupe_collapse_null_keys", f"""
WITH {UNDATED},
keyed AS (SELECT *, CASE WHEN date IS NOT NULL THEN abs(amount) END AS ka,
                 CASE WHEN date IS NOT NULL THEN normalized_desc END AS kn FROM undated)
SELECT txn_id, date, amount, description, n > 1 AS is_duplicate, 'Basic deduplication' AS dedupe_reasoning
FROM (SELECT *, count(*) OVER (PARTITION BY date, ka, kn) AS n,
             row_number() OVER (PARTITION BY date, ka, kn ORDER BY seq) AS rn FROM keyed) WHERE rn = 1""")
def _(spark, sf):
    return dedupe(undated_events(spark, sf), null_keys="collapse").select(*SHOWN)


@query("flag_duplicates_null_keys", f"""
WITH {UNDATED},
keyed AS (SELECT *, CASE WHEN date IS NOT NULL THEN abs(amount) END AS ka,
                 CASE WHEN date IS NOT NULL THEN normalized_desc END AS kn FROM undated)
SELECT txn_id, date, count(*) OVER (PARTITION BY date, ka, kn) > 1 AS is_duplicate FROM keyed""")
def _(spark, sf):
    return dd.flag_duplicates(undated_events(spark, sf)).select("txn_id", "date", "is_duplicate")


@query("duplicate_groups", f"""
WITH {DUP}
SELECT date AS key_date, abs(amount) AS key_amount, normalized_desc AS key_desc, count(*) AS n, min(seq) AS first_seq,
       count(*) AS members, CAST(sum(seq) AS BIGINT) AS seq_sum
FROM txn GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def _(spark, sf):
    """Groups with a digest of their members, added up over the parts."""
    seqs = F.aggregate("members", F.lit(0).cast("bigint"), lambda total, m: total + m["seq"])
    groups = dd.duplicate_groups(dup_events(spark, sf)).withColumn("seqs", seqs)
    return groups.groupBy(*KEY_PARTS, "n", "first_seq").agg(
        F.sum(F.size("members")).alias("members"), F.sum("seqs").alias("seq_sum")
    )


@query("duplicate_records_json", f"""
WITH {DUP}
SELECT txn.normalized_desc AS key_desc, txn.date AS key_date, abs(amount) AS key_amount,
  '[' || string_agg('{{"Date":"' || strftime(date, '%m/%d/%Y') || '","Description":"' || description || '"}}', ',' ORDER BY seq)
  || ']' AS records
FROM txn GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def _(spark, sf):
    shown = F.transform(
        "members",
        lambda m: F.struct(F.date_format(m["date"], "MM/dd/yyyy").alias("Date"), m["description"].alias("Description")),
    )
    return dd.duplicate_groups(dup_events(spark, sf)).select(*KEY_PARTS, F.to_json(shown).alias("records"))


def verdicts(spark, sf):
    """Groups of views are called different, groups of errors failed to be judged."""
    groups = dd.key_counts(dup_events(spark, sf)).filter("n > 1")
    kind = F.col("key_desc")
    return groups.select(
        *KEY_PARTS,
        (~F.contains(kind, F.lit("view"))).alias("is_duplicate"),
        F.when(F.contains(kind, F.lit("view")), "two visits").otherwise("same charge").alias("reasoning"),
        F.contains(kind, F.lit("error")).alias("failed"),
    )


JUDGED = f"""
judged AS (
  SELECT *, count(*) OVER (PARTITION BY {KEY_SQL}) AS n, row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY seq) AS rn
  FROM txn),
verdict AS (
  SELECT *, n > 1 AND source <> 'view' AS is_duplicate,
    CASE WHEN n = 1 THEN '' WHEN source = 'view' THEN 'Not a duplicate. two visits'
         WHEN source = 'error' THEN 'Kept as primary (fallback to basic deduplication due to error)'
         ELSE 'Kept as primary. same charge' END AS dedupe_reasoning
  FROM judged)"""


@query("dedupe_adjudicated", f"""
WITH {DUP}, {JUDGED}
SELECT txn_id, date, amount, description, is_duplicate, dedupe_reasoning FROM verdict WHERE rn = 1 OR source = 'view'""")
def _(spark, sf):
    return dd.dedupe_adjudicated(dup_events(spark, sf), verdicts(spark, sf)).select(*SHOWN)


@query("dropped_duplicates", f"""
WITH {DUP}, {JUDGED} SELECT txn_id, description FROM verdict WHERE rn > 1 AND source <> 'view'""")
def _(spark, sf):
    marked = dd.dedupe_adjudicated(dup_events(spark, sf), verdicts(spark, sf), keep_dropped=True)
    return marked.filter("dropped").select("txn_id", "description")


@query("dedupe_summary", f"""
WITH {DUP}, {JUDGED}
SELECT (SELECT count(*) FROM (SELECT 1 FROM txn GROUP BY {KEY_SQL} HAVING count(*) > 1)) AS groups,
       count(*) AS rows_before, count(*) FILTER (WHERE rn = 1 OR source = 'view') AS rows_after,
       count(*) FILTER (WHERE rn > 1 AND source <> 'view') AS removed,
       count(*) FILTER (WHERE n > 1 AND source = 'view') AS false_positives
FROM verdict""")
def _(spark, sf):
    df = dup_events(spark, sf)
    return dd.dedupe_summary(df, dd.dedupe_adjudicated(df, verdicts(spark, sf)))


@query("review_queue", f"""
WITH {SCORED} SELECT txn_id, confidence, category FROM scored WHERE confidence < 0.8
ORDER BY confidence, category NULLS FIRST, seq""")
def _(spark, sf):
    return order.review_queue(scored_events(spark, sf)).select("txn_id", "confidence", "category")


@query("batches", """
SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 50 AS BIGINT) AS batch FROM documents""")
def _(spark, sf):
    return order.batched(table(spark, sf, "documents").select("doc_id"), "doc_id")


@query("sample_examples", f"""
WITH {SCORED}
SELECT category, txn_id, description FROM scored WHERE confidence >= 0.9 AND category <> 'Uncategorized'
QUALIFY row_number() OVER (PARTITION BY category ORDER BY md5(txn_id || ':7'), txn_id) <= 2""")
def _(spark, sf):
    return order.sample_examples(scored_events(spark, sf), 2, "7").select("category", "txn_id", "description")


@query("few_shot_examples", f"""
WITH {SCORED},
told AS (
  SELECT category, seq, printf('%s $%.2f', description, amount) AS example,
         row_number() OVER (PARTITION BY category ORDER BY seq) AS r
  FROM scored WHERE amount <> 0),
fixed AS (
  SELECT * FROM (VALUES ('Shopping', 1, 'shoes $1.00'), ('Shopping', 2, 'hat $2.00'), ('Shopping', 3, 'coat $3.00'),
    ('Shopping', 4, 'ring $4.00'), ('Travel', 1, 'bus $1.00'), ('Travel', 2, 'train $2.00'),
    ('Rent', 1, 'flat $9.00'), ('Entertainment', 1, 'film $7.00')) v(category, r, example)),
pool AS (
  SELECT category, 0 AS tier, r, example FROM told t
  WHERE category IN (SELECT category FROM fixed) AND r <= 5 - (SELECT count(*) FROM fixed f WHERE f.category = t.category)
  UNION ALL SELECT category, 1, r, example FROM fixed)
SELECT category, CAST(row_number() OVER (PARTITION BY category ORDER BY tier, r) AS INTEGER) AS rank, example FROM pool
QUALIFY row_number() OVER (PARTITION BY category ORDER BY tier, r) <= 3""")
def _(spark, sf):
    static = order.static_examples(
        spark,
        {"Shopping": ["shoes $1.00", "hat $2.00", "coat $3.00", "ring $4.00"],
         "Travel": ["bus $1.00", "train $2.00"], "Rent": ["flat $9.00"], "Entertainment": ["film $7.00"]},
    )
    return order.few_shot(static, scored_events(spark, sf).withColumn("new_category", F.col("category")))


@query("top_patterns", f"""
WITH {SCORED}
SELECT normalized_desc, count(*) AS n FROM scored WHERE category = 'Uncategorized'
GROUP BY 1 ORDER BY n DESC, normalized_desc LIMIT 5""")
def _(spark, sf):
    return top_patterns(pattern_counts(rows.uncategorized(scored_events(spark, sf))), "normalized_desc")


@query("combine_sources", f"""
WITH {RAW_ORDERS}, {LINE}
SELECT "Order Desc" AS description, NULL::DOUBLE AS amount, "Order Amount" AS raw_amount FROM raw
UNION ALL SELECT description, amount, NULL FROM line""")
def _(spark, sf):
    exported = raw_orders(spark, sf).select(
        F.col("Order Desc").alias("description"), F.col("Order Amount").alias("raw_amount")
    )
    return combine(exported, txn_lineitem(spark, sf).select("description", "amount"))


def suggested_rules(spark, sf):
    """One suggestion per part name and type, in that order of size."""
    part = table(spark, sf, "part")
    counted = part.groupBy("p_name", "p_type").agg(F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("suggestion_ord"))
    word = F.element_at(F.split("p_name", " "), -1)
    return counted.select(
        "suggestion_ord", word.alias("description"), F.lit(None).cast("double").alias("amount"),
        F.array(F.lit(1), F.lit(31)).alias("day_range"),
        F.when(F.col("p_type") == "ECONOMY", "A").when(F.col("p_type") == "PROMO", "C").otherwise("Z").alias("category"),
    )


SUGGESTED = """
suggested AS (
  SELECT min(p_partkey) AS suggestion_ord, split_part(p_name, ' ', -1) AS description,
         CASE p_type WHEN 'ECONOMY' THEN 'A' WHEN 'PROMO' THEN 'C' ELSE 'Z' END AS category
  FROM part GROUP BY p_name, p_type)"""


@query("new_rules_only", f"""
WITH {RULE}, {SUGGESTED}
SELECT suggestion_ord, s.description, s.category FROM suggested s
WHERE NOT EXISTS (SELECT 1 FROM rule r WHERE r.description = s.description AND r.category = s.category)""")
def _(spark, sf):
    return order.new_rules_only(suggested_rules(spark, sf), fixture_rules(spark)).select(
        "suggestion_ord", "description", "category"
    )


@query("append_rules", f"""
WITH {RULE}, {SUGGESTED},
fresh AS (
  SELECT description, category, min(suggestion_ord) AS suggestion_ord FROM suggested s
  WHERE NOT EXISTS (SELECT 1 FROM rule r WHERE r.description = s.description AND r.category = s.category)
  GROUP BY 1, 2)
SELECT CAST(rule_ord AS BIGINT) AS rule_ord, description, category FROM rule
UNION ALL SELECT (SELECT max(rule_ord) FROM rule) + 1 + suggestion_ord, description, category FROM fresh""")
def _(spark, sf):
    rules = fixture_rules(spark)
    fresh = order.first_of_each(order.new_rules_only(suggested_rules(spark, sf), rules))
    return order.append_rules(rules, fresh).select("rule_ord", "description", "category")
