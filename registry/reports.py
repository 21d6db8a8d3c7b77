"""Counts, distributions, statistics, logs and the summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from coinsieve.operators import aggregate as ag
from coinsieve.operators import rows
from coinsieve.operators.cache import latest_corrections, apply_corrections
from coinsieve.plans.dedupe import dedupe
from coinsieve.plans.summary import summary
from coinsieve.session import scratch_path
from coinsieve.sources.tables import parse_log, read_log
from registry.cleaning import CALLS, call_log
from registry.core import query
from registry.duplicates import KEY_SQL
from registry.views import (
    CORRECTED, SCORED, corrected_events, scored_events, table,
)


@query("pattern_counts", f"""
WITH {SCORED}
SELECT normalized_desc, count(*) AS n FROM scored WHERE category = 'Uncategorized' GROUP BY 1""")
def _(spark, sf):
    return ag.pattern_counts(rows.uncategorized(scored_events(spark, sf)))


LOW = "confidence < 0.7 AND category IS DISTINCT FROM 'Uncategorized'"


@query("category_pattern_counts", f"""
WITH {SCORED}
SELECT category || ': ' || normalized_desc AS category_desc, count(*) AS n FROM scored
WHERE {LOW} AND category IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    return ag.category_pattern_counts(rows.low_confidence(scored_events(spark, sf)))


DISTRIBUTION = """
SELECT category, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM {t}), 1)::DOUBLE AS pct
FROM {t} WHERE category IS NOT NULL GROUP BY 1 ORDER BY n DESC, category"""


@query("category_distribution", f"WITH {SCORED} {DISTRIBUTION.format(t='scored')}")
def _(spark, sf):
    return ag.category_distribution(scored_events(spark, sf))


@query("low_confidence_distribution", f"""
WITH {SCORED}, low AS (SELECT * FROM scored WHERE {LOW}) {DISTRIBUTION.format(t='low')}""")
def _(spark, sf):
    return ag.category_distribution(rows.low_confidence(scored_events(spark, sf)))


CONFIDENCE = """
SELECT count(*) AS n, round(avg(confidence), 4) AS avg_confidence, count(*) FILTER (WHERE confidence < 0.7) AS low_n,
       coalesce(round(count(*) FILTER (WHERE confidence < 0.7) * 100.0 / nullif(count(*), 0), 1), 0)::DOUBLE AS low_pct
FROM {t}"""


@query("confidence_summary", f"WITH {SCORED} {CONFIDENCE.format(t='scored')}")
def _(spark, sf):
    return ag.confidence_summary(scored_events(spark, sf))


@query("confidence_summary_empty", f"""
WITH {SCORED}, nothing AS (SELECT * FROM scored WHERE confidence > 2) {CONFIDENCE.format(t='nothing')}""")
def _(spark, sf):
    return ag.confidence_summary(scored_events(spark, sf).filter("confidence > 2"))


@query("corrections_by_category", f"""
WITH {CORRECTED} SELECT new_category, count(*) AS n FROM corrected GROUP BY 1""")
def _(spark, sf):
    return ag.corrections_by_category(corrected_events(spark, sf))


@query("uncategorized_before_after", f"""
WITH {CORRECTED}, fixed AS (SELECT DISTINCT txn_id FROM corrected)
SELECT count(*) FILTER (WHERE category = 'Uncategorized') AS before,
       count(*) FILTER (WHERE category = 'Uncategorized' AND txn_id NOT IN (SELECT txn_id FROM fixed)) AS after
FROM scored""")
def _(spark, sf):
    before = scored_events(spark, sf)
    return ag.uncategorized_counts(before, apply_corrections(before, corrected_events(spark, sf)))


METHODS = """
m AS (SELECT count(*) FILTER (WHERE match_type = 'exact') AS e, count(*) FILTER (WHERE match_type = 'fuzzy') AS f,
             count(*) FILTER (WHERE match_type = 'model') AS l FROM scored)"""


@query("match_type_stats", f"""
WITH {SCORED}, {METHODS}
SELECT e AS exact_n, f AS fuzzy_n, l AS model_n, round(e * 100.0 / (e + f + l), 1)::DOUBLE AS exact_pct,
       round(f * 100.0 / (e + f + l), 1)::DOUBLE AS fuzzy_pct, round(l * 100.0 / (e + f + l), 1)::DOUBLE AS model_pct,
       round(f * 100.0 / (e + f), 1)::DOUBLE AS fuzzy_of_rules_pct, round(f * 0.0001::DOUBLE, 4) AS estimated_saving
FROM m""")
def _(spark, sf):
    return ag.match_type_stats(scored_events(spark, sf))


USAGE = CALLS + """,
priced AS (
  SELECT *, prompt_chars / 3.0::DOUBLE + response_chars / 2.0::DOUBLE AS tokens,
    CASE model WHEN 'gpt-4o' THEN 'gpt-4' WHEN 'gpt-3.5-turbo' THEN 'gpt-3.5' ELSE 'other' END AS family,
    CASE model WHEN 'gpt-4o' THEN 0.00001::DOUBLE WHEN 'gpt-3.5-turbo' THEN 0.000001::DOUBLE ELSE 0 END AS price,
    CASE turn % 5 WHEN 0 THEN 'normalization' WHEN 1 THEN 'categorization' WHEN 2 THEN 'rule_generation'
         WHEN 3 THEN 'deduplication' ELSE 'other' END AS purpose
  FROM calls),
rolled AS (
  SELECT family, purpose, count(*) AS calls, CAST(sum(prompt_chars) AS BIGINT) AS prompt_chars,
         CAST(sum(response_chars) AS BIGINT) AS response_chars, round(sum(tokens), 2) AS tokens,
         round(sum(tokens * price), 8) AS cost
  FROM priced GROUP BY 1, 2)"""


@query("usage_report", f"WITH {USAGE} SELECT * FROM rolled")
def _(spark, sf):
    return ag.usage_report(call_log(spark, sf))


# --- logs ---------------------------------------------------------------------------

LOG = """
log AS (
  SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS logged,
         CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, event_type || ' ' || props AS message
  FROM events)"""


def log_lines(spark, sf):
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(",000 - "), level, F.lit(" - "),
        "event_type", F.lit(" "), "props",
    )
    return table(spark, sf, "events").select("event_id", line.alias("value"))


@query("parse_log", f"""
WITH {LOG} SELECT event_id, logged, level, message FROM log""")
def _(spark, sf):
    parsed = parse_log(log_lines(spark, sf))
    return parsed.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("logged"), "level", "message")


@query("filter_log", f"""
WITH {LOG} SELECT event_id, message FROM log WHERE level = 'ERROR' AND contains(message, '"k": 4')""")
def _(spark, sf):
    return rows.filter_log(parse_log(log_lines(spark, sf)), "ERROR", '"k": 4').select("event_id", "message")


@query("tail_log", f"""
WITH {LOG} SELECT event_id, message FROM log WHERE level = 'ERROR' ORDER BY event_id DESC LIMIT 50""")
def _(spark, sf):
    errors = rows.filter_log(parse_log(log_lines(spark, sf)), "ERROR")
    return rows.tail_log(errors, 50, ("event_id",)).select("event_id", "message")


@query("log_file_levels", f"""
WITH {LOG} SELECT level, count(*) AS n, min(logged) AS first, max(logged) AS last FROM log GROUP BY 1""")
def _(spark, sf):
    """The log as text files, read back."""
    path = scratch_path(spark, "log")
    log_lines(spark, sf).select("value").write.text(path)
    shown = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return read_log(spark, path).groupBy("level").agg(
        F.count(F.lit(1)).alias("n"), F.min(shown).alias("first"), F.max(shown).alias("last")
    )


# --- the summary -----------------------------------------------------------------------

SUMMARY = f"""
WITH {SCORED.replace("txn AS (", "every AS (", 1)
      .replace("scored AS (", "txn AS (SELECT * REPLACE (source AS normalized_desc) FROM every), scored AS (", 1)},
{METHODS}, {USAGE},
kept AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY seq) = 1),
sizes AS (SELECT (SELECT count(*) FROM scored) AS b, (SELECT count(*) FROM kept) AS a,
  (SELECT count(*) FROM (SELECT 1 FROM scored GROUP BY {KEY_SQL} HAVING count(*) > 1)) AS g),
shares AS ({DISTRIBUTION.format(t='kept')}),
sure AS ({CONFIDENCE.format(t='kept')}),
lines AS (
  SELECT 'transactions' AS section, unnest(['groups','rows_before','rows_after','removed','false_positives']) AS metric,
         unnest([g, b, a, b - a, 0])::DOUBLE AS value FROM sizes
  UNION ALL SELECT 'categories', category || '.n', n FROM shares
  UNION ALL SELECT 'categories', category || '.pct', pct FROM shares
  UNION ALL SELECT 'confidence', unnest(['avg_confidence','low_n','low_pct']), unnest([avg_confidence, low_n, low_pct]) FROM sure
  UNION ALL SELECT 'methods', unnest(['exact_n','fuzzy_n','model_n','exact_pct','fuzzy_pct','model_pct','fuzzy_of_rules_pct','estimated_saving']),
    unnest([e, f, l, round(e * 100.0 / (e + f + l), 1), round(f * 100.0 / (e + f + l), 1), round(l * 100.0 / (e + f + l), 1),
            round(f * 100.0 / (e + f), 1), round(f * 0.0001, 4)]::DOUBLE[]) FROM m
  UNION ALL SELECT 'usage', family || '.' || purpose || '.' || unnest(['calls', 'tokens', 'cost']), unnest([calls, tokens, cost]) FROM rolled)
SELECT section, metric, value FROM lines"""


@query("summary", SUMMARY)
def _(spark, sf):
    before = scored_events(spark, sf).withColumn("normalized_desc", F.col("source"))
    return summary(before, dedupe(before), call_log=call_log(spark, sf))


@query("latest_corrections", f"""
WITH {CORRECTED} SELECT txn_id, max_by(new_category, correction_ord) AS new_category FROM corrected GROUP BY 1""")
def _(spark, sf):
    return latest_corrections(corrected_events(spark, sf))
