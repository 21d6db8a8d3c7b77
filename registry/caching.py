"""Caches, resume, updates and corrections."""

from __future__ import annotations

from pyspark.sql import functions as F

from coinsieve.functions.keys import description_key
from coinsieve.functions.text import normalize_description
from coinsieve.operators import cache as ca
from coinsieve.session import scratch_path
from coinsieve.schema import NORMALIZE_CACHE
from coinsieve.sources.sinks import write_cache
from coinsieve.sources.tables import load_cache
from registry.core import query
from registry.views import (
    CORRECTED, SCORED, corrected_events, scored_events, table, txn_events,
)

# Texts of labelled documents are in the cache.
CACHED = """
cache AS (
  SELECT md5(text) AS key, min(doc_id) AS first_doc, count(*) AS hits
  FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY 1)"""


def documents(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", "text", description_key(F.col("text")).alias("text_key")
    )


def document_cache(spark, sf):
    docs = documents(spark, sf).join(table(spark, sf, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    return docs.groupBy(F.col("text_key").alias("key")).agg(
        F.min("doc_id").alias("result"), F.count(F.lit(1)).alias("hits")
    )


@query("cache_lookup", f"""
WITH {CACHED}
SELECT d.doc_id, c.first_doc AS cached FROM documents d LEFT JOIN cache c ON c.key = md5(d.text)""")
def _(spark, sf):
    found = ca.lookup_cache(documents(spark, sf), document_cache(spark, sf), "text_key", "doc_id")
    return found.select("doc_id", "cached")


@query("cache_misses", f"""
WITH {CACHED}
SELECT md5(text) AS text_key, min(doc_id) AS doc_id FROM documents
WHERE md5(text) NOT IN (SELECT key FROM cache) GROUP BY 1""")
def _(spark, sf):
    return ca.cache_misses(documents(spark, sf), document_cache(spark, sf), "text_key", "doc_id")


@query("cache_stats", f"""
WITH {CACHED}, used AS (SELECT md5(text) IN (SELECT key FROM cache) AS hit FROM documents)
SELECT (SELECT count(*) FROM cache) AS entries, count(*) FILTER (WHERE hit) AS hits,
       count(*) FILTER (WHERE NOT hit) AS misses,
       round(count(*) FILTER (WHERE hit) * 100.0 / count(*), 1)::DOUBLE AS hit_rate FROM used""")
def _(spark, sf):
    return ca.cache_stats(documents(spark, sf), document_cache(spark, sf), "text_key")


@query("cache_hit_counts", f"""
WITH {CACHED}
SELECT key, c.hits + (SELECT count(*) FROM documents d WHERE md5(d.text) = c.key) AS hits FROM cache c""")
def _(spark, sf):
    return ca.count_hits(documents(spark, sf), document_cache(spark, sf), "text_key").select("key", "hits")


@query("cache_update", f"""
WITH {CACHED}
SELECT md5(text) AS key, min(doc_id) AS result FROM documents GROUP BY 1""")
def _(spark, sf):
    """Old entries and entries for all misses; misses give the first document."""
    cache = document_cache(spark, sf)
    new = documents(spark, sf).groupBy(F.col("text_key").alias("key")).agg(F.min("doc_id").alias("result"))
    return ca.add_entries(cache, new).select("key", "result")


@query("cache_round_trip", """
SELECT md5(text) AS key, md5(min(text)) AS original, count(*) AS hits FROM documents GROUP BY 1""")
def _(spark, sf):
    """A normalization cache written as a table and loaded again."""
    entries = documents(spark, sf).groupBy(F.col("text_key").alias("key")).agg(
        F.min("text").alias("original"), F.count(F.lit(1)).alias("hits")
    ).select(
        "key", "original", normalize_description(F.col("original")).alias("result"),
        F.lit(None).cast("timestamp").alias("ts"), "hits", F.lit(None).cast("string").alias("error"),
        F.lit(False).alias("batch_processed"), F.lit(True).alias("fallback_used"),
    )
    path = scratch_path(spark, "cache")
    write_cache(entries, path)
    return load_cache(spark, path, NORMALIZE_CACHE).select("key", F.md5("original").alias("original"), "hits")


# Events up to the middle of the month were categorized by an earlier run.
EARLIER = SCORED + """,
saved AS (SELECT *, strftime(date, '%m/%d/%Y') || ':' || description || ':' || CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR) AS txn_key
          FROM scored WHERE date < DATE '2024-01-16'),
keyed AS (SELECT *, strftime(date, '%m/%d/%Y') || ':' || description || ':' || CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR) AS txn_key
          FROM txn),
first_saved AS (
  SELECT txn_key, category, confidence, reasoning, normalized_desc FROM saved
  QUALIFY row_number() OVER (PARTITION BY txn_key ORDER BY seq) = 1)"""


def earlier_run(spark, sf):
    return scored_events(spark, sf).filter("date < '2024-01-16'")


@query("first_saved", f"""
WITH {EARLIER} SELECT txn_key, category, confidence, reasoning FROM first_saved""")
def _(spark, sf):
    return ca.first_saved(earlier_run(spark, sf)).select(
        "txn_key", "saved.category", "saved.confidence", "saved.reasoning"
    )


@query("processed_rows", f"""
WITH {EARLIER} SELECT txn_id, txn_key FROM keyed WHERE txn_key IN (SELECT txn_key FROM saved)""")
def _(spark, sf):
    return ca.mark_processed(txn_events(spark, sf), earlier_run(spark, sf)).select("txn_id", "txn_key")


@query("resume", f"""
WITH {EARLIER}
SELECT txn_id, f.txn_key IS NOT NULL AS is_processed, f.category, f.confidence, f.reasoning
FROM keyed k LEFT JOIN first_saved f USING (txn_key)""")
def _(spark, sf):
    return ca.resume_from(txn_events(spark, sf), earlier_run(spark, sf)).select(
        "txn_id", "is_processed", "category", "confidence", "reasoning"
    )


@query("update_rows", f"""
WITH {SCORED}
SELECT txn_id, CASE WHEN source = 'error' THEN coalesce('Retried', category) ELSE category END AS category,
       CASE WHEN source = 'error' AND amount > -20 THEN 0.99::DOUBLE ELSE confidence END AS confidence
FROM scored""")
def _(spark, sf):
    scored = scored_events(spark, sf)
    updates = scored.filter("source = 'error'").select(
        "txn_id", F.lit("Retried").alias("category"), F.when(F.col("amount") > -20, 0.99).alias("confidence")
    )
    return ca.update_from(scored, updates).select("txn_id", "category", "confidence")


LATEST = CORRECTED + """,
latest AS (SELECT txn_id, max_by(new_category, correction_ord) AS new_category FROM corrected GROUP BY 1)"""


@query("apply_corrections", f"""
WITH {LATEST}
SELECT txn_id, coalesce(new_category, category) AS category,
       CASE WHEN new_category IS NOT NULL THEN 1.0::DOUBLE ELSE confidence END AS confidence,
       CASE WHEN new_category IS NOT NULL THEN 'User override during interactive review' ELSE reasoning END AS reasoning
FROM scored LEFT JOIN latest USING (txn_id)""")
def _(spark, sf):
    return ca.apply_corrections(scored_events(spark, sf), corrected_events(spark, sf)).select(
        "txn_id", "category", "confidence", "reasoning"
    )
