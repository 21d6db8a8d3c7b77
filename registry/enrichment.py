"""Pluggable functions: enrichment, classification, adjudication, prompts."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import functions as F

from coinsieve.operators import enrich as en
from coinsieve.operators.aggregate import usage_report
from coinsieve.operators.dedupe import dedupe_adjudicated, duplicate_groups
from coinsieve.operators.order import static_examples
from coinsieve.plans.categorize import Model, categorize
from coinsieve.plans.dedupe import dedupe
from coinsieve.schema import CATEGORIES
from coinsieve.session import materialize, scratch_path
from coinsieve.sources.tables import load_call_log
from registry.core import query
from registry.duplicates import DUP, JUDGED, SHOWN, dup_events
from registry.matching import CASCADE, RESULT, event_rules
from registry.views import TXN, fixture_keywords, table, txn_events


def digest_lines(texts: list[str]) -> str:
    """Stands in for a model: one line per text."""
    return "\n".join(hashlib.md5(t.encode()).hexdigest() for t in texts)


def short_lines(texts: list[str]) -> str:
    """A model that answers nothing."""
    return "\n \n"


def as_txns(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("txn_id"), F.col("text").alias("description")
    )


@query("enrich_documents", """
SELECT CAST(doc_id AS VARCHAR) AS txn_id, md5(text) AS normalized_desc FROM documents""")
def _(spark, sf):
    rows, _ = en.enrich(as_txns(spark, sf), digest_lines, en.empty_cache(spark))
    return rows.select("txn_id", "normalized_desc")


@query("enrich_cache_entries", """
SELECT md5(text) AS key, md5(text) AS result, true AS batch_processed, false AS fallback_used
FROM documents GROUP BY 1""")
def _(spark, sf):
    """A second pass over the whole table adds nothing to the entries of the
    first, which saw the labelled documents."""
    docs = as_txns(spark, sf)
    labelled = table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("txn_id")).distinct()
    _, cache = en.enrich(docs.join(labelled, "txn_id", "left_semi"), digest_lines, en.empty_cache(spark))
    _, entries = en.enrich(docs, digest_lines, cache)
    return entries.select("key", "result", "batch_processed", "fallback_used")


@query("enrich_fallback", f"""
WITH {TXN} SELECT txn_id, normalized_desc FROM txn""")
def _(spark, sf):
    """Every line is missing, so every result is the basic normalization."""
    rows, _ = en.enrich(txn_events(spark, sf).drop("normalized_desc"), short_lines, en.empty_cache(spark))
    return rows.select("txn_id", "normalized_desc")


class FailsFirst:
    """A model whose first two answers to a batch are errors."""

    def __init__(self) -> None:
        self.calls: dict[tuple[str, ...], int] = {}

    def __call__(self, texts: list[str]) -> str:
        tried = self.calls[tuple(texts)] = self.calls.get(tuple(texts), 0) + 1
        if tried < 3:
            raise RuntimeError("busy")
        return digest_lines(texts)


@query("enrich_retried", """
SELECT CAST(doc_id AS VARCHAR) AS txn_id, md5(text) AS normalized_desc FROM documents""")
def _(spark, sf):
    """Two calls of three fail, which no result shows."""
    rows, _ = en.enrich(as_txns(spark, sf), FailsFirst(), en.empty_cache(spark), attempts=3, wait=(0.0, 0.0))
    return rows.select("txn_id", "normalized_desc")


@query("enrich_given_up", f"""
WITH {TXN} SELECT txn_id, normalized_desc FROM txn""")
def _(spark, sf):
    """With two attempts the third never comes, so the basic normalization stands in."""
    rows = txn_events(spark, sf).drop("normalized_desc")
    rows, _ = en.enrich(rows, FailsFirst(), en.empty_cache(spark), attempts=2, wait=(0.0, 0.0))
    return rows.select("txn_id", "normalized_desc")


def cheap_model(rows: pd.DataFrame) -> list[str]:
    """Knows purchases and views, is unsure about clicks, and fails the rest."""
    out = []
    for text in rows["description"]:
        kind = text.split(" ")[0]
        if kind in ("purchase", "view"):
            out.append("Sure: " + json.dumps({"category": kind.title(), "confidence": 0.85, "reasoning": "seen"}))
        elif kind == "click":
            out.append(json.dumps({"category": "Web", "confidence": 0.75, "reasoning": "maybe"}))
        elif kind == "signup":
            out.append("no idea")
        else:
            out.append(json.dumps({"category": "Uncategorized", "confidence": 0.3, "reasoning": "odd"}))
    return out


EXAMPLES = {"Food": ["corner bakery $4.20"], "Travel": ["night train $61.00"]}


def strong_model(rows: pd.DataFrame) -> list[str]:
    return [json.dumps({"category": "Fault", "confidence": 0.9, "reasoning": "an error"}) for _ in range(len(rows))]


MODELLED = """
model AS (
  SELECT txn_id, source,
    CASE source WHEN 'purchase' THEN 'Purchase' WHEN 'view' THEN 'View' WHEN 'click' THEN 'Uncategorized'
                WHEN 'signup' THEN 'Uncategorized' ELSE 'Fault' END AS category,
    CASE source WHEN 'purchase' THEN 0.85::DOUBLE WHEN 'view' THEN 0.85::DOUBLE WHEN 'click' THEN 0.75::DOUBLE
                WHEN 'signup' THEN 0.0::DOUBLE ELSE 0.9::DOUBLE END AS confidence,
    CASE source WHEN 'purchase' THEN 'seen' WHEN 'view' THEN 'seen'
      WHEN 'click' THEN 'Low confidence (0.75) for ''Web''. Original reasoning: maybe'
      WHEN 'signup' THEN 'Low confidence (0.00) for ''Uncategorized''. Original reasoning: Failed to parse LLM response: no idea'
      ELSE 'an error' END AS reasoning
  FROM txn)"""


@query("classify", f"""
WITH {TXN}, {MODELLED} SELECT txn_id, category, confidence, reasoning, 'model' AS match_type FROM model""")
def _(spark, sf):
    return categorize(txn_events(spark, sf), model=Model(cheap_model, strong_model)).select(*RESULT)


@query("categorize_with_model", f"""
WITH {TXN}, {CASCADE}, {MODELLED}
SELECT c.txn_id, CASE WHEN c.match_type IS NULL THEN m.category ELSE c.category END AS category,
  CASE WHEN c.match_type IS NULL THEN m.confidence ELSE c.confidence END AS confidence,
  CASE WHEN c.match_type IS NULL THEN m.reasoning ELSE c.reasoning END AS reasoning,
  coalesce(c.match_type, 'model') AS match_type
FROM cascade c JOIN model m USING (txn_id)""")
def _(spark, sf):
    df = categorize(
        txn_events(spark, sf), event_rules(spark), fixture_keywords(spark),
        model=Model(cheap_model, strong_model, static_examples(spark, EXAMPLES)), matcher="edit",
    )
    return df.select(*RESULT)


ASKED = f"""
asked AS (
  SELECT DISTINCT t.date, t.description, t.normalized_desc, t.amount, t.source
  FROM txn t JOIN cascade c USING (txn_id) WHERE c.match_type IS NULL),
question AS (
  SELECT source, length('Categorize this transaction into one of: {", ".join(CATEGORIES)}, Uncategorized.' || chr(10)
    || 'Examples:' || chr(10) || '- corner bakery $4.20 → Food' || chr(10) || '- night train $61.00 → Travel' || chr(10)
    || 'Transaction:' || chr(10) || '- Date: ' || strftime(date, '%m/%d/%Y') || chr(10) || '- Description: ' || description || chr(10)
    || '- Normalized: ' || normalized_desc || chr(10) || '- Amount: ' || printf('%.2f', amount) || chr(10)
    || '- Source: ' || source || chr(10) || '{en.GUIDANCE}') AS n FROM asked),
answer AS (
  SELECT n, length(CASE source
    WHEN 'purchase' THEN 'Sure: {{"category": "Purchase", "confidence": 0.85, "reasoning": "seen"}}'
    WHEN 'view' THEN 'Sure: {{"category": "View", "confidence": 0.85, "reasoning": "seen"}}'
    WHEN 'click' THEN '{{"category": "Web", "confidence": 0.75, "reasoning": "maybe"}}'
    WHEN 'signup' THEN 'no idea'
    ELSE '{{"category": "Uncategorized", "confidence": 0.3, "reasoning": "odd"}}' END) AS r, 'gpt-3.5' AS family, 0.000001::DOUBLE AS price
  FROM question
  UNION ALL
  SELECT n, length('{{"category": "Fault", "confidence": 0.9, "reasoning": "an error"}}'), 'gpt-4', 0.00001::DOUBLE
  FROM question WHERE source = 'error')"""


@query("usage_of_model_calls", f"""
WITH {TXN}, {CASCADE}, {ASKED}
SELECT family, 'categorization' AS purpose, count(*) AS calls, CAST(sum(n) AS BIGINT) AS prompt_chars,
  CAST(sum(r) AS BIGINT) AS response_chars, round(sum(n / 3.0::DOUBLE + r / 2.0::DOUBLE), 2) AS tokens,
  round(sum((n / 3.0::DOUBLE + r / 2.0::DOUBLE) * price), 8) AS cost
FROM answer GROUP BY family""")
def _(spark, sf):
    """What a run of ``categorize_with_model`` wrote into the log of its calls."""
    log = scratch_path(spark, "calls")
    model = Model(
        cheap_model, strong_model, static_examples(spark, EXAMPLES), {"log": log}, ("gpt-3.5-turbo", "gpt-4o")
    )
    done = categorize(txn_events(spark, sf), event_rules(spark), fixture_keywords(spark), model=model, matcher="edit")
    materialize(done.groupBy("match_type").count())
    return usage_report(load_call_log(spark, log))


def judge(rows: pd.DataFrame) -> list[str]:
    """Calls views different; errors get a reply that does not parse."""
    out = []
    for text in rows["records"]:
        if "view" in text:
            out.append('```json\n{"is_duplicate": false, "reasoning": "two visits"}\n```')
        elif "error" in text:
            out.append("cannot say")
        else:
            out.append('{"is_duplicate": true, "reasoning": "same charge"}')
    return out


FALLBACK = "Kept as primary. Fallback: JSON parsing error, assuming duplicate based on exact date/amount/description match"


@query("dedupe_with_judge", f"""
WITH {DUP}, {JUDGED.replace("Kept as primary (fallback to basic deduplication due to error)", FALLBACK)}
SELECT txn_id, date, amount, description, is_duplicate, dedupe_reasoning FROM verdict WHERE rn = 1 OR source = 'view'""")
def _(spark, sf):
    return dedupe(dup_events(spark, sf), "adjudicated", judge).select(*SHOWN)


@query("dedupe_with_judge_in_parts", f"""
WITH {DUP}, {JUDGED.replace("Kept as primary (fallback to basic deduplication due to error)", FALLBACK)}
SELECT txn_id, date, amount, description, is_duplicate, dedupe_reasoning FROM verdict WHERE rn = 1 OR source = 'view'""")
def _(spark, sf):
    """Groups above two members are judged in parts; the outcome is the same."""
    df = dup_events(spark, sf)
    verdicts = en.adjudicate(duplicate_groups(df, members_per_part=2), judge)
    return dedupe_adjudicated(df, verdicts).select(*SHOWN)


class StreamedJudge(en.GroupJudge):
    """The same verdicts from the members of a group, frame by frame."""

    def __init__(self):
        self.kinds = set()

    def add(self, members):
        self.kinds |= {text.split(" ")[0] for text in members["description"]}

    def reply(self):
        if "view" in self.kinds:
            return '{"is_duplicate": false, "reasoning": "two visits"}'
        return "cannot say" if "error" in self.kinds else '{"is_duplicate": true, "reasoning": "same charge"}'


@query("dedupe_with_streamed_judge", f"""
WITH {DUP}, {JUDGED.replace("Kept as primary (fallback to basic deduplication due to error)", FALLBACK)}
SELECT txn_id, date, amount, description, is_duplicate, dedupe_reasoning FROM verdict WHERE rn = 1 OR source = 'view'""")
def _(spark, sf):
    return dedupe(dup_events(spark, sf), "adjudicated", StreamedJudge).select(*SHOWN)


@query("build_prompt", f"""
WITH {TXN}
SELECT txn_id, md5('Categorize this transaction into one of: {", ".join(CATEGORIES)}, Uncategorized.' || chr(10)
  || 'Examples:' || chr(10) || '- tea $1.00 → Food' || chr(10) || '- bus $2.00 → Travel' || chr(10)
  || 'Transaction:' || chr(10) || '- Date: ' || strftime(date, '%m/%d/%Y') || chr(10) || '- Description: ' || description || chr(10)
  || '- Normalized: ' || normalized_desc || chr(10) || '- Amount: ' || printf('%.2f', amount) || chr(10)
  || '- Source: ' || source || chr(10) || '{en.GUIDANCE}') AS digest
FROM txn""")
def _(spark, sf):
    examples = static_examples(spark, {"Food": ["tea $1.00"], "Travel": ["bus $2.00"]})
    return en.build_prompt(txn_events(spark, sf), examples).select("txn_id", F.md5("prompt").alias("digest"))
