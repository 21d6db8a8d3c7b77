"""Categorization cascade: cache, rules, keywords, model, confidence gate."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinsieve.functions.keys import full_key, keywords_fingerprint, rules_fingerprint
from coinsieve.functions.similarity import THRESHOLD
from coinsieve.operators.cache import lookup_cache, update_from
from coinsieve.operators.enrich import MODEL, RowReply, build_prompt, classify
from coinsieve.operators.match import match_keywords, match_rules
from coinsieve.operators.rows import (
    REVIEW_BELOW, confidence_gate, ensure_columns, is_uncategorized, pending, reset_uncategorized,
)
from coinsieve.operators.skew import attach
from coinsieve.schema import ENRICHMENT, UNCATEGORIZED
from coinsieve.session import materialize

NO_MATCH = "No rule matched"
RESULT = ["category", "confidence", "reasoning", "match_type"]


@dataclass
class Model:
    """A batch function for rows that no rule decides, and how to call it.

    ``names`` are those of the two models in the log of calls; ``calls`` may name the ``log``.
    """

    primary: RowReply
    escalate: RowReply | None = None
    examples: DataFrame | None = None
    calls: dict = field(default_factory=dict)
    names: tuple[str, str] = (MODEL, MODEL)


def cache_key(df: DataFrame, rules: DataFrame | None, keywords: DataFrame | None = None) -> DataFrame:
    """Add ``cache_key``: row content plus a digest of the lists in force, so a
    result of other rules or keywords is not found."""
    digest = [F.lit("")]
    if rules is not None:
        digest.append(rules_fingerprint(rules).scalar())
    if keywords is not None:
        digest.append(keywords_fingerprint(keywords).scalar())
    row = [
        F.col("description"), F.round("amount", 2).cast("decimal(18,2)"), F.col("date"),
        F.col("source"), F.col("normalized_desc"),
    ]
    return df.withColumn("cache_key", full_key(row, F.concat_ws(":", *digest)))


def categorize(
    txns: DataFrame,
    rules: DataFrame | None = None,
    keywords: DataFrame | None = None,
    cache: DataFrame | None = None,
    model: Model | None = None,
    threshold: int = THRESHOLD,
    matcher: str = "ratio",
    gate: float = REVIEW_BELOW,
    raw_label: bool = False,
) -> DataFrame:
    """Add category, confidence, reasoning and match_type to every row.

    The first stage that decides a row wins: cached result, first rule, first
    keyword category, model. Model results, cached ones too, pass the gate.
    ``model=None`` leaves the remaining rows uncategorized.
    """
    df = txns.drop(*RESULT)
    stages = []
    if cache is not None:
        df = lookup_cache(cache_key(df, rules, keywords), cache.select(
            "key",
            F.struct(
                "result.category", "result.confidence", "result.reasoning",
                F.coalesce("match_type", F.lit("model")).alias("match_type"),
            ).alias("result"),
        ), "cache_key").drop("cache_key")
        stages.append("cached")
    if rules is not None:
        df = match_rules(df, rules, threshold, matcher, raw_label, undecided=_none_of(stages))
        stages.append("rule_match")
    if keywords is not None:
        df = match_keywords(df, keywords, threshold, matcher, undecided=_none_of(stages))
        stages.append("keyword_match")
    undecided = F.struct(
        F.lit(UNCATEGORIZED).alias("category"), F.lit(0.0).alias("confidence"),
        F.lit(NO_MATCH).alias("reasoning"), F.lit(None).cast("string").alias("match_type"),
    )
    decided = F.coalesce(*[F.col(s) for s in stages]) if stages else F.lit(None).cast(
        "struct<category:string,confidence:double,reasoning:string,match_type:string>"
    )
    kept = [c for c in df.columns if c not in stages]
    if model is None:
        rows = df.select(*kept, F.coalesce(decided, undecided).alias("_r"))
    else:
        rows = _ask_rest(df.select(*kept, decided.alias("_r")), model)
    flat = rows.select(*kept, *[F.col(f"_r.{c}").alias(c) for c in RESULT])
    return confidence_gate(flat, gate, F.col("match_type") == "model")


def _none_of(stages: list[str]) -> Column | None:
    """Rows that no earlier stage decided."""
    return F.coalesce(*[F.col(s) for s in stages]).isNull() if stages else None


def _ask_rest(df: DataFrame, model: Model) -> DataFrame:
    """Ask the model once per distinct undecided transaction.

    Only the undecided rows are checkpointed and joined with the answers; rows
    that a rule decided pass through.
    """
    parts = ["date", "description", "normalized_desc", "amount", "source"]
    rest = materialize(
        df.filter("_r IS NULL").withColumn("ask_key", F.md5(F.to_json(F.struct(*parts))))
    )
    asked = rest.select("ask_key", *parts).distinct()
    answers = classify(
        build_prompt(asked, model.examples), model.primary, model.escalate, "ask_key", models=model.names, **model.calls
    ).select(
        "ask_key",
        F.struct(
            "category", "confidence", "reasoning", F.lit("model").alias("match_type")
        ).alias("_answer"),
    )
    answered = attach(rest.drop("_r"), answers, "ask_key", "txn_id")
    decided = df.filter("_r IS NOT NULL")
    return decided.unionByName(
        answered.withColumnRenamed("_answer", "_r").drop("ask_key"), allowMissingColumns=True
    )


def cache_entries(
    categorized: DataFrame, rules: DataFrame | None, keywords: DataFrame | None = None
) -> DataFrame:
    """Cache rows for results; equal transactions share one entry."""
    by_rule = F.col("match_type").isin("exact", "fuzzy")
    first = cache_key(categorized, rules, keywords).groupBy(F.col("cache_key").alias("key")).agg(
        F.min_by(F.struct(*RESULT), "seq").alias("r"), F.count(F.lit(1)).alias("hits")
    )
    return first.select("key", F.lit("full").alias("key_kind"), "r.*", "hits").select(
        "key", "key_kind", F.struct("category", "confidence", "reasoning").alias("result"),
        F.current_timestamp().alias("ts"), "hits", by_rule.alias("rule_based"), "match_type",
        F.lit(None).cast("string").alias("error"),
    )


def recategorize(df: DataFrame, rules: DataFrame, keywords: DataFrame | None = None, **options) -> DataFrame:
    """Try the uncategorized rows again, now with other rules.

    Rows that stay undecided come back uncategorized; other rows are untouched.
    """
    full = ensure_columns(df, ENRICHMENT)
    redo = pending(reset_uncategorized(full.filter(is_uncategorized())))
    results = categorize(redo, rules, keywords, **options)
    return update_from(full, results.select("txn_id", *RESULT))
