"""The final report as one long table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinsieve.operators.aggregate import (
    category_distribution, confidence_summary, match_type_stats, usage_report,
)
from coinsieve.operators.cache import cache_stats
from coinsieve.operators.dedupe import dedupe_summary


def _long(section: str, df: DataFrame, columns: list[str], label: Column | None = None) -> DataFrame:
    """Unpivot columns into (section, metric, value)."""
    name = (lambda c: F.concat(label, F.lit(f".{c}"))) if label is not None else F.lit
    pairs = F.array(
        *[F.struct(name(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return df.select(F.lit(section).alias("section"), F.explode(pairs).alias("p")).select(
        "section", "p.metric", "p.value"
    )


def summary(
    before: DataFrame,
    after: DataFrame,
    cache: DataFrame | None = None,
    cache_key: str | None = None,
    call_log: DataFrame | None = None,
) -> DataFrame:
    """(section, metric, value) over transactions, categories, confidence,
    methods, and caches and model usage where given."""
    parts = [
        _long("transactions", dedupe_summary(before, after),
              ["groups", "rows_before", "rows_after", "removed", "false_positives"]),
        _long("categories", category_distribution(after), ["n", "pct"], F.col("category")),
        _long("confidence", confidence_summary(after), ["avg_confidence", "low_n", "low_pct"]),
        _long("methods", match_type_stats(before),
              ["exact_n", "fuzzy_n", "model_n", "exact_pct", "fuzzy_pct", "model_pct",
               "fuzzy_of_rules_pct", "estimated_saving"]),
    ]
    if cache is not None and cache_key is not None:
        parts.append(
            _long("cache", cache_stats(before, cache, cache_key), ["entries", "hits", "misses", "hit_rate"])
        )
    if call_log is not None:
        parts.append(
            _long("usage", usage_report(call_log), ["calls", "tokens", "cost"],
                  F.concat_ws(".", "family", "purpose"))
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
