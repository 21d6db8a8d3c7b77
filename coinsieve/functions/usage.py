"""Token, cost and purpose estimates for model calls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters per token and price per token by model family.
PROMPT_CHARS_PER_TOKEN = 3
RESPONSE_CHARS_PER_TOKEN = 2
PRICE = {"gpt-4": 0.00001, "gpt-3.5": 0.000001}


def token_estimate(prompt_chars: Column, response_chars: Column) -> Column:
    return prompt_chars / PROMPT_CHARS_PER_TOKEN + response_chars / RESPONSE_CHARS_PER_TOKEN


def model_family(model: Column) -> Column:
    return F.when(F.contains(model, F.lit("gpt-4")), "gpt-4").when(
        F.contains(model, F.lit("gpt-3.5")), "gpt-3.5"
    )


def cost_estimate(model: Column, tokens: Column) -> Column:
    family = model_family(model)
    return (
        F.when(family == "gpt-4", tokens * PRICE["gpt-4"])
        .when(family == "gpt-3.5", tokens * PRICE["gpt-3.5"])
        .otherwise(F.lit(0.0))
    )


def purpose(context: Column) -> Column:
    """First marker found in the call context, in this order."""
    return (
        F.when(F.contains(context, F.lit("norm")), "normalization")
        .when(F.contains(context, F.lit("txn:")), "categorization")
        .when(F.contains(context, F.lit("rule")), "rule_generation")
        .when(F.contains(context, F.lit("dedupe")), "deduplication")
        .otherwise("other")
    )


def route_model(model: Column, context: Column, cheap: str = "gpt-3.5-turbo") -> Column:
    """Batch normalization goes from the strong model to the cheap one."""
    down = F.contains(F.coalesce(context, F.lit("")), F.lit("norm_batch")) & (model == "gpt-4o")
    return F.when(down, F.lit(cheap)).otherwise(model)
