"""Writers. Reports and caches are published as versions: a run that fails while it
writes leaves the earlier result as it was."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinsieve.functions.parsing import format_date
from coinsieve.schema import FINAL_COLUMNS
from coinsieve.sources.published import publish


def final_columns(df: DataFrame) -> DataFrame:
    """The eleven report columns in their fixed order."""
    columns: dict[str, Column] = {
        "Date": format_date(F.col("date")),
        "Description": F.col("description"),
        "NormalizedDesc": F.col("normalized_desc"),
        "Amount": F.col("amount"),
        "Source": F.col("source"),
        "File": F.col("file"),
        "Category": F.col("category"),
        "Confidence": F.col("confidence"),
        "Reasoning": F.col("reasoning"),
        "IsDuplicate": F.col("is_duplicate"),
        "DedupeReasoning": F.col("dedupe_reasoning"),
    }
    return df.select(*[columns[name].alias(name) for name in FINAL_COLUMNS])


def _csv(df: DataFrame, path: str) -> None:
    # Every line repeats a file's path and a few texts: plain, the reports are most of what a run leaves.
    publish(df.sparkSession, path, df.write.options(header=True, escape='"', compression="gzip").csv)


def write_combined(df: DataFrame, path: str) -> None:
    """All transactions with whatever flat columns they have."""
    _csv(df.withColumn("date", format_date(F.col("date"))), path)


def write_deduped(df: DataFrame, path: str) -> None:
    _csv(final_columns(df), path)


def write_rules(rules: DataFrame, path: str, form: str = "lines") -> None:
    """Rules with their order, as JSON lines or as one ``{"rules": [...]}``.

    The document is one file, so its rows go through one task one after another,
    between a first and a last line; nothing gathers them in memory.
    """
    fields = ["description", "amount", "day_range", "category"]
    if form == "lines":
        rules.select("rule_ord", *fields).write.mode("overwrite").option("ignoreNullFields", False).json(path)
        return
    first = rules.agg(F.min("rule_ord").alias("n")).first().n
    rule = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    comma = F.when(F.col("rule_ord") == first, F.lit("")).otherwise(F.lit(","))
    lines = rules.select(F.lit(1).alias("part"), "rule_ord", F.concat(comma, rule).alias("value"))
    ends = rules.sparkSession.createDataFrame([(0, None, '{"rules": ['), (2, None, "]}")], lines.schema)
    ordered = lines.unionByName(ends).orderBy("part", "rule_ord").coalesce(1)
    ordered.select("value").write.mode("overwrite").text(path)


def write_cache(cache: DataFrame, path: str) -> None:
    cache.write.mode("overwrite").parquet(path)


def write_version(cache: DataFrame, path: str) -> None:
    """A cache as its next version beside the older ones, which may be being read."""
    publish(cache.sparkSession, path, cache.write.parquet)
