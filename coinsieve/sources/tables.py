"""Rules, keywords, caches, prior results and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinsieve.schema import CALL_LOG, KEYWORD, RULE
from coinsieve.session import path_exists
from coinsieve.sources.published import current

RULES_DOCUMENT = (
    "rules array<struct<description:string,amount:double,day_range:array<int>,category:string>>"
)

# A small rule set to start from.
STARTER_RULES = [
    ("zelle ", None, [1, 5], "Rent"),
    ("venmo", None, [1, 31], "Food"),
    ("paypal", None, [1, 31], "Shopping"),
    ("cash app", None, [1, 31], "Entertainment"),
]

# Columns a saved result needs before it is trusted.
RESUME_COLUMNS = ["Date", "Description", "NormalizedDesc", "Amount", "Category", "Confidence"]
DEDUPED_COLUMNS = ["Date", "Description", "Amount", "Category", "IsDuplicate"]


def rules_table(spark: SparkSession, rules: list[tuple]) -> DataFrame:
    """Rules from (description, amount, day_range, category), in list order."""
    return spark.createDataFrame([(i, *rule) for i, rule in enumerate(rules)], RULE)


def starter_rules(spark: SparkSession) -> DataFrame:
    return rules_table(spark, STARTER_RULES)


def load_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules of a ``{"rules": [...]}`` document or of JSON lines written by
    ``write_rules``; empty when there is no such file."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], RULE)
    head = spark.read.text(path).limit(1)
    if head.filter(F.contains("value", F.lit('"rule_ord"'))).isEmpty():
        return (
            spark.read.schema(RULES_DOCUMENT).option("multiLine", True).json(path)
            .select(F.posexplode("rules").alias("rule_ord", "r"))
            .select(F.col("rule_ord").cast("bigint").alias("rule_ord"), "r.*")
        )
    return spark.read.schema(RULE).json(path)


def keyword_table(spark: SparkSession, keywords: dict[str, list[str]]) -> DataFrame:
    """Ordered keyword rules from a category -> keywords mapping."""
    rows = [
        (c, category, k, word)
        for c, (category, words) in enumerate(keywords.items())
        for k, word in enumerate(words)
    ]
    return spark.createDataFrame(rows, KEYWORD)


def builtin_keywords(spark: SparkSession, path: str) -> DataFrame:
    """The keyword table from a JSON file ``{"Category": ["keyword", ...]}``.

    Order of categories and of keywords is kept: both decide which one wins.
    The table is a parameter because it has more entries than code should hold.
    """
    listed = spark.read.text(path, wholetext=True).select(
        F.posexplode(F.from_json("value", "map<string,array<string>>")).alias("cat_ord", "category", "words")
    )
    return listed.select(
        "cat_ord", "category", F.posexplode("words").alias("kw_ord", "keyword")
    ).select("cat_ord", "category", "kw_ord", "keyword")


def load_cache(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Cache table, empty when it is missing."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def load_call_log(spark: SparkSession, path: str) -> DataFrame:
    """The calls that were noted at a path, for ``usage_report``; empty when there were none."""
    return load_cache(spark, path, CALL_LOG)


def latest_cache(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The newest complete version of a versioned cache, empty when there is none."""
    return load_cache(spark, current(spark, path) or f"{path}/none", schema)


def load_prior(spark: SparkSession, path: str, required: list[str] | None = None) -> DataFrame | None:
    """Earlier CSV result, or None when it is missing or lacks a needed column.

    Of a published one the current version is read; else the path itself.
    """
    if not path_exists(spark, path):
        return None
    saved = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(current(spark, path) or path)
    return saved if set(required or RESUME_COLUMNS) <= set(saved.columns) else None


# Shape of a log line: time - level - message.
LOG_LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}),\d{3} - ([A-Z]+) - (.*)$"


def parse_log(lines: DataFrame) -> DataFrame:
    """Add ts, level and message to ``value``; NULL on continuation lines."""
    part = [F.regexp_extract("value", LOG_LINE, i) for i in (1, 2, 3)]
    return lines.withColumns(
        {
            "ts": F.try_to_timestamp(part[0], F.lit("yyyy-MM-dd HH:mm:ss")),
            "level": F.when(part[1] != "", part[1]),
            "message": F.when(part[1] != "", part[2]),
        }
    )


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Log lines with their place in the file, so the last ones can be found."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"),
        "value",
    )
    return parse_log(lines)
