"""URL filtering by listed rules and by mined association rules.

A listed rule (host, path, verdict) fits its host and all subdomains where the URL's
path starts with the rule's; the longest rule wins. URLs that a listed rule decides are
labelled by it. FP-growth mines, over their tokens (host labels, path words, query names),
which combinations go with one verdict; rules with too little confidence or support go,
and so do rules that a shorter one covers. The others get the verdict of the strongest
mined rule whose tokens they all have, found through an inverted index: each rule is
listed under its rarest token only. Where no mined rule fits, the verdict is ``default``.

Tokens that the labelled URLs have only together (the words of a path that many share)
are one token while mining: their combinations, of which there are twice as many with
each, say the same. A URL has that token if it has any of them. Rules are neither cut by number nor by length.

Everything is DataFrame and SQL functions and Spark's own FP-growth.

Cases: a URL that is null or has no ``://`` has an empty host and path; no listed rule fits
it and it has no tokens. Repeated rows each come back. With no labelled URL, or only one
verdict among them, nothing is mined. Other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinsieve.llm.storage import stored
from coinsieve.operators.skew import attach

RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
LEAST_SUPPORT = 0.01
LEAST_CONFIDENCE = 0.8
LABEL = "verdict="


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parse(url: Column) -> dict[str, Column]:
    """host and path of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return {
        "host": lower_ascii(F.regexp_extract(rest, "^([^/?#]*)", 1)),
        "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1),
    }


def listed_rule(host: Column, path: Column, rules: tuple) -> Column:
    """The longest fitting rule as a struct (size, rule, verdict), null if none fits.

    The list is part of the plan: it is written by hand and short.
    """
    fitting = []
    for rule_host, rule_path, verdict in rules:
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path) & (host != "")
        name = rule_host + rule_path
        fitting.append(F.when(fits, F.struct(F.lit(len(name)).alias("size"), F.lit(name).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.greatest(*fitting, F.lit(None).cast("struct<size:int,rule:string,verdict:string>"))


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens of a URL, sorted."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host:"), x))
    words = F.transform(
        F.split(F.regexp_replace(F.lower(path), r"\d+", "0"), r"[^\p{L}0]+"), lambda x: F.concat(F.lit("path:"), x)
    )
    names = F.transform(F.regexp_extract_all(F.coalesce(url, F.lit("")), F.lit("[?&]([^=&#]+)=")), lambda x: F.concat(F.lit("query:"), F.lower(x)))
    both = F.concat(labels, words, names)
    return F.array_sort(F.array_distinct(F.filter(both, lambda x: ~x.isin("host:", "path:", "path:0"))))


def token_classes(labelled: DataFrame) -> DataFrame:
    """(token, name): tokens that are in the same labelled URLs, with the smallest of them; only
    where that is another one."""
    row = F.monotonically_increasing_id()
    rows = stored(labelled.select("tokens", row.alias("row")), "labelled")
    seen = rows.select(F.explode("tokens").alias("token"), *[F.xxhash64(F.lit(salt), "row").cast("decimal(38,0)").alias(f"h{salt}") for salt in (1, 2)])
    # Two sums of 64-bit hashes tell sets of URLs apart.
    sets = seen.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2"))
    names = sets.groupBy("n", "h1", "h2").agg(F.min("token").alias("name"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    return stored(sets.join(names, ["n", "h1", "h2"]).filter("token <> name").select("token", "name"), "classes")


def renamed(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(tokens, named) for the distinct ``tokens`` of ``rows``: each token by its class."""
    known = rows.select("tokens").distinct().withColumn("token", F.explode("tokens"))
    named = attach(known, classes, "token", "tokens").withColumn("token", F.coalesce("name", "token"))
    return named.groupBy("tokens").agg(F.array_sort(F.collect_set("token")).alias("named"))


def mined_rules(labelled: DataFrame) -> DataFrame:
    """(key_token, needs, mined, confidence, support): from (tokens, verdict) rows."""
    labelled = labelled.filter(F.size("tokens") > 0)
    baskets = labelled.select(F.array_append("tokens", F.concat(F.lit(LABEL), F.col("verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=LEAST_SUPPORT, minConfidence=LEAST_CONFIDENCE).fit(baskets)
    found = model.associationRules.filter(
        F.col("consequent")[0].startswith(LABEL) & ~F.exists("antecedent", lambda x: x.startswith(LABEL))
    ).select(
        F.array_sort("antecedent").alias("needs"),
        F.substr(F.col("consequent")[0], F.lit(len(LABEL) + 1)).alias("mined"), "confidence", "support",
    )
    common = labelled.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    pieces = found.withColumn("token", F.explode("needs")).join(common, "token")
    keyed = pieces.groupBy("needs", "mined", "confidence", "support").agg(F.min_by("token", F.struct("n", "token")).alias("key_token"))
    found = stored(keyed, "mined")
    # A rule goes if one of its parts is a rule with the same verdict and no less confidence.
    shorter = found.select(F.col("key_token").alias("one"), F.col("needs").alias("part"), F.col("mined").alias("m"), F.col("confidence").alias("c"))
    covered = (
        found.withColumn("one", F.explode("needs")).join(shorter, "one")
        .filter("m = mined AND c >= confidence AND size(part) < size(needs)")
        .filter(F.size(F.array_except("part", "needs")) == 0)
        .select("needs", "mined")
        .distinct()
    )
    return found.join(covered, ["needs", "mined"], "left_anti")


def judge_urls(pages: DataFrame, rules: tuple = RULES, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every row."""
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"))
    rows = rows.withColumns(parse(F.col("url")))
    rows = rows.withColumn("listed", listed_rule(F.col("host"), F.col("path"), rules)).withColumn(
        "tokens", tokens(F.col("host"), F.col("path"), F.col("url"))
    )
    labelled = rows.filter("listed IS NOT NULL").select("tokens", F.col("listed.verdict").alias("verdict"))
    open_tokens = rows.filter("listed IS NULL AND size(tokens) > 0").select("tokens").distinct()
    ends = labelled.agg(F.min("verdict").alias("a"), F.max("verdict").alias("b")).first()
    if ends.a != ends.b:
        labelled = stored(labelled.filter(F.size("tokens") > 0), "decided")
        classes = token_classes(labelled)
        by_class = labelled.join(renamed(labelled, classes), "tokens").select(F.col("named").alias("tokens"), "verdict")
        index = stored(mined_rules(by_class), "index")
        asked = renamed(open_tokens, classes).withColumn("key_token", F.explode("named"))
        # The index is broadcast where its measured size allows.
        hits = (
            attach(asked, index, "key_token", "tokens", "inner")
            .filter(F.size(F.array_except("needs", "named")) == 0)
            .groupBy("tokens")
            .agg(F.max_by("mined", F.struct("confidence", F.size("needs"), "support", "needs", "mined")).alias("mined"))
        )
        rows = rows.join(hits, "tokens", "left")
    else:
        rows = rows.withColumn("mined", F.lit(None).cast("string"))
    return rows.select(
        "page_id", "host", "path", F.col("listed.rule").alias("rule"),
        F.coalesce("listed.verdict", "mined", F.lit(default)).alias("verdict"),
    )
