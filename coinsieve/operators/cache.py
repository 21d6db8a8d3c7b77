"""Result caches as tables: lookup, misses, resume, updates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinsieve.functions.review import REVIEW_REASON
from coinsieve.functions.text import percent
from coinsieve.operators.rows import with_txn_key
from coinsieve.operators.skew import skew_join, unmatched

RESTORED = ["category", "confidence", "reasoning", "normalized_desc"]


def lookup_cache(df: DataFrame, cache: DataFrame, key: str, row_id: str = "txn_id") -> DataFrame:
    """Add ``cached``: the result stored under the row's key, NULL on a miss."""
    stored = cache.select(F.col("key").alias(key), F.col("result").alias("cached"))
    return skew_join(df, stored, key, row_id, "left")


def cache_misses(df: DataFrame, cache: DataFrame, key: str, *also: str) -> DataFrame:
    """Each key the cache lacks, once, with the first value of ``also``."""
    wanted = df.groupBy(key).agg(*[F.min(c).alias(c) for c in also]) if also else df.select(key).distinct()
    return unmatched(wanted, cache.select(F.col("key").alias(key)), key)


def add_entries(cache: DataFrame, new: DataFrame) -> DataFrame:
    """Cache with new entries; the newer entry of a key stays."""
    kept = cache.join(new.select("key"), "key", "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def count_hits(df: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Cache with ``hits`` raised by the lookups of a table."""
    used = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("_n"))
    return (
        cache.join(used, "key", "left")
        .withColumn("hits", F.coalesce("hits", F.lit(0)) + F.coalesce("_n", F.lit(0)))
        .drop("_n")
    )


def cache_stats(df: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Entries, hits, misses and hit rate of looking a table's rows up."""
    used = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    found = used.join(cache.select("key", F.lit(True).alias("known")), "key", "left")
    entries = cache.agg(F.count(F.lit(1)).alias("n")).scalar()
    hits = F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return found.agg(
        hits.alias("hits"), (total - hits).alias("misses"), percent(hits, total).alias("hit_rate")
    ).select(entries.alias("entries"), "hits", "misses", "hit_rate")


def first_saved(saved: DataFrame) -> DataFrame:
    """First saved row per transaction key; order is ``seq``."""
    keyed = with_txn_key(saved)
    return (
        keyed.groupBy("txn_key")
        .agg(F.min_by(F.struct(*RESTORED), "seq").alias("saved"))
        .filter("txn_key IS NOT NULL")
    )


def mark_processed(df: DataFrame, saved: DataFrame) -> DataFrame:
    """Rows whose key occurs among the saved ones."""
    keys = with_txn_key(saved).select("txn_key").distinct()
    return skew_join(with_txn_key(df), keys, "txn_key", "txn_id", "left_semi")


def resume_from(df: DataFrame, saved: DataFrame) -> DataFrame:
    """Restore saved results; rows without one stay as they are."""
    joined = skew_join(with_txn_key(df), first_saved(saved), "txn_key", "txn_id", "left")
    present = {f.name for f in df.schema.fields}
    types = dict(saved.dtypes)
    current = {c: F.col(c) if c in present else F.lit(None).cast(types[c]) for c in RESTORED}
    done = F.col("saved").isNotNull()
    return joined.withColumns(
        {"is_processed": done}
        | {
            c: F.when(done, F.col(f"saved.{c}")).otherwise(current[c])
            for c in RESTORED
        }
    ).drop("saved")


def update_from(df: DataFrame, updates: DataFrame, key: str = "txn_id") -> DataFrame:
    """Overwrite columns with the non-NULL values of a table with one row per
    key. The key identifies a row, so no key can be hot."""
    changed = [c for c in updates.columns if c != key]
    new = updates.withColumnsRenamed({c: f"_new_{c}" for c in changed})
    joined = df.join(new, key, "left")
    return joined.select(
        *[
            F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in changed else F.col(c)
            for c in df.columns
        ]
    )


def latest_corrections(corrections: DataFrame, key: str = "txn_id", order: str = "correction_ord") -> DataFrame:
    return corrections.groupBy(key).agg(F.max_by("new_category", order).alias("new_category"))


def apply_corrections(df: DataFrame, corrections: DataFrame, key: str = "txn_id") -> DataFrame:
    """Set the corrected category with full confidence; the last one counts."""
    joined = df.join(latest_corrections(corrections, key), key, "left")
    changed = F.col("new_category").isNotNull()
    return joined.withColumns(
        {
            "category": F.coalesce("new_category", "category"),
            "confidence": F.when(changed, F.lit(1.0)).otherwise(F.col("confidence")),
            "reasoning": F.when(changed, F.lit(REVIEW_REASON)).otherwise(F.col("reasoning")),
        }
    ).select(*df.columns)
