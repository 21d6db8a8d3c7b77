"""The whole batch: statements in, combined and deduplicated results out."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinsieve.functions.keys import description_key
from coinsieve.functions.parsing import parse_amount, parse_date
from coinsieve.operators.cache import add_entries, count_hits, resume_from
from coinsieve.operators.enrich import BatchReply, RowReply, empty_cache, enrich
from coinsieve.operators.rows import ensure_columns, is_uncategorized, normalized, pending
from coinsieve.operators.skew import attach, with_row_number
from coinsieve.plans.categorize import RESULT, Model, cache_entries, categorize
from coinsieve.plans.dedupe import dedupe
from coinsieve.schema import CATEGORIZE_CACHE, ENRICHMENT, NORMALIZE_CACHE
from coinsieve.session import materialize, release, shuffles_let_go
from coinsieve.sources.cells import statement_rows
from coinsieve.sources.manifest import scan_incremental
from coinsieve.sources.sinks import write_combined, write_deduped, write_version
from coinsieve.sources.statements import combine, csv_files, place, scan_statements, typed
from coinsieve.sources.tables import latest_cache


def run(
    spark: SparkSession,
    inputs: str,
    output: str,
    rules: DataFrame | None = None,
    keywords: DataFrame | None = None,
    normalizer: BatchReply | None = None,
    model: Model | None = None,
    judge: RowReply | None = None,
    prior: DataFrame | None = None,
    cells: DataFrame | None = None,
    matcher: str = "ratio",
    name_from_folder: bool = False,
    caches: str | None = None,
    store: str | None = None,
    **calls,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scan, clean, categorize, deduplicate and write.

    ``cells`` holds rows of extracted statement tables (see ``sources.cells``),
    which come after the scanned files. ``caches`` names a folder that keeps what was
    normalized and categorized: a later run asks and matches for new texts and
    transactions only, and leaves a new version of both caches. ``store`` names a folder that
    keeps the rows of scanned files: a later run reads new and changed files only. A ``log``
    among ``calls`` takes a row per call of any function. Publishes ``<output>/combined`` and
    ``<output>/deduplicated``; returns all rows, the deduplicated rows and the rejected files.
    """
    with shuffles_let_go(spark):
        if store is None:
            scanned, rejected = scan_statements(spark, inputs, name_from_folder=name_from_folder)
            files = csv_files(spark, inputs)
        else:
            scanned, rejected, files = scan_incremental(spark, inputs, store, name_from_folder)
        if cells is not None:
            scanned, files = combine(scanned, _extracted(cells)), files.unionByName(cells.select("file"))
        # Every stage looks at the rows: they are parsed once.
        parsed = materialize(in_file_order(typed(scanned), files))
        if normalizer is None:
            txns = normalized(parsed)
        else:
            path = f"{caches}/normalize"
            cache = latest_cache(spark, path, NORMALIZE_CACHE) if caches else empty_cache(spark)
            asked = parsed
            txns, entries = enrich(asked, normalizer, cache, **calls)
            # So are the texts joined once, and one copy of the rows is there at a time.
            txns = parsed = materialize(txns)
            if caches:
                write_version(count_hits(asked.withColumn("_key", description_key(F.col("description"))), entries, "_key"), path)
            release(asked)
        txns = ensure_columns(txns, ENRICHMENT)
        if prior is not None:
            txns = resume_from(txns, prior).drop("txn_key", "is_processed")
        # Rows restored from an earlier run are not categorized again.
        open_rows = pending(txns)
        done = txns.filter("category IS NOT NULL AND confidence IS NOT NULL")
        path = f"{caches}/categorize"
        cache = latest_cache(spark, path, CATEGORIZE_CACHE) if caches else None
        if model is not None and "log" in calls:
            model = replace(model, calls={"log": calls["log"]} | model.calls)
        fresh = categorize(open_rows.drop(*RESULT), rules, keywords, cache, model=model, matcher=matcher)
        rows = materialize(done.withColumn("_fresh", F.lit(False)).unionByName(fresh.withColumn("_fresh", F.lit(True))))
        release(parsed)
        combined = rows.drop("_fresh")
        if caches:
            # Only decided rows are kept: the others may fare better with a model or another rule.
            settled = rows.filter("_fresh").drop("_fresh").filter(~is_uncategorized())
            write_version(add_entries(cache, cache_entries(settled, rules, keywords)), path)
        write_combined(combined, f"{output}/combined")
        kept = dedupe(combined, "adjudicated" if judge else "exact", judge, **(calls if judge else {}))
        write_deduped(kept, f"{output}/deduplicated")
    return combined.select("*"), kept.select("*"), rejected


def _extracted(cells: DataFrame) -> DataFrame:
    """Rows of extracted tables, numbered in the order page, table, row."""
    rows = statement_rows(cells)
    order = [F.col(c) for c in ("file", "page", "table_no", "row_no")]
    return with_row_number(rows, order, "line_no").select(
        "file", F.lit(0).cast("bigint").alias("block"), "line_no",
        "source", "raw_date", "description", parse_amount(F.col("raw_amount")).alias("amount"),
    )


# Places within one file: a file may have up to this many bytes.
FILE_PLACES = 1 << 42


def in_file_order(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Id and ``seq`` in the order file name, place in file, without sorting the rows.

    ``files`` lists all files, so only names are numbered. ``line_no`` counts the rows of a task
    in its low bits. A file's blocks begin as many bytes apart as a task reads at most, and a
    task has no more rows than bytes: the byte a block starts at plus that count is a
    place of its own, and the places are in order.
    """
    named = with_row_number(files.select("file").distinct(), [F.col("file")], "_file").withColumn("_place", place(F.col("file")))
    placed = attach(rows.withColumn("_place", place(F.col("file"))), materialize(named.select("_place", "_file")), "_place", ["file", "block", "line_no"], "inner")
    count = F.col("line_no").bitwiseAND(F.lit((1 << 33) - 1))
    seq = F.col("_file") * FILE_PLACES + F.col("block") + count
    return placed.withColumn("seq", seq).withColumn("txn_id", F.col("seq").cast("string")).drop("block", "line_no", "_place", "_file")


def prior_as_txns(saved: DataFrame) -> DataFrame:
    """A saved report CSV in the shape ``resume_from`` takes."""
    return saved.select(
        F.monotonically_increasing_id().alias("seq"),
        parse_date(F.col("Date")).alias("date"),
        F.col("Description").alias("description"),
        parse_amount(F.col("Amount")).alias("amount"),
        F.col("NormalizedDesc").alias("normalized_desc"),
        F.col("Category").alias("category"),
        F.col("Confidence").try_cast("double").alias("confidence"),
        F.col("Reasoning").alias("reasoning"),
    )
