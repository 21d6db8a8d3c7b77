"""Incremental, restart-safe ingestion with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from coinsieve.functions.keys import KEY_PARTS, with_dedupe_key
from coinsieve.functions.parsing import parse_date
from coinsieve.operators.dedupe import dedupe_exact
from coinsieve.operators.rows import normalized
from coinsieve.session import path_exists
from coinsieve.sources.layouts import Layout
from coinsieve.sources.statements import literal_path, read_layout


BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


@dataclass(frozen=True)
class StatementStream:
    """A stream of statement files and how a batch of them is read."""

    files: DataFrame
    read: Callable[[DataFrame], DataFrame]


def statement_stream(
    spark: SparkSession, path: str, layout: str | Layout, columns: list[str], max_files: int = 1000
) -> StatementStream:
    """The statement files that appear below a path, at most ``max_files`` in a batch.

    ``columns`` is the files' header; the layout picks from it by name. The stream itself
    carries names of files; each batch reads its files by block, as ``read_layout``
    does, so a large file goes to many tasks and cells may hold line breaks.
    """
    # Of a binary file only the columns asked for are read, not its content.
    found = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("maxFilesPerTrigger", max_files).load(path)
    files = found.select("path")

    def read(batch: DataFrame) -> DataFrame:
        session = batch.sparkSession
        paths = [literal_path(r.path) for r in batch.collect()]
        if not paths:
            return _rows(session.createDataFrame([], EMPTY))
        return _rows(read_layout(session, paths, layout, columns=columns))

    return StatementStream(files, read)


EMPTY = "raw_date string, description string, amount double, source string, file string"


def _rows(read: DataFrame) -> DataFrame:
    return normalized(read.withColumn("date", parse_date(F.col("raw_date"))).drop("raw_date"))


def ingest_stream(rows: StatementStream, target: str, checkpoint: str) -> StreamingQuery:
    """Append everything new to a Parquet table and stop. Every batch is a folder of
    its own, written anew when it is replayed."""

    def write(batch: DataFrame, epoch: int) -> None:
        rows.read(batch).write.mode("overwrite").parquet(f"{target.rstrip('/')}/epoch={epoch}")

    return _started(rows, write, checkpoint)


def _started(rows: StatementStream, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    stream = rows.files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).start()


def month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def stored_keys(spark: SparkSession, store: str, epoch: int, batch: DataFrame) -> DataFrame | None:
    """Duplicate keys of other epochs within the batch's months, or None when there
    is nothing to compare with. The store is partitioned by month, so only the
    files of those months are opened."""
    months = [r.m for r in batch.filter("date IS NOT NULL").select(month(F.col("date")).alias("m")).distinct().collect()]
    if not months or not path_exists(spark, store):
        return None
    saved = spark.read.option("basePath", store).parquet(store)
    near = saved.filter((F.col("epoch") != epoch) & F.col("month").isin(months))
    return with_dedupe_key(near).select(*KEY_PARTS).filter("key_date IS NOT NULL").distinct()


def upsert_batch(
    store: str, categorize: Callable[[DataFrame], DataFrame] | None = None
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: categorize, drop duplicates within the batch
    and against the store, and write the batch as its own epoch.

    Writing an epoch again replaces it, so a replayed batch leaves the same
    rows. Rows without a key are always new.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        # The same files give the same places when a batch is replayed.
        placed = batch if "seq" in batch.columns else batch.withColumn("seq", F.monotonically_increasing_id())
        rows = placed if categorize is None else categorize(placed)
        kept = dedupe_exact(rows)
        known = stored_keys(batch.sparkSession, store, epoch, placed)
        if known is not None:
            # Both sides have one row per key here, so no key is hot.
            other = known.withColumnsRenamed({k: f"_{k}" for k in KEY_PARTS})
            same = (
                (F.col("key_date") == F.col("_key_date"))
                & (F.col("key_desc") == F.col("_key_desc"))
                & F.col("key_amount").eqNullSafe(F.col("_key_amount"))
            )
            kept = with_dedupe_key(kept).join(other, same, "left_anti").drop(*KEY_PARTS)
        by_month = kept.withColumn("month", F.coalesce(month(F.col("date")), F.lit("none")))
        by_month.write.mode("overwrite").partitionBy("month").parquet(f"{store.rstrip('/')}/epoch={epoch}")

    return write


def upsert_stream(
    rows: StatementStream, store: str, checkpoint: str,
    categorize: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    upsert = upsert_batch(store, categorize)
    return _started(rows, lambda batch, epoch: upsert(rows.read(batch), epoch), checkpoint)
