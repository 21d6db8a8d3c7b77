"""Statement folders that are scanned again and again: only new and changed files are read.

A store keeps the rows of every scan in a folder of its own, and a published manifest says
which file, of which length and time, lies in which of them and what was wrong with it. A
file whose length or time differs is read anew; the rows of its earlier state, and those of
files that are gone, stay behind unread.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinsieve.operators.skew import attach
from coinsieve.session import materialize
from coinsieve.sources.published import current, publish
from coinsieve.sources.statements import ROW_ID, csv_files, csv_options, literal_path, place, scan_statements

MANIFEST = "file string, length bigint, modified timestamp, scan string, problem string"
STORED = "file string, block bigint, line_no bigint, source string, raw_date string, description string, amount double"


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(file, path, length, modified) of every CSV file below a path; no file is opened."""
    found = csv_options(spark).format("binaryFile").load(path)
    return found.select(F.col("_metadata.file_path").alias("file"), "path", "length", F.col("modificationTime").alias("modified"))


def scan_incremental(
    spark: SparkSession, path: str, store: str, name_from_folder: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As ``scan_statements``, of the files that the store does not hold yet; and the listed files.

    Returns the rows of all files now below the path, the rejected ones, and all files.
    """
    now = materialize(listing(spark, path))
    saved = current(spark, f"{store}/manifest")
    known = spark.read.schema(MANIFEST).parquet(saved) if saved else spark.createDataFrame([], MANIFEST)
    state = ["file", "length", "modified"]
    kept = materialize(known.join(now.select(state), state, "left_semi"))
    fresh = materialize(now.join(kept.select(state), state, "left_anti"))
    paths = [literal_path(r.path) for r in fresh.select("path").collect()]
    files = kept
    if paths:
        scan = uuid.uuid4().hex
        rows, rejected = scan_statements(spark, paths, name_from_folder=name_from_folder)
        rows.select([part.split(" ")[0] for part in STORED.split(", ")]).write.parquet(f"{store}/rows/scan={scan}")
        faults = rejected.select(place(F.col("file")).alias("_place"), "problem")
        read = fresh.drop("path").withColumns({"scan": F.lit(scan), "_place": place(F.col("file"))})
        files = materialize(kept.unionByName(read.join(faults, "_place", "left").drop("_place")))
        publish(spark, f"{store}/manifest", files.write.parquet)
    good = files.filter("problem IS NULL").select("file", "scan")
    if good.isEmpty():
        rows = spark.createDataFrame([], STORED)
    else:
        stored = spark.read.schema(f"{STORED}, scan string").parquet(f"{store}/rows")
        rows = attach(stored, good, ["file", "scan"], ROW_ID, "inner").drop("scan")
    # A file without any byte is listed, but no reader meets it.
    empty = csv_files(spark, path).withColumn("_place", place(F.col("file"))).join(
        now.select(place(F.col("file")).alias("_place")), "_place", "left_anti"
    ).select("file", F.lit("empty or unreadable file").alias("problem"))
    rejected = files.filter("problem IS NOT NULL").select("file", "problem").unionByName(empty)
    return rows, materialize(rejected), files.select("file")
