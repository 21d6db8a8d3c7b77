"""Structured Streaming ingestion of statement files."""

from __future__ import annotations

from pyspark.sql import functions as F

from coinsieve.operators.match import match_keywords_exact
from coinsieve.session import scratch_path
from coinsieve.sources.tables import keyword_table
from coinsieve.streaming.ingest import ingest_stream, statement_stream, upsert_stream
from registry.core import query
from registry.views import table

HEADER = ["Reference", "Transaction Date", "Description", "Amount"]


def land(spark, sf, path, where):
    """Write the orders of a period as export files into the watched folder."""
    table(spark, sf, "orders").filter(where).select(
        F.col("o_orderkey").alias("Reference"), F.date_format("o_orderdate", "MM/dd/yyyy").alias("Transaction Date"),
        F.concat(F.lit("Online Order "), "o_orderpriority").alias("Description"),
        F.round(F.col("o_totalprice") / 100000).alias("Amount"),
    ).write.mode("append").option("header", True).csv(path)


OLD, NEW = "o_orderdate < '1998-01-01'", "o_orderdate >= '1998-01-01'"


@query("stream_ingest", """
SELECT CAST(o_orderdate AS DATE) AS date, lower('order ' || o_orderpriority) AS normalized_desc,
       round(o_totalprice / 100000) AS amount, 'Chase' AS source
FROM orders""")
def _(spark, sf):
    """Two runs of the stream, with files landing in between."""
    folder, target, state = (scratch_path(spark, n) for n in ("landing", "ingested", "state"))
    for where in (OLD, NEW):
        land(spark, sf, folder, where)
        ingest_stream(statement_stream(spark, folder, "chase", HEADER), target, state).awaitTermination()
    return spark.read.parquet(target).select("date", "normalized_desc", "amount", "source")


@query("stream_upsert", """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, lower('order ' || o_orderpriority) AS normalized_desc,
       round(o_totalprice / 100000) AS amount,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'Low' WHEN o_orderpriority = '1-URGENT' THEN 'Urgent' END AS category
FROM orders""")
def _(spark, sf):
    """The second run lands everything once more: nothing is stored twice."""
    folder, store, state = (scratch_path(spark, n) for n in ("landing", "store", "state"))
    keywords = keyword_table(spark, {"Low": ["low"], "Urgent": ["urgent"]})

    def label(batch):
        matched = match_keywords_exact(batch, keywords)
        return matched.withColumn("category", F.col("keyword_match.category")).drop("keyword_match")

    for where in (OLD, "true"):
        land(spark, sf, folder, where)
        rows = statement_stream(spark, folder, "chase", HEADER)
        upsert_stream(rows, store, state, label).awaitTermination()
    return spark.read.parquet(store).select("date", "normalized_desc", "amount", "category")
