import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from coinsieve.session import build_session  # noqa: E402

TXN_SCHEMA = (
    "txn_id string, seq bigint, date date, amount double, description string, "
    "normalized_desc string, source string, file string"
)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def txns(spark):
    """Transactions from (description, amount, 'YYYY-MM-DD' or None) rows."""
    from pyspark.sql import functions as F

    from coinsieve.functions.text import normalize_description

    def make(rows):
        data = []
        for i, (text, amount, day) in enumerate(rows):
            date = dt.date.fromisoformat(day) if day else None
            data.append((str(i), i, date, amount, text, None, "src", "f.csv"))
        df = spark.createDataFrame(data, TXN_SCHEMA)
        return df.withColumn("normalized_desc", normalize_description(F.col("description")))

    return make
