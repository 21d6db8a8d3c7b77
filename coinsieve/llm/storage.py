"""Steps of a job written to the shared folder, and their shuffle files let go."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from coinsieve.session import materialize, scratch_path

# Within a step: shuffle files go when it has ended, and Python tasks get small batches.
STEP = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Within, the settings of a step hold; then those from before again."""
    before = {key: spark.conf.get(key) for key in STEP}
    for key, value in STEP.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet and read again: a lost executor repeats nothing of it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with tidy(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    with tidy(df.sparkSession):
        return materialize(df)
