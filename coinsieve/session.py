"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLES_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "coinsieve", cpus: int | str = "*", **confs: str) -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in confs.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the context checkpoints to,
    else the one ``spark.checkpoint.dir`` names.

    A local session without either uses its warehouse folder. On a cluster that
    names no folder this is an error: no folder of one machine can stand in.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        # Spark adds a folder of its own below the one it was given.
        return spark.conf.get(CHECKPOINT_CONF, None) or folder
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(
                f"set {CHECKPOINT_CONF} to a folder that all executors share, "
                "or call sparkContext.setCheckpointDir"
            )
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/coinsieve/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later stages read files, so a lost executor does
    not repeat model calls or row numbering with another outcome."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(df: DataFrame) -> None:
    """Remove the files of a materialized table, or of columns picked from one, that nothing reads any
    more: else they stay until the driver happens to collect its garbage."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.children().size() == 1:
        plan = plan.children().head()
    file = plan.rdd().getCheckpointFile()
    if file.isDefined():
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_let_go(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of an action go when it has ended, not when the driver happens to
    collect its garbage. A table that is handed on should be selected from anew outside."""
    before = spark.conf.get(SHUFFLES_CONF)
    spark.conf.set(SHUFFLES_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_CONF, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any file system that Spark reaches.

    Other faults (no permission, a wrong scheme) are errors, not a missing path.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
