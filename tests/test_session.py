"""Where intermediate tables go, in sessions of their own with no settings preset."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
from pyspark.sql import SparkSession
from coinsieve.session import materialize, path_exists, scratch_path, shared_dir
kind, folder = sys.argv[1:]
builder = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
builder = builder.config("spark.sql.warehouse.dir", folder + "/warehouse")
if kind == "setting":
    builder = builder.config("spark.checkpoint.dir", folder + "/named")
spark = builder.getOrCreate()
if kind == "call":
    spark.sparkContext.setCheckpointDir(folder + "/called")
if kind == "cluster":
    class Remote:
        master = "spark://host:1"
        def getCheckpointDir(self): return None
    class Session:
        sparkContext, conf = Remote(), spark.conf
    try:
        shared_dir(Session())
    except RuntimeError as error:
        print("FOLDER", error)
else:
    assert materialize(spark.range(5)).count() == 5
    path = scratch_path(spark, "x")
    assert not path_exists(spark, path)
    spark.range(3).write.parquet(path)
    assert path_exists(spark, path)
    print("FOLDER", path)
"""


@pytest.mark.parametrize("kind, part", [
    ("setting", "/named/"), ("call", "/called/"), ("neither", "/warehouse/_checkpoints/"), ("cluster", "spark.checkpoint.dir"),
])
def test_the_shared_folder(tmp_path, kind, part):
    conf = tmp_path / "conf"
    conf.mkdir()
    env = os.environ | {"SPARK_CONF_DIR": str(conf), "PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-c", SCRIPT, kind, str(tmp_path)], env=env, capture_output=True, text=True, timeout=300)
    (line,) = [x for x in done.stdout.splitlines() if x.startswith("FOLDER")]
    assert part in line, done.stderr[-2000:]
