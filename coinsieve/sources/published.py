"""Tables that are replaced as a whole: versions below one path.

A version is written beside the others and counts once its marker is there, which is one
small file. A writer that fails leaves the version before it in force, and a
reader never meets half of a new one. Nothing is renamed, so it holds in object stores.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

MARK = "_PUBLISHED"
# Complete versions that stay: readers of the one before may be at work still.
KEPT = 3


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _folder(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/version={version}"


def versions(spark: SparkSession, path: str) -> tuple[list[int], list[int]]:
    """The complete and the unfinished versions at a path, each in ascending order."""
    fs, place = _place(spark, path)
    if not fs.exists(place) or not fs.getFileStatus(place).isDirectory():
        return [], []
    names = [status.getPath().getName() for status in fs.listStatus(place)]
    found = sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version=") and n[8:].isdigit())
    whole = [v for v in found if fs.exists(_place(spark, f"{_folder(path, v)}/{MARK}")[1])]
    return whole, [v for v in found if v not in whole]


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest complete version, None without one."""
    whole, _ = versions(spark, path)
    return _folder(path, whole[-1]) if whole else None


def publish(spark: SparkSession, path: str, write: Callable[[str], None], kept: int = KEPT) -> str:
    """Have ``write`` fill the folder of a new version and make it the current one.

    Older versions but the newest ``kept`` go, and so do those that were never finished.
    """
    whole, unfinished = versions(spark, path)
    version = max([0, *whole, *unfinished]) + 1
    folder = _folder(path, version)
    write(folder)
    fs, mark = _place(spark, f"{folder}/{MARK}")
    fs.create(mark, True).close()
    for old in [*whole[: max(0, len(whole) + 1 - kept)], *unfinished]:
        fs.delete(_place(spark, _folder(path, old))[1], True)
    return folder
