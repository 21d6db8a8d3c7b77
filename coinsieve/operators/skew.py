"""Joins and numbering that hold when one key has a third of all rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coinsieve.session import materialize

# A key above this many rows is spread in parts of as many.
ROWS_PER_TASK = 50_000
# Where a key is hot, a task gets about so many parts. Their number follows from the rows: equal
# texts shrink to little in a shuffle, and tasks merged by size would hold, and later sort, millions.
PARTS_PER_TASK = 4
# At most this many keys count as hot, so the list of them (two integers each) stays
# below two megabytes whatever the table holds.
MAX_HOT_KEYS = 100_000


# A table below this many bytes of JSON is broadcast by ``attach``.
MAX_BROADCAST_BYTES = 64 << 20


def _frequencies(left: DataFrame, keys: list[str], counts: DataFrame | None) -> DataFrame:
    """(_jk, _jn): hash and rows of every key; ``counts`` (keys, n) saves counting again."""
    if counts is None:
        return left.groupBy(F.xxhash64(*keys).alias("_jk")).agg(F.count(F.lit(1)).alias("_jn"))
    return counts.select(F.xxhash64(*keys).alias("_jk"), F.col("n").alias("_jn"))


def _hottest(freq: DataFrame, rows_per_task: int) -> dict[int, int]:
    top = freq.filter(F.col("_jn") > rows_per_task).orderBy(F.desc("_jn"), "_jk").limit(MAX_HOT_KEYS)
    hot: dict[int, int] = {}
    for row in top.collect():
        hot[row["_jk"]] = max(hot.get(row["_jk"], 0), -(-row["_jn"] // rows_per_task))
    return hot


def hot_keys(
    left: DataFrame, keys: list[str], rows_per_task: int, counts: DataFrame | None = None
) -> dict[int, int]:
    """Hash and part count of every key with too many rows, the most frequent first
    where there are more than MAX_HOT_KEYS.

    ``counts`` (keys, n) saves counting again where the caller has done so.
    """
    return _hottest(_frequencies(left, keys, counts), rows_per_task)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    row_id: str | list[str],
    how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
    null_safe: bool = False,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Equi-join that splits the hot keys of ``left`` over many tasks.

    The keys are counted first, once. Without a hot key this is a plain join. Else
    rows of a hot key get one of n salts from a hash of ``row_id``; the matching
    rows of ``right`` are copied to those n salts. Salts depend on values only, so a repeated task
    gives the same rows. Supports left, inner, left_semi and left_anti.
    """
    keys = [on] if isinstance(on, str) else list(on)
    ids = [row_id] if isinstance(row_id, str) else list(row_id)
    types = {f.name: f.dataType for f in left.schema.fields}
    right = right.withColumns({k: F.col(k).cast(types[k]) for k in keys})
    # The rows are added up in passing, so that the table is not read again for their number.
    seen = Observation()
    freq = _frequencies(left, keys, counts).observe(seen, F.sum("_jn").alias("rows"))
    found = _hottest(freq, rows_per_task)
    if not found:
        if not null_safe:
            return left.join(right, keys, how)
        plain = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
        return left.join(plain, same, how).drop(*[f"_r_{k}" for k in keys])
    hot = F.broadcast(left.sparkSession.createDataFrame(list(found.items()), "_jk bigint, _js int"))

    salted = (
        left.withColumn("_jk", F.xxhash64(*keys))
        .join(hot, "_jk", "left")
        .withColumn(
            "_salt",
            F.when(F.col("_js").isNull(), F.lit(0)).otherwise(
                F.pmod(F.xxhash64(*ids), F.col("_js")).cast("int")
            ),
        )
        .drop("_jk", "_js")
    )
    spread = (
        right.withColumn("_jk", F.xxhash64(*keys))
        .join(hot, "_jk", "left")
        .withColumn(
            "_salt",
            F.explode(
                F.when(F.col("_js").isNull(), F.array(F.lit(0))).otherwise(
                    F.sequence(F.lit(0), F.col("_js") - 1)
                )
            ),
        )
        .drop("_jk", "_js")
    )
    if not null_safe:
        # Fewer than the session's tasks would be dealt again by the join.
        least = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tasks = max(least, -(-seen.get["rows"] // (PARTS_PER_TASK * rows_per_task)))
        return salted.repartition(tasks, *keys, "_salt").join(spread, [*keys, "_salt"], how).drop("_salt")

    renamed = spread.withColumnsRenamed({k: f"_r_{k}" for k in [*keys, "_salt"]})
    condition = F.col("_salt") == F.col("_r__salt")
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return salted.join(renamed, condition, how).drop("_salt", *[f"_r_{k}" for k in [*keys, "_salt"]])


def attach(
    left: DataFrame, right: DataFrame, on: str | list[str], row_id: str | list[str], how: str = "left"
) -> DataFrame:
    """Join with a table that is written already or cheap to read twice:
    broadcast it when its measured size is small, so ``left`` is not shuffled at
    all, else ``skew_join``."""
    size = right.agg(F.sum(F.octet_length(F.to_json(F.struct(*right.columns)))).alias("b")).first().b
    if (size or 0) <= MAX_BROADCAST_BYTES:
        return left.join(F.broadcast(right), on, how)
    return skew_join(left, right, on, row_id, how)


def unmatched(unique: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of a table with one row per key whose key ``other`` lacks.

    An outer join on purpose: Spark moves an anti join below the aggregate that
    made the keys unique, where it would meet every row of a hot key.
    """
    marked = other.select(key).distinct().withColumn("_known", F.lit(True))
    return unique.join(marked, key, "left").filter("_known IS NULL").drop("_known")


def with_row_number(df: DataFrame, order: list[Column], name: str = "row_number") -> DataFrame:
    """Global 1, 2, 3, … in the given order without a one-task window.

    Range partitions are sorted on their own and numbered locally; only the
    row count of each partition is needed to shift the local numbers. The
    sorted table is checkpointed, so both passes see the same partitions.
    """
    local = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id())
        .withColumns(
            {
                "_part": F.shiftright(F.col("_pos"), 33),
                "_pos": F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1)),
            }
        )
    )
    sizes = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition, so this window and the broadcast stay small.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    return (
        local.join(F.broadcast(shift), "_part")
        .withColumn(name, F.col("_shift") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_shift")
    )
