"""Multi-party perspective rotation of dialogues.

For every participant of a conversation the dialogue is rendered with that speaker as
the assistant and all others as users with their names; the mask holds the spans of the
assistant's words. Long dialogues are rendered in segments of ``segment_turns``
turns, numbered from 0: set one after another they are the whole dialogue, and no
task ever holds more turns of one conversation than that.

A turn is rendered as ``<|im_start|>role name=speaker`` line, text, ``<|im_end|>`` line; the
name only for users. ``<|`` in texts and names is written ``< |``, so no text can pass
for a mark. Speakers named in ``system`` speak as system in every perspective and have
none of their own.

Everything is DataFrame and SQL functions.

Cases: turns are ordered by turn (nulls first), role, text. A null text is empty, a null
role is the speaker ''. Rows without conv_id are one conversation. Repeated rows are
repeated turns. A conversation without participants has no rendering. Mask spans are
'from-to' by code points, the end not included, separated by spaces; '' if the speaker
has no turn in the segment. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinsieve.llm.storage import stored
from coinsieve.operators.skew import with_row_number

SEGMENT_TURNS = 64
SYSTEM = ("system",)


def safe(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def rotate_perspectives(
    turns: DataFrame, segment_turns: int = SEGMENT_TURNS, system: tuple[str, ...] = SYSTEM
) -> DataFrame:
    """conv_id, perspective, segment, n_turns, rendered, mask, n_masked."""
    rows = turns.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    numbered = stored(with_row_number(rows, order, "place"), "turns")
    first = numbered.groupBy("conv_id").agg(F.min("place").alias("first"))
    segments = (
        numbered.join(first.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")))
        .groupBy("conv_id", F.floor((F.col("place") - F.col("first")) / segment_turns).alias("segment"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    )
    speakers = (
        numbered.filter(~F.col("role").isin(*system))
        .select(F.col("conv_id").alias("c"), F.col("role").alias("perspective"))
        .distinct()
    )
    mine = F.col("perspective")

    def head(t: Column) -> Column:
        role = (
            F.when(t["role"] == mine, F.lit("assistant"))
            .when(t["role"].isin(*system), F.lit("system"))
            .otherwise(F.concat(F.lit("user name="), safe(t["role"])))
        )
        return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"))

    parts = F.transform(
        "turns",
        lambda t: F.struct(
            head(t).alias("head"), safe(t["text"]).alias("text"), F.lit("<|im_end|>\n").alias("tail"),
            (t["role"] == mine).alias("own"),
        ),
    )
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("spans"), F.lit(0).cast("bigint").alias("n"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + F.length(p["head"])
        end = begin + F.length(p["text"])
        span = F.concat(begin.cast("string"), F.lit("-"), end.cast("string"))
        return F.struct(
            (end + F.length(p["tail"])).cast("bigint").alias("at"),
            F.when(p["own"], F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
            F.when(p["own"], acc["n"] + end - begin).otherwise(acc["n"]).cast("bigint").alias("n"),
        )

    shown = (
        segments.join(speakers, F.col("conv_id").eqNullSafe(F.col("c")))
        .withColumn("parts", parts)
        .withColumn("masked", F.aggregate("parts", zero, step))
    )
    return shown.select(
        "conv_id", "perspective", F.col("segment").cast("bigint").alias("segment"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["text"], p["tail"])), "").alias("rendered"),
        F.array_join("masked.spans", " ").alias("mask"), F.col("masked.n").alias("n_masked"),
    )
