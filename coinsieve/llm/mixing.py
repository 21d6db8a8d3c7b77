"""Mixing of sources to target weights by Pareto order sampling.

Each source gets a target in words. Of every document floor(target / size of source)
whole copies are certain. The words that are still missing come from one more copy
of some documents: each draws random odds u / (1 - u), divides them by its inclusion
odds, and in that order every document is taken that still fits into the missing number
of words, so the sample's size is fixed in words. A document's inclusion is the missing
share of its source, but less for one that would bring more than an eighth of the missing
words, so a few very long documents do not decide a small source. In the end no
untaken document fits; the smallest one is taken too if that comes nearer to the target.
Where a source then misses its target by more words than the documents taken in order
have on average, the smallest untaken document is kept and the order taken again over
the others, for the words it leaves; of all turns the nearest holds.

That is computed in rounds: among the documents that still fit, the order is cut where the
words would overflow; the rest of those that fit what is then open go into the next
round, until none is left. The place of a cut is found by counting: words by 1024
intervals of the rank, then by 1024 parts of the interval that is cut, and only its few
documents are sorted. No source is ever sorted or gathered whole.

Cases: a null text has no words; such documents are never taken. A null source is one
source and comes last. Repeated rows draw equal numbers and are taken together. Rows
without doc_id draw like one document. Random numbers depend on doc_id and ``seed``
alone. Other columns are not read, or pass through ``mixed``; names that start with
``_mx_`` are used inside.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coinsieve.llm.storage import checkpointed, stored
from coinsieve.operators.skew import skew_join, with_row_number

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all words
MOST = 2  # copies
SMALL_PART = 8
INTERVALS = 1024
ROUNDS = "array<struct<most:double,cut:double,open:boolean>>"
FILLS = "array<struct<rank:double,below:double>>"
# A plan with more sources is joined by a shuffle.
BROADCAST_SOURCES = 200_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def source_targets(slim: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, source_size, target): the weights repeat over the sources by code point."""
    sources = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_row_number(sources, [F.col("source").isNull(), F.col("source")], "_mx_place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_mx_place") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = checkpointed(ranked.withColumn("_mx_weight", weight))
    cap = F.col("source_size") * float(MOST)
    total = ranked.agg(F.sum("source_size").alias("n")).first().n or 0
    level, before = 0.0, None
    while True:  # each turn stops more sources at their cap; ends when none is added
        full = F.col("_mx_weight") * level >= cap if before is not None else F.lit(False)
        state = ranked.agg(
            F.sum(F.when(full, cap).otherwise(0.0)).alias("stopped"),
            F.sum(F.when(full, 0.0).otherwise(F.col("_mx_weight"))).alias("open"),
            F.count(F.when(full, 1)).alias("n"),
        ).first()
        if state.n == before or not state.open:
            break
        before = state.n
        level = max(level, (share * total - state.stopped) / state.open)
    return ranked.select("source", "source_size", F.least(F.col("_mx_weight") * level, cap).alias("target"))


def rank_of(seed: int) -> Column:
    """Random odds over inclusion odds, mapped to (0, 1)."""
    u = (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    chance = F.least(F.col("missing") / F.col("source_size"), F.col("missing") / (SMALL_PART * F.col("size")), F.lit(0.999999))
    odds = (u / (1 - u)) / (chance / (1 - chance))
    return odds / (1 + odds)


def with_draw(slim: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Adds ``rank`` in (0, 1): the order in which documents get one more copy."""
    return by_source(slim, plan).filter("size > 0 AND missing > 0").withColumn("rank", rank_of(seed))


def by_source(rows: DataFrame, plan: DataFrame, on: tuple = ("source",)) -> DataFrame:
    """Join with a table that has a row per source (or more keys), null included."""
    if plan.count() <= BROADCAST_SOURCES:
        named = F.broadcast(plan.withColumnsRenamed({k: f"_mx_on_{k}" for k in on}))
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_mx_on_{k}")) for k in on])
        return rows.join(named, same, "left").drop(*[f"_mx_on_{k}" for k in on])
    return skew_join(rows, plan, list(on), [c for c in ("doc_id", "rank") if c in rows.columns], null_safe=True)


def cut_of_order(drawn: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, cut, words, open): documents up to rank ``cut`` hold ``words``, the most
    that ``budget`` has room for. ``sources``: those whose documents do not all fit."""
    limits = kept(sources.select("source", F.lit(0.0).alias("low"), F.lit(1.0).alias("high"), F.lit(0).cast("long").alias("below")))
    size, budget = F.col("n"), F.col("budget")
    order = Window.partitionBy("source").orderBy("bin")
    for _ in range(2):
        step = (F.col("high") - F.col("low")) / INTERVALS
        bins = (
            by_source(drawn, limits)
            .filter("rank >= low AND rank < high")
            .groupBy("source", F.least(F.floor((F.col("rank") - F.col("low")) / step), F.lit(INTERVALS - 1)).alias("bin"))
            .agg(F.sum("size").alias("n"), F.first("budget").alias("budget"), F.first("low").alias("low"), F.first("high").alias("high"), F.first("below").alias("below"))
        )
        # At most INTERVALS rows to a source; the first whose words no longer fit is cut further.
        upto = F.sum("n").over(order)
        first = (
            bins.withColumn("upto", F.col("below") + upto)
            .filter(F.col("upto") > budget)
            .groupBy("source")
            .agg(F.min_by(F.struct("bin", F.col("low").alias("l"), F.col("high").alias("h"), (F.col("upto") - size).alias("b")), "bin").alias("x"))
        )
        width = (F.col("x.h") - F.col("x.l")) / INTERVALS
        limits = kept(
            first.select(
                "source", (F.col("x.l") + width * F.col("x.bin")).alias("low"),
                F.when(F.col("x.bin") == INTERVALS - 1, F.col("x.h")).otherwise(F.col("x.l") + width * (F.col("x.bin") + 1)).alias("high"),
                F.col("x.b").alias("below"),
            )
        )
    rows = by_source(drawn, limits).filter("rank >= low AND rank < high")
    upto = F.col("below") + F.sum("size").over(Window.partitionBy("source").orderBy("rank"))
    fits = rows.withColumn("upto", upto).filter(F.col("upto") <= budget)
    last = fits.groupBy("source").agg(F.max("rank").alias("_mx_rank"), F.max("upto").alias("_mx_upto"))
    cut = (
        by_source(limits, last)
        # Nothing of the last interval fits: the cut lies just below it.
        .select("source", F.coalesce("_mx_rank", F.col("low") - 1e-300).alias("cut"), F.coalesce("_mx_upto", "below").alias("words"), F.col("_mx_rank").isNull().alias("open"))
    )
    return kept(cut)


def kept(df: DataFrame) -> DataFrame:
    """Written, not checkpointed: the constraints that checkpoints carry on grow with every round."""
    return stored(df, "mix")


def plan_of(slim: DataFrame, seed: int = 0, share: float = SHARE, weights: tuple = WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """One row per source: target, certain copies, the rounds of the order and the document
    that comes after them; and the (source, rank) of repeated rows that fit singly only."""
    plan = source_targets(slim, share, weights)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("whole", whole.cast("int")).withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = kept(plan.withColumn("fills", F.array().cast(FILLS)).withColumn("filled", F.lit(0).cast("bigint")))
    drawn = with_draw(slim, plan.select("source", "source_size", "missing"), seed).select("source", "doc_id", "rank", "size")
    plan, refused = settled(drawn, plan)
    more, refused_now = plan, refused
    while True:  # each turn keeps one document more in a source, until these are too many words
        more = coarse(drawn, more)
        if more.isEmpty():
            break
        short = with_fill(drawn, more.filter("gap > 0"), refused_now, nearer=False).filter("gap <= 0")
        more, refused_now = settled(drawn, kept(more.filter("gap < 0").unionByName(short).drop("gap", "rounds")))
        old = plan.select("source", F.abs("gap").alias("old"))
        better = kept(by_source(more, old).filter(F.abs("gap") < F.col("old")).drop("old"))
        plan = kept(_without(plan, better).unionByName(better))
        refused = kept(_without(refused, better).unionByName(_only(refused_now, better)))
    return plan.select("source", "source_size", "target", "whole", "missing", "gap", "rounds", "fills"), refused


def _without(rows: DataFrame, sources: DataFrame) -> DataFrame:
    return by_source(rows, sources.select("source", F.lit(True).alias("_mx_in"))).filter("_mx_in IS NULL").drop("_mx_in")


def _only(rows: DataFrame, sources: DataFrame) -> DataFrame:
    return by_source(rows, sources.select("source", F.lit(True).alias("_mx_in"))).filter("_mx_in").drop("_mx_in")


def settled(drawn: DataFrame, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``plan`` with rounds for what its fills leave, and with one more fill."""
    plan = plan.withColumn("gap", F.col("missing") - F.col("filled")).withColumn("rounds", F.array().cast(ROUNDS))
    plan, refused = in_rounds(drawn, kept(plan))
    return with_fill(drawn, plan, refused), refused


def coarse(drawn: DataFrame, plan: DataFrame) -> DataFrame:
    """Sources that miss their target by more words than the documents taken in order have on average."""
    rows = by_source(drawn, plan.select("source", "rounds", "fills", "gap"))
    chosen = rows.filter(in_a_round(F.col("rank"), F.col("size")) & ~is_fill(F.col("rank"), F.col("size")))
    far = chosen.groupBy("source").agg(F.avg("size").alias("mean"), F.first("gap").alias("gap")).filter("mean < abs(gap)")
    return kept(_only(plan, kept(far)))


def in_rounds(drawn: DataFrame, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``plan`` with its rounds, and the repeated rows to leave out although one row fits.

    A round takes the first document of each source at least, so the rounds end.
    """
    open_rows = by_source(drawn, plan.select("source", "fills", "gap")).filter("size <= gap")
    fit = open_rows.filter(~is_fill(F.col("rank"), F.col("size"))).select(
        "source", "doc_id", "rank", "size", F.col("size").alias("least"), F.col("gap").alias("budget")
    )
    refused = []
    while True:
        sums = kept(fit.groupBy("source").agg(F.sum("size").alias("words"), F.first("budget").alias("budget")))
        if sums.isEmpty():
            break
        cut = sums.filter("words <= budget").select("source", F.lit(1.0).alias("cut"), "words", F.lit(False).alias("open"))
        over = sums.filter("words > budget").select("source")
        if not over.isEmpty():
            cut = kept(cut.unionByName(cut_of_order(fit, over)))
        added = F.concat("rounds", F.array(F.struct(F.col("gap").alias("most"), "cut", "open")))
        plan = kept(
            by_source(plan, cut)
            .withColumn("rounds", F.when(F.col("cut").isNull(), F.col("rounds")).otherwise(added))
            .withColumn("gap", F.col("gap") - F.coalesce("words", F.lit(0)))
            .drop("cut", "words", "open")
        )
        left = by_source(fit, cut).filter(~within(F.col("rank"), F.col("cut"), F.col("open")))
        left = left.withColumn("budget", F.col("budget") - F.col("words")).filter("least <= budget")
        # Repeated rows are one document from here on.
        left = kept(
            left.groupBy("source", "rank").agg(
                F.min("doc_id").alias("doc_id"), F.sum("size").alias("size"), F.min("least").alias("least"), F.first("budget").alias("budget")
            )
        )
        refused.append(left.filter("size > budget").select("source", "rank", "least"))
        fit = left.filter("size <= budget")
    if not refused:
        return plan, plan.select("source", F.lit(0.0).alias("rank"), F.lit(True).alias("refused")).limit(0)
    found = by_source(reduce(DataFrame.unionByName, refused), plan.select("source", "rounds"))
    # Only those that a row's own size would let in.
    return plan, kept(
        found.filter(in_a_round(F.col("rank"), F.col("least"))).select("source", "rank", F.lit(True).alias("refused")).distinct()
    )


def with_fill(drawn: DataFrame, plan: DataFrame, refused: DataFrame, nearer: bool = True) -> DataFrame:
    """``plan`` with the untaken document that comes nearest to what is open; ``nearer``:
    only where a source comes nearer to its target by it."""
    most = 2 * F.col("gap") if nearer else F.lit(float("inf"))
    rows = by_source(drawn, plan.select("source", "rounds", "fills", "gap")).filter((F.col("gap") > 0) & (F.col("size") < most))
    rows = by_source(rows, refused, ("source", "rank"))
    off = F.abs(F.col("n") - F.col("gap"))
    best = kept(
        rows.filter(F.col("refused").isNotNull() | ~in_a_round(F.col("rank"), F.col("size")))
        .filter(~is_fill(F.col("rank"), F.col("size")))
        .groupBy("source", "rank")
        .agg(F.sum("size").alias("n"), F.first("gap").alias("gap"))
        .filter(F.col("n") < most)
        .groupBy("source")
        .agg(F.min_by(F.struct("rank", most.alias("below"), "n"), F.struct(off, "rank")).alias("fill"))
    )
    fill = F.array(F.struct("fill.rank", "fill.below"))
    words = F.coalesce("fill.n", F.lit(0))
    return kept(
        by_source(plan, best)
        .withColumn("fills", F.when(F.col("fill").isNull(), F.col("fills")).otherwise(F.concat("fills", fill)))
        .withColumns({"gap": F.col("gap") - words, "filled": F.col("filled") + words})
        .drop("fill")
    )


def within(rank: Column, cut: Column, is_open: Column) -> Column:
    return F.when(is_open, rank < cut).otherwise(rank <= cut)


def is_fill(rank: Column, size: Column) -> Column:
    return F.exists("fills", lambda f: (rank == f["rank"]) & (size < f["below"]))


def in_a_round(rank: Column, size: Column) -> Column:
    """A document that fitted when its turn came."""
    return F.exists("rounds", lambda r: (size <= r["most"]) & within(rank, r["cut"], r["open"]))


def copies(rows: DataFrame, plan: DataFrame, refused: DataFrame, seed: int = 0) -> DataFrame:
    """``rows`` (with doc_id, source, size) and source_size, target, copies."""
    joined = by_source(rows, plan).withColumn("_mx_rank", F.when((F.col("size") > 0) & (F.col("missing") > 0), rank_of(seed)))
    joined = by_source(joined, refused.withColumnRenamed("rank", "_mx_rank"), ("source", "_mx_rank"))
    rank, size = F.col("_mx_rank"), F.col("size")
    once = F.coalesce(is_fill(rank, size), F.lit(False)) | (F.col("refused").isNull() & F.coalesce(in_a_round(rank, size), F.lit(False)))
    number = F.when(size > 0, F.col("whole") + once.cast("int")).otherwise(0)
    return joined.withColumn("copies", number).drop("whole", "missing", "rounds", "gap", "fills", "_mx_rank", "refused")


def slim_rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint"), F.col("source").cast("string"), word_count(F.col("text").cast("string")).alias("size")
    )


def mix_table(docs: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    slim = stored(slim_rows(docs), "sizes")
    return copies(slim, *plan_of(slim, seed), seed).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )


def mixed(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    slim = stored(slim_rows(docs), "sizes")
    plan, refused = plan_of(slim, seed)
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_mx_row"),
        F.col("doc_id").cast("bigint"), F.col("source").cast("string"), word_count(F.col("text").cast("string")).alias("size"),
    )
    made = copies(packed, plan, refused, seed).filter("copies > 0")
    return made.select(F.explode(F.array_repeat("_mx_row", F.col("copies"))).alias("_mx_row")).select("_mx_row.*")
