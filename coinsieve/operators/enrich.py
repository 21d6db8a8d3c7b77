"""Pluggable batch functions in place of a remote model.

A function takes a pandas frame with up to ``batch_size`` rows and returns one
reply text per row, or one text for the batch. It runs inside Arrow batches on
the executors, with bounded retries. Replies are parsed by Spark expressions.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinsieve.functions.jsonfix import parse_json
from coinsieve.functions.keys import KEY_PARTS, description_key
from coinsieve.functions.text import normalize_description, strip
from coinsieve.functions.usage import route_model
from coinsieve.operators.cache import add_entries
from coinsieve.operators.dedupe import NO_REASON, UNPARSED_REASON, combine_verdicts
from coinsieve.operators.order import BATCH_SIZE
from coinsieve.operators.skew import skew_join, unmatched
from coinsieve.schema import CATEGORIES, NORMALIZE_CACHE, UNCATEGORIZED
from coinsieve.session import materialize

RowReply = Callable[[pd.DataFrame], list[str]]
BatchReply = Callable[[list[str]], str]

# Retry policy of a call.
ATTEMPTS = 3
WAIT_SECONDS = (2.0, 10.0)
ESCALATE_BELOW = 0.7
# Batches that a task asks for, about; beyond so many tasks each asks for more.
CALLS_PER_TASK = 4
MOST_TASKS = 2000
# Members of duplicate groups that a task streams to its judges, about.
MEMBERS_PER_TASK = 50_000
# The replies of so many tasks are read by one task later on.
READ_TOGETHER = 16
# The model by default, and how the context of a call names its purpose.
MODEL = "gpt-4o"
NORMALIZING, CATEGORIZING, JUDGING = "norm_batch", "txn:", "dedupe"


def _with_retries(call, attempts: int, wait: tuple[float, float]):
    """(result, error, tries): up to ``attempts`` calls with doubling waits."""
    pause, error = wait[0], None
    for attempt in range(attempts):
        try:
            return call(), None, attempt + 1
        except Exception as caught:  # a failing batch falls back, it does not stop the job
            error = str(caught) or type(caught).__name__
            if attempt + 1 < attempts:
                time.sleep(min(pause, wait[1]))
                pause *= 2
    return None, error, attempts


def _spread(df: DataFrame, key: list[str], tasks: int | None, batch_size: int) -> tuple[DataFrame, int]:
    """Rows over a number of tasks that follows from the number of rows alone: about
    CALLS_PER_TASK batches in each, on any cluster. Calls are slow while their rows are few, so
    tasks must not be merged by size; but MOST_TASKS keep any cluster busy."""
    if tasks is None:
        df = materialize(df)
        tasks = _tasks(df.count(), batch_size)
    return df.repartition(tasks, *key), tasks


def _tasks(asked: int, batch_size: int) -> int:
    return min(MOST_TASKS, max(1, -(-asked // (batch_size * CALLS_PER_TASK))))


def _asked(replies: DataFrame) -> DataFrame:
    """Replies written once. The tasks that asked are many and their rows few: later steps read
    them by fewer tasks."""
    done = materialize(replies)
    return done.coalesce(max(1, -(-done.rdd.getNumPartitions() // READ_TOGETHER)))


class _Pace:
    """Keeps a task to its share of the calls that all tasks together may make in a second."""

    def __init__(self, rate: float | None, tasks: int):
        self.gap = tasks / rate if rate else 0.0
        self.next = 0.0

    def __call__(self, fn, *args):
        now = time.monotonic()
        if now < self.next:
            time.sleep(self.next - now)
        self.next = max(now, self.next) + self.gap
        return fn(*args)


# What is known of a call besides its reply.
CALL = "reply string, error string, prompt_chars bigint, response_chars bigint, tries int"
CALL_NAMES = [part.strip().split(" ")[0] for part in CALL.split(",")]


def _texts_of(df: DataFrame) -> str | None:
    """The column that holds the question of a row."""
    return next((c for c in ("prompt", "records", "description") if c in df.columns), None)


def ask_rows(
    df: DataFrame, fn: RowReply, key: list[str], batch_size: int = BATCH_SIZE,
    attempts: int = ATTEMPTS, wait: tuple[float, float] = WAIT_SECONDS, tasks: int | None = None,
    rate: float | None = None,
) -> DataFrame:
    """Add ``reply``, ``error`` and the sizes of a call; a failed batch has no replies.

    ``rate`` bounds the batches that all tasks together ask in a second.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    question = _texts_of(df)
    dealt, tasks = _spread(df, key, tasks, batch_size)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        paced = _Pace(rate, tasks)
        for frame in frames:
            for at in range(0, len(frame), batch_size):
                part = frame.iloc[at:at + batch_size].reset_index(drop=True)

                def call(rows=part):
                    replies = list(paced(fn, rows))
                    if len(replies) != len(rows):
                        raise ValueError(f"expected {len(rows)} replies, got {len(replies)}")
                    return replies

                replies, error, tries = _with_retries(call, attempts, wait)
                asked = part[question].fillna("").astype(str).str.len() if question else 0
                answered = [len(r or "") for r in replies] if replies is not None else 0
                yield part.assign(
                    reply=replies if replies is not None else None, error=error,
                    prompt_chars=asked, response_chars=answered, tries=tries,
                )

    return dealt.mapInPandas(run, f"{fields}, {CALL}")


def ask_batches(
    df: DataFrame, column: str, fn: BatchReply, batch_size: int = BATCH_SIZE,
    attempts: int = ATTEMPTS, wait: tuple[float, float] = WAIT_SECONDS, tasks: int | None = None,
    rate: float | None = None,
) -> DataFrame:
    """(items, reply, error and sizes): one text reply per batch of up to n values."""
    dealt, tasks = _spread(df.select(column), [column], tasks, batch_size)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        paced = _Pace(rate, tasks)
        for frame in frames:
            values = frame[column].tolist()
            for at in range(0, len(values), batch_size):
                items = values[at:at + batch_size]
                reply, error, tries = _with_retries(lambda rows=items: paced(fn, rows), attempts, wait)
                yield pd.DataFrame({
                    "items": [items], "reply": [reply], "error": [error],
                    "prompt_chars": sum(len(i or "") + 1 for i in items), "response_chars": len(reply or ""), "tries": tries,
                })

    return dealt.mapInPandas(run, f"items array<string>, {CALL}")


def note_calls(replies: DataFrame, log: str | None, model: str, context: str) -> DataFrame:
    """``replies`` without the sizes of its calls, which go to the log at a path, a row for each.

    ``replies`` is written already, so a logged call is one whose reply counts, once. The
    model is the one that the context is routed to.
    """
    if log is not None:
        named, purpose = F.lit(model), F.lit(context)
        replies.filter("prompt_chars IS NOT NULL").select(
            route_model(named, purpose).alias("model"), purpose.alias("context"),
            "prompt_chars", "response_chars", "error", "tries",
        ).write.mode("append").parquet(log)
    return replies.drop("prompt_chars", "response_chars", "tries")


def reply_lines(reply: Column) -> Column:
    """Trimmed, non-empty lines of a reply."""
    return F.filter(F.transform(F.split(reply, "\n"), strip), lambda line: line != "")


def align_replies(batches: DataFrame, fallback: Callable[[Column], Column] = normalize_description) -> DataFrame:
    """One row per item. Missing lines and failed batches use the fallback,
    lines beyond the batch are left out."""
    lined = batches.withColumn("lines", F.coalesce(reply_lines(F.col("reply")), F.array()))
    items = lined.select("error", "lines", F.posexplode("items").alias("pos", "original"))
    line = F.get("lines", F.col("pos"))
    return items.select(
        "original",
        F.coalesce(line, fallback(F.col("original"))).alias("result"),
        "error",
        line.isNull().alias("fallback_used"),
    )


def enrich(
    df: DataFrame, fn: BatchReply, cache: DataFrame, log: str | None = None, model: str = MODEL, **calls
) -> tuple[DataFrame, DataFrame]:
    """Normalize descriptions by a batch function, through a cache.

    Each distinct description the cache lacks is asked for once. Returns the
    rows with ``normalized_desc`` and the cache with the new entries, which are
    checkpointed so that reading either one does not repeat the calls. ``log`` names a
    table that takes a row per call (see ``note_calls``).
    """
    keyed = df.withColumn("_key", description_key(F.col("description")))
    texts = keyed.filter("description IS NOT NULL").select("_key", "description").distinct()
    wanted = unmatched(texts, cache.select(F.col("key").alias("_key")), "_key")
    replies = note_calls(_asked(ask_batches(wanted, "description", fn, **calls)), log, model, NORMALIZING)
    new = materialize(
        align_replies(replies).select(
            description_key(F.col("original")).alias("key"), "original", "result",
            F.current_timestamp().alias("ts"), F.lit(1).cast("bigint").alias("hits"),
            "error", F.lit(True).alias("batch_processed"), "fallback_used",
        )
    )
    entries = add_entries(cache, new)
    found = entries.select(F.col("key").alias("_key"), F.col("result").alias("_result"))
    rows = skew_join(keyed, found, "_key", "txn_id", "left")
    return (
        rows.withColumn("normalized_desc", F.col("_result")).drop("_key", "_result"),
        entries,
    )


def empty_cache(spark, schema: str = NORMALIZE_CACHE) -> DataFrame:
    return spark.createDataFrame([], schema)


# --- classification ------------------------------------------------------------


def parse_result(df: DataFrame, prefix: str = "") -> DataFrame:
    """Category, confidence and reasoning out of ``reply`` and ``error``."""
    v = F.col("_json")
    part = {
        "category": F.try_variant_get(v, "$.category", "string"),
        "confidence": F.try_variant_get(v, "$.confidence", "double"),
        "reasoning": F.try_variant_get(v, "$.reasoning", "string"),
    }
    complete = part["category"].isNotNull() & part["confidence"].isNotNull() & part["reasoning"].isNotNull()
    failure = (
        F.when(F.col("error").isNotNull(), F.concat(F.lit("Failed to categorize due to error: "), F.col("error")))
        .when(v.isNull(), F.concat(F.lit("Failed to parse LLM response: "), F.coalesce(F.substring("reply", 1, 100), F.lit(""))))
        .otherwise(F.lit("Failed to categorize due to error: incomplete reply"))
    )
    return df.withColumn("_json", parse_json(F.col("reply"))).withColumns(
        {
            f"{prefix}category": F.when(complete, part["category"]).otherwise(F.lit(UNCATEGORIZED)),
            f"{prefix}confidence": F.when(complete, part["confidence"]).otherwise(F.lit(0.0)),
            f"{prefix}reasoning": F.when(complete, part["reasoning"]).otherwise(failure),
            f"{prefix}parsed": complete,
        }
    ).drop("reply", "_json")


def classify(
    df: DataFrame, primary: RowReply, escalate: RowReply | None = None, key: str = "text_key",
    log: str | None = None, models: tuple[str, str] = (MODEL, MODEL), **calls
) -> DataFrame:
    """Ask the first function for every row and the second for the rows it
    left uncategorized with little confidence; the surer answer is kept.

    ``df`` has one row per key. Both stages are checkpointed. ``models`` are the names that
    the calls are logged under.
    """
    first = note_calls(_asked(parse_result(ask_rows(df, primary, [key], **calls))), log, models[0], CATEGORIZING).drop("error")
    if escalate is None:
        return first.drop("parsed")
    unsure = first.filter(
        (F.col("confidence") < ESCALATE_BELOW) & (F.col("category") == UNCATEGORIZED) & F.col("parsed")
    ).select(*df.columns)
    second = note_calls(_asked(parse_result(ask_rows(unsure, escalate, [key], **calls), "e_")), log, models[1], CATEGORIZING)
    both = first.join(second.select(key, "e_category", "e_confidence", "e_reasoning", "e_parsed"), key, "left")
    better = F.coalesce(F.col("e_parsed") & (F.col("e_confidence") > F.col("confidence")), F.lit(False))
    return both.select(
        *df.columns,
        *[F.when(better, F.col(f"e_{c}")).otherwise(F.col(c)).alias(c) for c in ("category", "confidence", "reasoning")],
    )


# Guidance given with every question; free wording, no fixed value.
GUIDANCE = (
    "Prefer the most specific category. Use Payments only for transfers and bills whose purpose is "
    "unclear. Judge by merchant, amount and time of month.\n"
    'Answer with JSON: {"category": "...", "confidence": 0-1, "reasoning": "..."}'
)


def build_prompt(df: DataFrame, examples: DataFrame | None = None, categories: list[str] | None = None) -> DataFrame:
    """Add ``prompt`` from the row and the few examples of each category.

    ``examples`` (category, rank, example) holds a few lines per category, so
    they fit one value that every row refers to.
    """
    labels = ", ".join((categories or CATEGORIES) + [UNCATEGORIZED])
    shown = F.lit("")
    if examples is not None:
        line = F.concat(F.lit("- "), F.col("example"), F.lit(" → "), F.col("category"), F.lit("\n"))
        lines = F.sort_array(F.collect_list(F.struct("category", "rank", line.alias("line"))))
        joined = F.concat_ws("", F.transform(lines, lambda x: x["line"]))
        shown = F.coalesce(
            examples.agg(F.concat(F.lit("Examples:\n"), joined).alias("t")).scalar(), F.lit("")
        )
    prompt = F.concat(
        F.lit(f"Categorize this transaction into one of: {labels}.\n"), shown,
        F.format_string(
            "Transaction:\n- Date: %s\n- Description: %s\n- Normalized: %s\n- Amount: %s\n- Source: %s\n",
            F.coalesce(F.date_format("date", "MM/dd/yyyy"), F.lit("unknown")),
            F.coalesce("description", F.lit("unknown")),
            F.coalesce("normalized_desc", F.lit("unknown")),
            F.coalesce(F.format_string("%.2f", "amount"), F.lit("unknown")),
            F.coalesce("source", F.lit("unknown")),
        ),
        F.lit(GUIDANCE),
    )
    return df.withColumn("prompt", prompt)


# --- duplicates -------------------------------------------------------------------


def _verdicts(asked: DataFrame, log: str | None, model: str) -> DataFrame:
    """One verdict per key from the replies on its parts."""
    v = F.col("_json")
    replies = note_calls(_asked(asked), log, model, JUDGING)
    return combine_verdicts(replies.withColumn("_json", parse_json(F.col("reply"))).select(
        *KEY_PARTS, "part",
        F.when(v.isNull(), F.lit(True))
        .otherwise(F.coalesce(F.try_variant_get(v, "$.is_duplicate", "boolean"), F.lit(False)))
        .alias("is_duplicate"),
        F.when(v.isNull(), F.lit(UNPARSED_REASON))
        .otherwise(F.coalesce(F.try_variant_get(v, "$.reasoning", "string"), F.lit(NO_REASON)))
        .alias("reasoning"),
        F.col("error").isNotNull().alias("failed"),
    ))


def adjudicate(groups: DataFrame, fn: RowReply, log: str | None = None, model: str = MODEL, **calls) -> DataFrame:
    """Verdict per duplicate group from ``duplicate_groups``.

    The function sees the members of a part as JSON in ``records`` and replies
    with JSON holding is_duplicate and reasoning.
    """
    shown = F.transform(
        "members",
        lambda m: F.struct(
            F.date_format(m["date"], "MM/dd/yyyy").alias("Date"), m["description"].alias("Description"),
            m["amount"].alias("Amount"), m["source"].alias("Source"),
        ),
    )
    asked = groups.select(*KEY_PARTS, "part", F.to_json(shown).alias("records"))
    return _verdicts(ask_rows(asked, fn, [*KEY_PARTS, "part"], **calls), log, model)


class GroupJudge:
    """Judges duplicate groups of any size, each as a stream of its members in order.

    ``add`` is called with a frame of members (seq, txn_id, date, description, amount, source)
    after the other, then ``reply`` for JSON with is_duplicate and reasoning. A judge keeps what it
    needs of the members; the engine keeps none but the frame at hand. A call that raises is
    tried again with the same frame.
    """

    def add(self, members: pd.DataFrame) -> None:
        raise NotImplementedError

    def reply(self) -> str:
        raise NotImplementedError


MEMBER = ["seq", "txn_id", "date", "description", "amount", "source"]


def adjudicate_streamed(
    members: DataFrame, judge: Callable[[], GroupJudge], attempts: int = ATTEMPTS, wait: tuple[float, float] = WAIT_SECONDS,
    tasks: int | None = None, rate: float | None = None, batch_size: int = BATCH_SIZE, log: str | None = None, model: str = MODEL,
) -> DataFrame:
    """Verdict per duplicate group from ``group_members``: each group goes to a new
    ``judge()`` whole and in the order of ``seq``, frame after frame."""
    keyed = members.withColumn("_group", F.md5(F.to_json(F.struct(*KEY_PARTS))))
    if tasks is None:
        # A call is made per group; what the members take besides is reading.
        keyed = materialize(keyed)
        size = keyed.agg(F.count(F.lit(1)).alias("members"), F.approx_count_distinct("_group").alias("groups")).first()
        tasks = max(_tasks(size.groups, batch_size), -(-size.members // MEMBERS_PER_TASK))
    dealt = keyed.repartition(tasks, "_group")
    names = [f.name for f in members.schema.fields if f.name in KEY_PARTS]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        paced = _Pace(rate, tasks)
        group = None  # (id, key values, judge, characters seen, error, tries)

        def ended() -> pd.DataFrame:
            reply, error, tries = (None, group["error"], group["tries"]) if group["error"] else _with_retries(
                lambda: paced(group["judge"].reply), attempts, wait
            )
            return pd.DataFrame([group["key"] | {
                "part": 0, "reply": reply, "error": error, "prompt_chars": group["chars"],
                "response_chars": len(reply or ""), "tries": tries,
            }])

        for frame in frames:
            # Groups come one after the other: cut the frame where the next one begins.
            cuts = frame["_group"].ne(frame["_group"].shift()).to_numpy().nonzero()[0].tolist()
            for start, end in zip(cuts, [*cuts[1:], len(frame)], strict=True):
                part = frame.iloc[start:end].reset_index(drop=True)
                if group is None or group["id"] != part["_group"][0]:
                    if group is not None:
                        yield ended()
                    group = {"id": part["_group"][0], "key": {n: part[n][0] for n in names}, "judge": judge(), "chars": 0, "error": None, "tries": 0}
                if group["error"] is None:
                    shown = part[MEMBER]
                    _, group["error"], group["tries"] = _with_retries(lambda g=group, m=shown: g["judge"].add(m), attempts, wait)
                    group["chars"] += int(shown["description"].fillna("").str.len().sum())
        if group is not None:
            yield ended()

    fields = ", ".join(f"`{n}` {members.schema[n].dataType.simpleString()}" for n in names)
    asked = dealt.sortWithinPartitions("_group", "seq").mapInPandas(run, f"{fields}, part int, {CALL}")
    return _verdicts(asked, log, model)
