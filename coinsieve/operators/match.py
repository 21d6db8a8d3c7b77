"""Ordered first-match categorization by rules and keywords.

Containment in a short list is a constant array, so it is a projection without any
join or shuffle; in a longer one an automaton reads every distinct text once. Similarity is scored once per distinct text: against a short list
in a projection, else through an equi-join on shared pieces of text (see
``functions.similarity``) that finds the same pairs. The result is joined back; that
join is a broadcast while the matched texts are few.

The ratio score runs in Python, on few pairs: those that share enough pairs of neighbouring letters
within a window. Next to a short list that is tested in a projection; else only the rarest
pairs of each shorter text are joined, as many as must meet one that is shared.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from importlib.util import find_spec

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinsieve.functions.similarity import (
    THRESHOLD, check_threshold, letter_pairs, may_reach_ratio, pairs_left, pieces, pieces_col, reaches, required_score,
    within_edits,
)
from coinsieve.functions.text import let, strip
from coinsieve.operators.skew import attach
from coinsieve.session import materialize

# Lists up to this many entries become constants: by containment for each row, by
# similarity for each distinct text.
MAX_INLINE_EXACT = 500
MAX_INLINE = 32  # a long has a bit for each
# Candidate pairs scored in one task.
PAIRS_PER_TASK = 50_000
# Keywords up to so many, and up to so many bytes, go to every worker as one automaton (a few
# hundred bytes a keyword).
AUTOMATON_KEYWORDS, AUTOMATON_BYTES = 200_000, 4 << 20

# Confidence and reason by kind of match.
RULE_EXACT, RULE_FUZZY = 0.95, 0.9
KEYWORD_EXACT, KEYWORD_FUZZY = 1.0, 0.9
RULE_REASON = "Matched custom rule ({} match)"
KEYWORD_REASON = "Matched hardcoded rule ({} match)"

ENTRY_JSON = (
    "array<struct<ord:bigint,raw:string,label:string,word:string,cuts:array<string>,"
    "category:string,amount:double,low:int,high:int,place:bigint>>"
)


def bounded_rows(df: DataFrame, limit: int) -> list[Row] | None:
    """Rows of a table with at most ``limit`` rows, else None."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def _constant(entries: list[dict]) -> Column:
    return F.from_json(F.lit(json.dumps(entries)), ENTRY_JSON)


def _entry(order: int, text: str, category: str, threshold: int, **extra) -> dict:
    word = text.lower().strip()
    cuts = pieces(word, threshold, "edit") if word else []
    return {
        "ord": order, "raw": text.lower(), "label": text, "word": word,
        "cuts": cuts, "category": category, **extra,
    }


def _rule_entries(rows: list[Row], threshold: int) -> list[dict]:
    out = []
    for r in sorted(rows, key=lambda r: r.rule_ord):
        low, high, *_ = [*(r.day_range or []), None, None]
        out.append(_entry(r.rule_ord, r.description or "", r.category, threshold,
                          amount=r.amount, low=low, high=high))
    return out


def _keyword_entries(rows: list[Row], threshold: int) -> list[dict]:
    ordered = sorted(rows, key=lambda r: (r.cat_ord, r.kw_ord))
    return [_entry(r.cat_ord, r.keyword, r.category, threshold) for r in ordered]


def _texts(entries: list[dict] | None = None, threshold: int = THRESHOLD) -> Column:
    """Both texts of a row, as tested: lower-cased, and stripped for similarity.

    Pieces of a text matter only next to longer entries.
    """
    longest = max((len(e["word"]) for e in entries or []), default=0)
    norm = F.lower(F.coalesce(F.col("normalized_desc"), F.lit("")))
    orig = F.lower(F.coalesce(F.col("description"), F.lit("")))
    plain = F.struct(
        norm.alias("norm"), orig.alias("orig"), strip(norm).alias("n"), strip(orig).alias("o")
    )
    if not longest:
        return plain

    def cuts(text: Column) -> Column:
        return F.when(F.length(text) < longest, pieces_col(text, threshold, "edit"))

    return let(
        plain,
        lambda t: F.struct(
            *[t[c].alias(c) for c in ("norm", "orig", "n", "o")],
            cuts(t["n"]).alias("n_cuts"), cuts(t["o"]).alias("o_cuts"),
        ),
    )


def _shares_piece(entry: Column, text: Column, cuts: Column) -> Column:
    """Pre-filter: can the pair reach the threshold at all?"""
    inside = F.exists(entry["cuts"], lambda p: F.contains(text, p))
    around = F.exists(cuts, lambda p: F.contains(entry["word"], p))
    return (
        (F.length(text) > 0)
        & (F.length(entry["word"]) > 0)
        & F.when(F.length(entry["word"]) <= F.length(text), inside).otherwise(around)
    )


def _similar(entry: Column, t: Column, threshold: int) -> Column:
    """Edit similarity of an entry to either text."""
    need = required_score(entry["word"], threshold)

    def near(text: Column, cuts: Column) -> Column:
        return _shares_piece(entry, text, cuts) & (
            F.contains(text, entry["word"])
            | within_edits(entry["word"], text, need)
        )

    return near(t["n"], t["n_cuts"]) | near(t["o"], t["o_cuts"])


def _contained(name: Column, t: Column) -> Column:
    return F.contains(t["norm"], name) | F.contains(t["orig"], name)


def _result(category: Column, exact: Column, sure: float, near: float, reason: str) -> Column:
    kind = F.when(exact, "exact").otherwise("fuzzy")
    return F.struct(
        category.alias("category"),
        F.when(exact, F.lit(sure)).otherwise(F.lit(near)).alias("confidence"),
        F.format_string(reason.replace("{}", "%s"), kind).alias("reasoning"),
        kind.alias("match_type"),
    )


def _keyword_result(hit: Column, exact: Column) -> Column:
    return F.when(
        hit.isNotNull(),
        _result(hit["category"], exact, KEYWORD_EXACT, KEYWORD_FUZZY, KEYWORD_REASON),
    )


def _lowered() -> dict[str, Column]:
    return {c: F.lower(F.coalesce(F.col(c), F.lit(""))) for c in ("normalized_desc", "description")}


def _text_key(norm: Column, orig: Column) -> Column:
    return F.md5(F.concat_ws("\u0001", norm, orig))


def _with_text_key(df: DataFrame) -> DataFrame:
    """Key of the pair of texts a row is matched by."""
    return df.withColumn("text_key", _text_key(*_lowered().values()))


def _if(undecided: Column | None, value: Column) -> Column:
    return value if undecided is None else F.when(undecided, value)


def _distinct_texts(df: DataFrame, undecided: Column | None = None) -> DataFrame:
    """One row per pair of texts, written once: matching reads them repeatedly
    and should not go through all rows each time."""
    rows = df if undecided is None else df.filter(undecided)
    texts = rows.select(*[col.alias(name) for name, col in _lowered().items()]).distinct()
    return materialize(texts.withColumn("text_key", _text_key(F.col("normalized_desc"), F.col("description"))))


def _join_back(keyed: DataFrame, found: DataFrame) -> DataFrame:
    """Results per text, joined to the rows with that text."""
    return attach(keyed, materialize(found), "text_key", "txn_id", "left").drop("text_key")


# --- rules -----------------------------------------------------------------


def match_rules(
    txns: DataFrame,
    rules: DataFrame,
    threshold: int = THRESHOLD,
    matcher: str = "ratio",
    raw_label: bool = False,
    max_inline: int = MAX_INLINE,
    undecided: Column | None = None,
) -> DataFrame:
    """Add ``rule_match``: result of the first rule whose text, amount and day
    range fit, NULL when none does. ``raw_label=True`` calls a match exact only
    when the rule text occurs with its own capitals. Only ``undecided`` rows are
    looked at, all by default.

    Texts are matched once each. Of a short list, a row gets the bits of the rules its
    text matches; bits of the rules that fit its amount and its day are constants,
    and the lowest common bit is the first rule. Of a long list, texts that match the same rules
    share a profile, and rows look their rule up by profile, amount and day.
    """
    check_threshold(threshold)
    rows = bounded_rows(rules, max_inline)
    keyed, texts = _with_text_key(txns), _distinct_texts(txns, undecided)
    listed = rules.select(
        F.col("rule_ord").alias("ord"),
        F.lower("description").alias("raw"), F.col("description").alias("label"),
        strip(F.lower("description")).alias("word"), "category", "amount",
        F.get("day_range", F.lit(0)).alias("low"), F.get("day_range", F.lit(1)).alias("high"),
    )
    if rows is not None and matcher == "edit":
        entries = _rule_entries(rows, threshold)
        hits = _edit_rule_bits(texts, entries, threshold, raw_label)
    else:
        pairs = similar_pairs(texts, listed, threshold, matcher, max_inline=max_inline)
        exact = F.contains("whole", "label") if raw_label else F.col("exact")
        hits = pairs.groupBy("text_key", "ord").agg(F.max(exact).alias("exact"))
        if rows is not None:
            entries = _rule_entries(rows, threshold)
            hits = _as_bits(hits, entries)
    if rows is None:
        found = _match_by_profile(keyed, hits, listed)
    else:
        found = _join_back(keyed, hits).withColumn("_rule", _first_rule(entries)).drop("hits", "exacts")
    hit = F.col("_rule")
    result = F.when(hit.isNotNull(), _result(hit["category"], hit["exact"], RULE_EXACT, RULE_FUZZY, RULE_REASON))
    return found.withColumn("rule_match", _if(undecided, result)).drop("_rule")


def _edit_rule_bits(texts: DataFrame, entries: list[dict], threshold: int, raw_label: bool) -> DataFrame:
    """(text_key, hits, exacts): bits of the rules of a short list that each text matches."""
    table = _constant([e | {"place": 1 << i} for i, e in enumerate(entries)])

    def bits(near: Column) -> Column:
        return F.aggregate(near, F.lit(0).cast("bigint"), lambda all_, r: all_.bitwiseOR(r["place"]))

    def both(t: Column) -> Column:
        def masks(near: Column) -> Column:
            exact = F.filter(near, lambda r: _contained(r["label"] if raw_label else r["raw"], t))
            return F.struct(bits(near).alias("hits"), bits(exact).alias("exacts"))

        return let(F.filter(table, lambda r: _similar(r, t, threshold)), masks)

    near = let(_texts(entries, threshold), both)
    return texts.select("text_key", near.alias("m")).select("text_key", "m.*").filter("hits <> 0")


def _as_bits(hits: DataFrame, entries: list[dict]) -> DataFrame:
    """(text_key, hits, exacts) from (text_key, ord, exact) of a short list."""
    place = F.lit(None).cast("bigint")
    for i, e in enumerate(entries):
        place = F.when(F.col("ord") == e["ord"], F.lit(1 << i)).otherwise(place)
    bits = hits.withColumn("place", place.cast("bigint"))
    return bits.groupBy("text_key").agg(
        F.bit_or("place").alias("hits"), F.bit_or(F.when(F.col("exact"), F.col("place")).otherwise(F.lit(0))).alias("exacts")
    )


def _days(low: int | None, high: int | None) -> list[int]:
    """The days of a month that a range holds; 0 stands for a row without date."""
    return list(range(32)) if low is None or high is None else [d for d in range(1, 32) if low <= d <= high]


def _first_rule(entries: list[dict]) -> Column:
    """(category, exact) of the first rule among the bits ``hits`` that fits amount and day."""
    by_day, free = [0] * 32, 0
    by_amount: dict[float, int] = {}
    for i, e in enumerate(entries):
        for day in _days(e["low"], e["high"]):
            by_day[day] |= 1 << i
        if e["amount"] is None:
            free |= 1 << i
        else:
            by_amount[e["amount"]] = by_amount.get(e["amount"], 0) | 1 << i
    of_amount = F.lit(free).cast("bigint")
    for amount, mask in by_amount.items():
        of_amount = F.when(F.col("amount") == amount, F.lit(free | mask).cast("bigint")).otherwise(of_amount)
    of_day = F.get(F.array(*[F.lit(m).cast("bigint") for m in by_day]), F.coalesce(F.dayofmonth("date"), F.lit(0)))
    fits = F.col("hits").bitwiseAND(of_amount).bitwiseAND(of_day)
    lowest = fits.bitwiseAND(-fits)
    category = F.get(F.array(*[F.lit(e["category"]) for e in entries] or [F.lit(None).cast("string")]), F.bit_count(lowest - 1))
    exact = F.col("exacts").bitwiseAND(lowest) != 0
    return F.when(fits != 0, F.struct(category.alias("category"), exact.alias("exact")))


def _match_by_profile(keyed: DataFrame, hits: DataFrame, listed: DataFrame) -> DataFrame:
    """Add ``_rule``: ord, category and exact of the first rule of (text_key, ord, exact) that
    fits a row's amount and day.

    A profile is the list of rules that a text matches; there are as many as different
    lists. For each, the first rule is worked out for every day, and for every
    amount that its rules name and day.
    """
    per_text = hits.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("ord", "exact"))).alias("list"))
    per_text = materialize(per_text.withColumn("profile", F.md5(F.to_json("list"))))
    members = per_text.groupBy("profile").agg(F.first("list").alias("list")).select("profile", F.explode("list").alias("m")).select("profile", "m.*")
    every = F.col("low").isNull() | F.col("high").isNull()
    days = F.when(every, F.sequence(F.lit(0), F.lit(31))).otherwise(
        F.filter(F.sequence(F.lit(1), F.lit(31)), lambda d: d.between(F.col("low"), F.col("high")))
    )
    index = attach(members, listed.select("ord", "category", "amount", "low", "high"), "ord", ["profile", "ord"], "inner").select(
        "profile", F.col("amount").alias("_amount"), F.explode(days).alias("_day"), F.struct("ord", "category", "exact").alias("rule")
    )
    index = materialize(index.groupBy("profile", "_amount", "_day").agg(F.min("rule").alias("rule")))
    named = index.filter("_amount IS NOT NULL").withColumnRenamed("rule", "_named")
    free = index.filter("_amount IS NULL").drop("_amount").withColumnRenamed("rule", "_free")
    placed = attach(keyed, per_text.select("text_key", "profile"), "text_key", "txn_id", "left").withColumns(
        {"_day": F.coalesce(F.dayofmonth("date"), F.lit(0)), "_amount": F.col("amount")}
    )
    found = attach(attach(placed, named, ["profile", "_amount", "_day"], "txn_id", "left"), free, ["profile", "_day"], "txn_id", "left")
    return found.withColumn("_rule", F.least("_named", "_free")).drop("text_key", "profile", "_amount", "_day", "_named", "_free")


# --- keywords --------------------------------------------------------------


def match_keywords_exact(
    txns: DataFrame, keywords: DataFrame, max_inline: int = MAX_INLINE_EXACT
) -> DataFrame:
    """Add ``keyword_match`` by containment only: the first category with a
    keyword inside either text."""
    rows = bounded_rows(keywords, max_inline)
    if rows is None:
        return _match_many_keywords(txns, keywords, exact_only=True)
    table = _constant(_keyword_entries(rows, THRESHOLD))

    def pick(t: Column) -> Column:
        first = F.get(F.filter(table, lambda k: _contained(k["raw"], t)), F.lit(0))
        return let(first, lambda k: _keyword_result(k, F.lit(True)))

    return txns.withColumn("keyword_match", let(_texts(), pick))


def match_keywords(
    txns: DataFrame,
    keywords: DataFrame,
    threshold: int = THRESHOLD,
    matcher: str = "ratio",
    max_inline: int = MAX_INLINE,
    undecided: Column | None = None,
) -> DataFrame:
    """Add ``keyword_match``: within each category in order, containment and
    then similarity, so a similar keyword of an earlier category wins over a
    contained keyword of a later one. Only ``undecided`` rows are looked at, all
    by default."""
    check_threshold(threshold)
    rows = bounded_rows(keywords, max_inline) if matcher == "edit" else None
    if rows is None:
        return _match_many_keywords(txns, keywords, threshold, matcher, undecided=undecided, max_inline=max_inline)
    entries = _keyword_entries(rows, threshold)
    table = _constant(entries)

    def pick(t: Column) -> Column:
        def with_exact(e: Column) -> Column:
            near = F.filter(
                table, lambda k: (e.isNull() | (k["ord"] < e["ord"])) & _similar(k, t, threshold)
            )
            return let(
                F.get(near, F.lit(0)), lambda k: _keyword_result(F.coalesce(k, e), k.isNull())
            )

        exact = F.get(F.filter(table, lambda k: _contained(k["raw"], t)), F.lit(0))
        return let(exact, with_exact)

    found = _distinct_texts(txns, undecided).select(
        "text_key", let(_texts(entries, threshold), pick).alias("keyword_match")
    )
    joined = _join_back(_with_text_key(txns), found.filter("keyword_match IS NOT NULL"))
    return joined.withColumn("keyword_match", _if(undecided, F.col("keyword_match")))


def _match_many_keywords(
    txns: DataFrame, keywords: DataFrame, threshold: int = THRESHOLD, matcher: str = "edit",
    exact_only: bool = False, undecided: Column | None = None, max_inline: int = MAX_INLINE,
) -> DataFrame:
    listed = keywords.select(
        F.struct("cat_ord", "kw_ord").alias("ord"),
        F.lower("keyword").alias("raw"), strip(F.lower("keyword")).alias("word"), "category",
    )
    keyed, texts = _with_text_key(txns), _distinct_texts(txns, undecided)
    best = _first_contained(texts, listed) if exact_only else None
    if best is None:
        best = _best_of_pairs(texts, listed, threshold, matcher, exact_only, max_inline)
    result = _keyword_result(F.col("best"), F.col("best.rank") == 0).alias("keyword_match")
    joined = _join_back(keyed, best.select("text_key", result))
    return joined.withColumn("keyword_match", _if(undecided, F.col("keyword_match")))


def _best_of_pairs(
    texts: DataFrame, listed: DataFrame, threshold: int, matcher: str, exact_only: bool, max_inline: int
) -> DataFrame:
    """(text_key, best) from all pairs of texts and keywords that match."""
    pairs = similar_pairs(texts, listed, threshold, matcher, exact_only, F.col("ord.cat_ord"), max_inline).select(
        "text_key", "ord", "exact", "category"
    )
    blank = _blank_entries(listed)
    if blank is not None:
        pairs = pairs.unionByName(_blank_pairs(texts, blank))
    return pairs.groupBy("text_key").agg(
        F.min(
            F.struct(
                F.col("ord.cat_ord"), F.when(F.col("exact"), 0).otherwise(1).alias("rank"),
                F.col("ord.kw_ord"), "category",
            )
        ).alias("best")
    )


def _blank_entries(listed: DataFrame) -> DataFrame | None:
    """The first entry of each text that is empty or only blanks: such texts are
    contained in others as they are, and have no pieces."""
    blank = listed.filter("word = ''").groupBy("raw").agg(F.min_by(F.struct("ord", "category"), "ord").alias("e"))
    blank = materialize(blank.select("raw", "e.*"))
    return None if blank.isEmpty() else blank


def _blank_pairs(texts: DataFrame, blank: DataFrame) -> DataFrame:
    """Blank entries are one value that every text is tested against: no join."""
    entries = blank.agg(F.collect_list(F.struct("raw", "ord", "category")).alias("entries")).scalar()
    wholes = texts.select("text_key", F.explode(F.array("normalized_desc", "description")).alias("whole"))
    tested = wholes.select("*", F.explode(entries).alias("e")).filter(F.contains("whole", "e.raw"))
    return tested.select("text_key", "e.ord", F.lit(True).alias("exact"), "e.category")


# --- containment in long lists --------------------------------------------------------


def _first_contained(texts: DataFrame, listed: DataFrame) -> DataFrame | None:
    """(text_key, best): the first category, and its first keyword, with a keyword inside either text.

    All keywords form one automaton, which every Python worker builds once and which
    reads each text once. None where the keywords are too large for that.
    """
    firsts = materialize(
        listed.groupBy("raw").agg(F.min(F.struct("ord.cat_ord", "ord.kw_ord", "category")).alias("first")).select("raw", "first.*")
    )
    size = firsts.agg(F.sum(F.octet_length("raw") + F.octet_length("category")).alias("b"), F.count(F.lit(1)).alias("n")).first()
    if (size.b or 0) > AUTOMATON_BYTES or size.n > AUTOMATON_KEYWORDS or find_spec("ahocorasick") is None:
        return None
    ordered = sorted((r.cat_ord, r.kw_ord, r.raw, r.category) for r in firsts.collect() if r.raw is not None)
    result = "text_key string, cat_ord int, rank int, kw_ord int, category string"
    names = [part.split(" ")[0] for part in result.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_of = _automaton(ordered)
        for batch in batches:
            keys, *sides = (column.to_pylist() for column in batch.columns)
            found = [(key, best) for key, *pair in zip(keys, *sides, strict=True) if (best := first_of(pair)) is not None]
            hits = [(key, ordered[i][0], 0, ordered[i][1], ordered[i][3]) for key, i in found]
            columns = list(zip(*hits, strict=True)) if hits else [[]] * len(names)
            types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    hits = texts.select("text_key", "normalized_desc", "description").mapInArrow(run, result)
    return hits.select("text_key", F.struct("cat_ord", "rank", "kw_ord", "category").alias("best"))


def _automaton(ordered: list[tuple]) -> Callable[[list[str]], int | None]:
    """The smallest place in ``ordered`` of a keyword inside one of some texts."""
    import ahocorasick

    words = ahocorasick.Automaton()
    for i, (_, _, raw, _) in enumerate(ordered):
        if raw:
            words.add_word(raw, i)
    words.make_automaton()
    empty = next((i for i, entry in enumerate(ordered) if entry[2] == ""), None)

    def first(texts: list[str]) -> int | None:
        hits = [i for text in set(texts) for _, i in words.iter(text)] if len(words) else []
        if empty is not None:
            hits.append(empty)
        return min(hits, default=None)

    return first


# --- pairs of similar texts ---------------------------------------------------


def _grams(df: DataFrame, key: list[str], text: str, cut: DataFrame) -> DataFrame:
    """(key, size, gram): one row per distinct substring of the piece lengths that
    ``cut`` uses, which are a handful of small numbers."""
    sizes = cut.select(F.explode(F.transform("cuts", F.length)).alias("n")).distinct()
    listed = sizes.agg(F.sort_array(F.collect_list("n")).alias("ns")).scalar()
    starts = F.sequence(F.lit(1), F.length(text) - F.col("_n") + 1)
    grams = F.array_distinct(F.transform(starts, lambda i: F.substring(F.col(text), i, F.col("_n"))))
    return (
        df.withColumn("_n", F.explode(listed))
        .filter(F.length(text) >= F.col("_n"))
        .select(*key, F.length(text).alias("size"), F.explode(grams).alias("gram"))
    )


def _cuts(df: DataFrame, key: list[str], text: str) -> DataFrame:
    return df.select(*key, F.length(text).alias("size"), F.explode(F.array_distinct("cuts")).alias("gram"))


def _piece_candidates(text: DataFrame, words: DataFrame, threshold: int, exact_only: bool) -> DataFrame:
    """(text_key, side, entry) of pairs that share a piece."""
    text_id = ["text_key", "side"]
    share = F.array("word") if exact_only else pieces_col(F.col("word"), threshold, "edit")
    cut_words = words.withColumn("cuts", share)

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        return attach(left, right.withColumnRenamed("size", "other"), "gram", text_id, "inner")

    found = meet(_grams(text, text_id, "text", cut_words), _cuts(cut_words, ["entry"], "word")).filter("other <= size")
    if not exact_only:
        cut_texts = text.withColumn("cuts", pieces_col(F.col("text"), threshold, "edit"))
        around = meet(_cuts(cut_texts, text_id, "text"), _grams(words, ["entry"], "word", cut_texts))
        found = found.select(*text_id, "entry").unionByName(around.filter("other > size").select(*text_id, "entry"))
    return found.select(*text_id, "entry").distinct()


def _rarest_pairs(short: DataFrame, key: list[str], text: str, postings: DataFrame, threshold: int) -> DataFrame:
    """(key, size, gram): of the pairs of letters of each text, so many of the rarest among
    ``postings`` that one of them is shared wherever enough are."""
    need = pairs_left(F.length(text), threshold)
    listed = short.select(*key, F.length(text).alias("size"), need.alias("need"), F.explode(letter_pairs(F.col(text))).alias("gram"))
    counts = materialize(postings.groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
    ranked = attach(listed, counts, "gram", key, "left").groupBy(*key, "size", "need").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))).alias("grams")
    )
    first = F.array_distinct(F.slice(F.col("grams.gram"), F.lit(1), F.col("size") - F.col("need")))
    return ranked.select(*key, "size", F.explode(first).alias("gram"))


def _ratio_candidates(text: DataFrame, words: DataFrame, threshold: int) -> DataFrame:
    """(text_key, side, entry) of pairs that share pairs of letters, or, where the shorter
    text is too short for that, a piece."""
    text_id = ["text_key", "side"]

    def split(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        enough = pairs_left(F.length(name), threshold) > 0
        return df.filter(enough), df.filter(~enough)

    def postings(df: DataFrame, key: list[str], name: str) -> DataFrame:
        grams = df.filter(F.length(name) > 1).select(*key, F.length(name).alias("other"), F.explode(F.array_distinct(letter_pairs(F.col(name)))).alias("gram"))
        return materialize(grams)

    (long_words, tiny_words), (long_texts, tiny_texts) = split(words, "word"), split(text, "text")
    in_texts, in_words = postings(text, text_id, "text"), postings(words, ["entry"], "word")
    found = [
        attach(in_texts, _rarest_pairs(long_words, ["entry"], "word", in_texts, threshold), "gram", text_id, "inner").filter("size <= other"),
        attach(_rarest_pairs(long_texts, text_id, "text", in_words, threshold), in_words, "gram", text_id, "inner").filter("size < other"),
    ]
    cut_words = tiny_words.withColumn("cuts", pieces_col(F.col("word"), threshold, "ratio"))
    if not cut_words.isEmpty():
        pieces_met = attach(_grams(text, text_id, "text", cut_words), _cuts(cut_words, ["entry"], "word").withColumnRenamed("size", "other"), "gram", text_id, "inner")
        found.append(pieces_met.filter("other <= size"))
    cut_texts = tiny_texts.withColumn("cuts", pieces_col(F.col("text"), threshold, "ratio"))
    if not cut_texts.isEmpty():
        pieces_met = attach(_cuts(cut_texts, text_id, "text"), _grams(words, ["entry"], "word", cut_texts).withColumnRenamed("size", "other"), "gram", text_id, "inner")
        found.append(pieces_met.filter("size < other"))
    pairs = found[0].select(*text_id, "entry")
    for more in found[1:]:
        pairs = pairs.unionByName(more.select(*text_id, "entry"))
    return pairs.distinct()


def _scored_by_ratio(checked: DataFrame, threshold: int) -> DataFrame:
    """Of (word, text, exact, ...) those that match; scored in tasks by the number of pairs,
    as scoring takes long for few bytes."""
    sure = F.col("exact") | F.contains("text", "word")
    left = materialize(checked.withColumn("_sure", sure).filter(F.col("_sure") | may_reach_ratio(F.col("word"), F.col("text"), threshold)))
    tasks = -(-left.count() // PAIRS_PER_TASK)
    need = F.when(F.col("_sure"), F.lit(0)).otherwise(required_score(F.col("word"), threshold))
    spread = left.repartition(max(1, tasks), "text_key", "word").withColumn("_need", need)
    return spread.filter(reaches(F.col("word"), F.col("text"), F.col("_need"), "ratio")).drop("_need", "_sure")


def _inline_ratio_pairs(texts: DataFrame, entries: DataFrame, rows: list[Row], threshold: int) -> DataFrame:
    """``similar_pairs`` by ratio next to a short list: no join."""
    listed = [r.asDict(recursive=True) for r in rows if r.word]
    table = F.from_json(F.lit(json.dumps(listed)), T.ArrayType(entries.schema))
    wholes = F.explode(F.array_distinct(F.array("normalized_desc", "description")))
    sides = texts.select("text_key", wholes.alias("whole")).withColumn("text", strip(F.col("whole"))).filter("text <> ''")
    near = F.filter(table, lambda e: F.contains(F.col("whole"), e["raw"]) | may_reach_ratio(e["word"], F.col("text"), threshold))
    pairs = sides.select("*", F.explode(near).alias("_entry")).select(*sides.columns, "_entry.*")
    return _scored_by_ratio(pairs.withColumn("exact", F.contains("whole", "raw")), threshold)


def similar_pairs(
    texts: DataFrame,
    entries: DataFrame,
    threshold: int,
    matcher: str,
    exact_only: bool = False,
    tier: Column | None = None,
    max_inline: int = MAX_INLINE,
) -> DataFrame:
    """All (text_key, entry) pairs that match, without comparing every pair.

    The shorter text of a pair is cut into pieces, the longer one into grams of
    the piece lengths; a piece that equals a gram makes the pair a candidate.
    No pair at or above the threshold is missed. For containment alone the word
    is one piece. With a ``tier`` of the entries, similarity is tested only in
    tiers before the first one with a contained entry, as no other can win.

    Only keys and grams are shuffled to find candidates; the texts are fetched for
    the pairs that are left.
    """
    check_threshold(threshold)
    by_ratio = matcher == "ratio" and not exact_only
    rows = bounded_rows(entries, max_inline) if by_ratio else None
    if rows is not None:
        return _inline_ratio_pairs(texts, entries, rows, threshold)
    sides = F.posexplode(F.array_distinct(F.array("normalized_desc", "description"))).alias("side", "whole")
    text = materialize(texts.select("text_key", sides).withColumn("text", strip(F.col("whole"))).filter("text <> ''"))
    words = materialize(entries.filter("word <> ''").withColumn("entry", F.monotonically_increasing_id()))
    text_id = ["text_key", "side"]
    candidates = materialize(
        _ratio_candidates(text, words, threshold) if by_ratio else _piece_candidates(text, words, threshold, exact_only)
    )
    checked = attach(attach(candidates, words, "entry", text_id, "inner"), text, text_id, "entry", "inner").withColumn(
        "exact", F.contains("whole", "raw")
    )
    if exact_only:
        return checked.filter("exact").drop("entry", "side")
    if tier is not None:
        first = materialize(checked.filter("exact").groupBy("text_key").agg(F.min(tier).alias("_first")))
        checked = (
            attach(checked, first, "text_key", ["text_key", "side", "entry"], "left")
            .filter(F.col("exact") | F.col("_first").isNull() | (tier < F.col("_first")))
            .drop("_first")
        )
    if by_ratio:
        return _scored_by_ratio(checked, threshold).drop("entry", "side")
    # An entry with blanks at its ends may be contained only without them; that
    # is a similarity match, as for any other inexact hit.
    need = F.when(F.col("exact") | F.contains("text", "word"), F.lit(0)).otherwise(
        required_score(F.col("word"), threshold)
    )
    return checked.withColumn("_need", need).filter(
        reaches(F.col("word"), F.col("text"), F.col("_need"), matcher)
    ).drop("_need", "entry", "side")
