"""Toxicity of whole texts, judged after noisy-channel deobfuscation.

A token that may hide a word (digits or signs among letters, letters repeated three
times or more, single letters set apart) becomes a lattice: each written character
stands for some letters, or for nothing, at a cost. Viterbi decoding under a
character trigram model of the whole corpus gives the likeliest spelling. The words
of the text and the restored ones, and their beginnings, are its features.

A feature's weight is the log odds of its document counts over all labelled rows of
three folds; features that are not far from zero in standard deviations are left out.
What a document meets of them goes through a logistic curve that is fitted on rows of
a fourth fold, whose labels the weights have not met.

Cases: a null or empty text has no features and gets the score of such a text. Rows
without doc_id are scored and never used for training. Labels that are null do not
count; of several labels of one document the largest does. Without labels of both
kinds every score is 0. Repeated rows get equal scores. Other columns pass through;
names that start with ``_tx_`` are used inside.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinsieve.llm import flat

# What a written character can stand for besides itself.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "*": "aeiou", "#": "aeiou", "%": "aeiou", "€": "e",
}
SEPARATORS = " .-_/*~,"

# Natural logarithms of the channel: replace a sign, drop a separator or sign, drop a repeat,
# keep a repeat, begin a new word inside letters set apart.
REPLACE, DROP_SIGN, DROP_REPEAT, KEEP_REPEAT, NEW_WORD = -1.0, -4.0, -0.2, -1.5, -4.0

LETTERS = 60  # 0 no letter, 1-26 a-z, 27-58 U+00E0 to U+00FF, 59 other letters
PREFIX = 4

# Model size: the strongest features by significance. Standard deviations a weight must be off zero.
MAX_FEATURES = 50_000
LEAST_Z = 2.6
# Rows that the logistic curve is fitted on, about, at most.
CURVE_ROWS = 20_000
# Labels up to this number are broadcast to the scan of the documents.
BROADCAST_LABELS = 2_000_000

WORD = re.compile(r"[^\W\d_]+")
HINT = re.compile(r"[^\W\d_][0-9@$!|+(*#%€]|[0-9@$|+(*#%€][^\W\d_]")
# Signs and digits without any letter: a sign inside, or two in a row.
SIGNS_ALONE = re.compile(r"^[0-9@$!|+(*#%€]*(?:[0-9@$!|+(*#%€][@$!|+(*#%€][0-9@$!|+(*#%€]|[@$!|+(*#%€]{2})[0-9@$!|+(*#%€]*$")
SIGN = re.compile(r"[0-9@$!|+(*#%€]")
REPEATED = re.compile(r"([^\W\d_])\1\1")
APART_HINT = re.compile(r"\s[\w@$!|+][ .\-_/*~,][\w@$!|+][ .\-_/*~,][\w@$!|+]")
APART = re.compile(r"(?<!\S)(?:[\w@$!|+][ .\-_/*~,]){2,}[\w@$!|+](?![^\s.,;:?!])")
ENDS = re.compile(r"^[\"'.,;:?!)\]}<>=&-]+|[\"'.,;:?!)\]}<>=&-]+$")
PILE = re.compile(r"([^\w\s])\1{2,}")


def letter_numbers(points: np.ndarray) -> np.ndarray:
    out = np.zeros(len(points), np.int64)
    upper = (points >= 65) & (points <= 90)
    out = np.where(upper, points - 64, out)
    out = np.where((points >= 97) & (points <= 122), points - 96, out)
    out = np.where((points >= 0xC0) & (points <= 0xDE) & (points != 0xD7), points - 0xC0 + 27, out)
    out = np.where((points >= 0xDF) & (points <= 0xFF) & (points != 0xF7), points - 0xE0 + 27, out)
    out = np.where(points == 0xDF, 58, out)
    return np.where(points >= 0x100, LETTERS - 1, out)


@cache
def letter_number(char: str) -> int:
    return int(letter_numbers(np.array([ord(char)]))[0])


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(gram, n): character trigrams of all texts, letters in lower case."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS**3, np.int64)
        for batch in batches:
            for _, _, data, at in flat.chunks(batch):
                points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
                number = np.r_[0, 0, letter_numbers(points.astype(np.int64)), 0]
                gram = (number[:-2] * LETTERS + number[1:-1]) * LETTERS + number[2:]
                total += np.bincount(gram, minlength=LETTERS**3)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["gram", "n"])

    return docs.select("text").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def character_model(docs: DataFrame) -> np.ndarray:
    """log P(third letter | first two); the counts are at most LETTERS ** 3 rows."""
    counts = np.zeros(LETTERS**3)
    for row in trigram_counts(docs).collect():
        counts[row.gram] = row.n
    three = counts.reshape(LETTERS, LETTERS, LETTERS)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    base = (one + 1) / (one + 1).sum()
    second = (two + 8 * base) / (two.sum(axis=1, keepdims=True) + 8)
    third = (three + 8 * second[None]) / (three.sum(axis=2, keepdims=True) + 8)
    return np.log(third).astype(np.float32)


class Restorer:
    """Viterbi decoding of single tokens; remembers their spellings."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self.known: dict[tuple[str, bool], str] = {}

    def options(self, token: str, i: int, apart: bool) -> list[tuple[str, float]]:
        """What character i can stand for: (letter or nothing, cost)."""
        char = token[i]
        if char.isalpha():
            if i and token[i - 1] == char and not apart:
                return [("", DROP_REPEAT), (char, KEEP_REPEAT)]
            return [(char, 0.0)]
        if char in SEPARATORS and char not in SIGNS:
            return [("", 0.0)]
        dropped = 0.0 if apart and char in SEPARATORS else DROP_SIGN
        return [(c, REPLACE) for c in SIGNS.get(char, "")] + [("", dropped)]

    def restore(self, token: str, apart: bool = False) -> str:
        """The likeliest spelling, words separated by one space."""
        if (token, apart) in self.known:
            return self.known[token, apart]
        # State: the last two letters; value: score and the text so far.
        states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        for i in range(len(token)):
            following: dict[tuple[int, int], tuple[float, str]] = {}

            def offer(key: tuple[int, int], score: float, text: str, into: dict = following) -> None:
                if key not in into or score > into[key][0]:
                    into[key] = (score, text)

            for letter, cost in self.options(token, i, apart):
                number = letter_number(letter) if letter else -1
                for (a, b), (score, text) in states.items():
                    if number < 0:
                        offer((a, b), score + cost, text)
                        continue
                    offer((b, number), score + cost + self.model[a][b][number], text + letter)
                    if apart and text and b:
                        ended = score + cost + NEW_WORD + self.model[a][b][0] + self.model[b][0][number]
                        offer((0, number), ended, f"{text} {letter}")
            states = following
        best = max(((s + self.model[a][b][0], t) for (a, b), (s, t) in states.items()), default=(0.0, ""))[1]
        if len(self.known) > 100_000:
            self.known = {}
        self.known[token, apart] = best
        return best

    def words(self, text: str) -> set[str]:
        """The distinct words of a text, as written and as restored."""
        text = text.lower()
        found = set(WORD.findall(text))
        restored: set[str] = set()
        if SIGN.search(text):
            for token in set(text.split()):
                if SIGN.search(token):
                    core = ENDS.sub("", PILE.sub("", ENDS.sub("", token)))
                    if not core.isalpha() and (HINT.search(core) or SIGNS_ALONE.search(core)):
                        restored.add(self.restore(core))
        if REPEATED.search(text):
            restored.update([self.restore(w) for w in found if REPEATED.search(w)])
        if APART_HINT.search(" " + text):
            for match in APART.finditer(text):
                restored.add(self.restore(match.group(0), True))
        for spelling in restored:
            found.update(spelling.split())
        return found


def features(words: set[str]) -> set[str]:
    """Words and their beginnings; a whole word counts apart from an equal beginning."""
    out = {w + "$" for w in words}
    out.update([w[:PREFIX] for w in words if len(w) > PREFIX])
    return out


def fold(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, y, fold) of the training rows: those whose fold is not 0."""
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("y"))
        .filter("doc_id IS NOT NULL AND y IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .filter(fold(F.col("doc_id")) != 0)
    )
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    return rows.join(known, "doc_id").select("text", "y", fold(F.col("doc_id")).cast("int").alias("fold"), "doc_id")


def feature_counts(rows: DataFrame, model) -> DataFrame:
    """(feature, toxic, clean): training documents that hold it, added up per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.value)
        for batch in batches:
            counts: tuple[Counter, Counter] = Counter(), Counter()
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[1 if y else 0].update(features(restorer.words(text or "")))
            names = list({**counts[0], **counts[1]})
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *[pa.array([c[n] for n in names], pa.int64()) for c in (counts[1], counts[0])]],
                names=["feature", "toxic", "clean"],
            )

    return (
        rows.select("text", "y").mapInArrow(run, "feature string, toxic bigint, clean bigint")
        .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def weights(rows: DataFrame, model) -> dict[str, tuple[float, float]]:
    """The features that speak for toxicity: log odds, and those in standard deviations."""
    sizes = {r.y: r.n for r in rows.groupBy(F.expr("CASE WHEN y > 0 THEN 1 ELSE 0 END").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return {}
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    weight = F.log(a / (sizes[1] + 1.0)) - F.log(b / (sizes[0] + 1.0))
    strong = (
        feature_counts(rows, model)
        .withColumn("w", weight)
        .withColumn("z", F.col("w") / F.sqrt(1 / a + 1 / b))
        .filter(F.col("z") >= LEAST_Z)
        .orderBy(F.desc("z"), "feature")
        .limit(MAX_FEATURES)
    )
    return {r.feature: (r.w, r.z) for r in strong.select("feature", "w", "z").collect()}


def measures(restorer: Restorer, weight: dict[str, tuple[float, float]], text: str | None) -> tuple[float, ...]:
    """Of the features met: sum of log odds, largest significance, number; number of all features."""
    held = features(restorer.words(text or "")) if weight else set()
    met = [weight[f] for f in weight.keys() & held]
    total = math.fsum([w for w, _ in met])
    return math.log1p(total), max([z for _, z in met], default=0.0), math.log1p(len(met)), math.log1p(len(held) + 10)


def curve(rows: list) -> list[float]:
    """Logistic coefficients for (1, measures), by Newton steps with a small ridge."""
    y = np.array([1.0 if r.y else 0.0 for r in rows])
    if not len(y) or y.min() == y.max():
        return []
    x = np.array([[1.0, *r.x] for r in rows])
    beta, ridge = np.zeros(x.shape[1]), np.r_[0.01, np.full(x.shape[1] - 1, 0.1)]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + np.diag(ridge)
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * beta)
        beta += step
        if abs(step).max() < 1e-9:
            break
    return beta.tolist()


class Scorer:
    """A trained model: character model, weights and curve, as broadcast values."""

    def __init__(self, docs: DataFrame, labels: DataFrame):
        context = docs.sparkSession.sparkContext
        self.model = context.broadcast(character_model(docs.select(F.col("text").cast("string").alias("text"))))
        rows = labelled(docs, labels)
        self.weight = context.broadcast(weights(rows.filter("fold <> 4"), self.model))
        self.beta = self._fit(rows.filter("fold = 4"), self.weight) or self._fit(rows, self.weight)

    def _fit(self, rows: DataFrame, weight) -> list[float]:
        model = self.model

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            restorer = Restorer(model.value)
            for batch in batches:
                made = [measures(restorer, weight.value, t) for t in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1), pa.array(made, pa.list_(pa.float64()))], names=["y", "x"]
                )

        # About CURVE_ROWS rows by a hash of their number, drawn where they are.
        share = min(1.0, CURVE_ROWS / max(1, rows.count()))
        sample = rows.filter(F.pmod(F.xxhash64(F.lit("curve"), "doc_id"), F.lit(1 << 30)) < math.ceil(share * (1 << 30)))
        return curve(sample.select("text", "y").mapInArrow(run, "y int, x array<double>").collect())

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``_tx_score`` (0 to 1)."""
        model, weight, beta = self.model, self.weight, self.beta
        columns = docs.columns
        schema = T.StructType([*docs.schema.fields, T.StructField("_tx_score", T.DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            restorer = Restorer(model.value)
            for batch in batches:
                scores = []
                texts = batch.column(len(columns))
                for i in range(batch.num_rows):
                    if not beta:
                        scores.append(0.0)
                        continue
                    x = measures(restorer, weight.value, texts[i].as_py())
                    line = beta[0] + sum(b * v for b, v in zip(beta[1:], x, strict=True))
                    scores.append(1 / (1 + math.exp(-min(max(line, -700.0), 700.0))))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i) for i in range(len(columns))], pa.array(scores, pa.float64())],
                    names=[*columns, "_tx_score"],
                )

        return docs.select(*[F.col(f"`{c}`") for c in columns], F.col("text").cast("string").alias("_tx_text")).mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    made = Scorer(docs, labels).score(docs.select("doc_id", "text"))
    return made.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(fold(F.col("doc_id").cast("bigint")) == 0, F.lit(False)).alias("held_out"),
        F.col("_tx_score").alias("score"),
        (F.col("_tx_score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score is below one half."""
    return Scorer(docs, labels).score(docs).filter("_tx_score < 0.5").drop("_tx_score")
