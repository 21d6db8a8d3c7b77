"""Reading review answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from coinsieve.functions.text import contains_any, let, strip
from coinsieve.schema import CATEGORIES, UNCATEGORIZED

# Words that decide an answer's intent, tested in this order.
QUIT = ["quit", "exit", "stop", "end", "done", "q"]
CHANGE = ["change", "edit", "update", "correct", "modify", "should be", "change to", "make it"]
SKIP = ["skip", "next", "pass", "continue", "s"]
ACCEPT = [
    "y", "yes", "accept", "good", "correct", "agree", "approve", "right",
    "fine", "ok", "okay", "sure", "looks good", "keep", "makes sense",
]
# Phrases after which a category is looked for first.
TRIGGERS = [
    "change to ", "should be ", "make it ", "change it to ", "set as ", "set to ", "categorize as ",
]
# Answers taken as yes.
YES = ["y", "yes", "yeah", "sure", "ok", "please", "do it"]

REVIEW_REASON = "User override during interactive review"


def answer_text(col: Column) -> Column:
    return strip(F.lower(col))


def intent(answer: Column) -> Column:
    """quit > change > skip > accept > unknown, by containment."""

    def decide(text: Column) -> Column:
        return (
            F.when(contains_any(text, QUIT), "quit")
            .when(contains_any(text, CHANGE), "change")
            .when(contains_any(text, SKIP), "skip")
            .when(contains_any(text, ACCEPT), "accept")
            .otherwise("unknown")
        )

    return let(answer_text(answer), decide)


def affirmative(answer: Column) -> Column:
    return contains_any(F.lower(answer), YES)


def category_list(categories: list[str] | None = None) -> list[str]:
    return (categories or CATEGORIES) + [UNCATEGORIZED]


def first_category_in(text: Column, categories: list[str]) -> Column:
    return F.coalesce(
        *[F.when(F.contains(text, F.lit(c.lower())), F.lit(c)) for c in categories]
    )


def named_category(entry: Column, categories: list[str]) -> Column:
    """A list number or an exact name in any case, else the default label."""
    names = F.array(*[F.lit(c) for c in categories])
    lowered = F.array(*[F.lit(c.lower()) for c in categories])

    def pick(text: Column) -> Column:
        number = F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))
        place = F.coalesce(number, F.nullif(F.array_position(lowered, F.lower(text)), F.lit(0)).cast("int"))
        return F.when(place.between(1, len(categories)), F.get(names, place - 1))

    return F.coalesce(let(strip(entry), pick), F.lit(UNCATEGORIZED))


def mentioned_category(
    answer: Column, entry: Column | None = None, categories: list[str] | None = None
) -> Column:
    """Category after a trigger phrase, else anywhere, else from the entry."""
    labels = category_list(categories)
    entered = named_category(entry, labels) if entry is not None else F.lit(UNCATEGORIZED)

    def named(text: Column) -> Column:
        return first_category_in(text, labels)

    def search(text: Column) -> Column:
        after = [let(F.get(F.split(text, phrase), F.lit(1)), named) for phrase in TRIGGERS]
        return F.coalesce(*after, named(text))

    return F.coalesce(let(answer_text(answer), search), entered)


def suggested_category(reasoning: Column) -> Column:
    """Category named in a low-confidence reason, NULL when there is none."""
    found = F.regexp_extract(reasoning, r"Low confidence \([0-9.]+\) for '([^']+)'", 1)
    return F.when(F.contains(reasoning, F.lit("Original reasoning")) & (found != ""), found)
