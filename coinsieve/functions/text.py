"""Text cleaning as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's str.strip/split see it: for regexes, and as characters.
SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"
SPACES = "".join(
    chr(c)
    for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)

# Literals deleted from descriptions, in this order.
NOISE = ["ach debit", "ach credit", "online", "payment", "*"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(col: Column) -> Column:
    """Remove leading and trailing whitespace, Unicode spaces included."""
    return F.trim(col, F.lit(SPACES))


def collapse_spaces(col: Column) -> Column:
    """Single blanks between words, none at the ends."""
    return F.trim(F.regexp_replace(col, f"{SPACE}+", " "))


def delete_literals(col: Column, literals: list[str]) -> Column:
    """Delete each literal in turn; later ones see the result of earlier ones."""
    return reduce(lambda c, text: F.replace(c, F.lit(text), F.lit("")), literals, col)


def normalize_description(col: Column) -> Column:
    return collapse_spaces(delete_literals(strip(F.lower(col)), NOISE))


def first_word(col: Column) -> Column:
    """First word of the lower-cased text, NULL when it has none."""
    word = F.split(collapse_spaces(F.lower(col)), " ")[0]
    return F.when(word != "", word)


def contains_any(col: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(col, F.lit(w)) for w in words])


def tokens(col: Column) -> Column:
    """Distinct words of a text."""
    return F.array_remove(F.array_distinct(F.split(collapse_spaces(col), " ")), "")


def file_stem(path: Column) -> Column:
    """Lower-cased file name without folder and extension. A name that is no
    valid encoding (a bare ``%``) is taken as it is."""
    name = F.element_at(F.split(path, "/"), -1)
    decoded = F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)
    return F.lower(F.regexp_replace(decoded, r"\.[^.]*$", ""))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """part / whole in percent, 0 when there is nothing to divide by."""
    return F.when(whole > 0, F.round(part * 100.0 / whole, digits)).otherwise(F.lit(0.0))


def fixed_point(col: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f", col)
