"""Reading JSON out of free text: fences, prose, broken arrays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from coinsieve.functions.text import let, strip


def strip_fences(text: Column) -> Column:
    return F.replace(F.replace(strip(text), F.lit("```json"), F.lit("")), F.lit("```"), F.lit(""))


def slice_json(text: Column) -> Column:
    """The text itself when it starts as JSON, else the outermost object, else
    the outermost array, else unchanged."""

    def cut(bare: Column) -> Column:
        obj = F.regexp_extract(bare, r"(?s)\{.*\}", 0)
        arr = F.regexp_extract(bare, r"(?s)\[.*\]", 0)
        return F.when(bare.rlike(r"^[{\[]"), bare).otherwise(
            F.coalesce(F.nullif(obj, F.lit("")), F.nullif(arr, F.lit("")), bare)
        )

    return let(strip_fences(text), cut)


def _parse_whole(t: Column) -> Column:
    """VARIANT of a text that is one JSON value and nothing else.

    The parser stops after the first value, so the text is put inside an array
    and inside an object: what follows a first value breaks one of them.
    """
    in_array = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))), "$", "array<variant>")
    in_object = F.try_parse_json(F.concat(F.lit('{"a":'), t, F.lit("}")))
    return F.when(in_object.isNotNull(), let(in_array, lambda v: F.when(F.size(v) == 1, F.get(v, F.lit(0)))))


def parse_json(text: Column) -> Column:
    """VARIANT of the JSON in a text; NULL when it is not valid."""
    return let(strip(slice_json(text)), _parse_whole)


def _wrap_loose(t: Column) -> Column:
    loose = ~F.startswith(t, F.lit("[")) & F.contains(t, F.lit("{")) & F.contains(t, F.lit("},"))
    return F.when(loose, F.concat(F.lit("["), t, F.lit("]"))).otherwise(t)


def _undouble(t: Column) -> Column:
    doubled = F.startswith(t, F.lit("[[")) & F.endswith(t, F.lit("]]"))
    return F.when(doubled, F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(t)


def _close_array(t: Column) -> Column:
    unclosed = F.startswith(t, F.lit("[")) & ~F.endswith(t, F.lit("]"))
    return F.when(unclosed, F.concat(t, F.lit("]"))).otherwise(t)


def _close_cut_off(t: Column) -> Column:
    """Balance a text that ends inside a confidence value."""

    def missing(opening: str, closing: str) -> Column:
        count = F.regexp_count(t, F.lit(rf"\{opening}")) - F.regexp_count(t, F.lit(rf"\{closing}"))
        return F.repeat(F.lit(closing), F.greatest(count, F.lit(0)))

    cut_off = F.contains(t, F.lit("confidence")) & F.endswith(t, F.lit("0"))
    return F.when(cut_off, F.concat(t, missing("{", "}"), missing("[", "]"))).otherwise(t)


def repair_array(text: Column) -> Column:
    """Wrap loose objects, unwrap doubled brackets, close what was cut off."""
    steps = [_wrap_loose, _undouble, _close_array, _close_cut_off]
    return reduce(let, steps, strip(text))


def salvage_objects(text: Column) -> Column:
    """Flat objects found one by one in a text that does not parse as a whole."""
    found = F.regexp_extract_all(text, F.lit(r'\{\s*"[^{}]*\}'), F.lit(0))
    return F.filter(F.transform(found, F.try_parse_json), lambda v: v.isNotNull())


def parse_suggestions(text: Column) -> Column:
    """array<variant> of a reply that should hold an array of objects."""

    def listed(whole: Column) -> Column:
        several = F.try_variant_get(whole, "$", "array<variant>")
        return F.coalesce(several, F.when(whole.isNotNull(), F.array(whole)))

    def filled(items: Column) -> Column:
        return F.when(F.size(items) > 0, items).otherwise(salvage_objects(text))

    return let(let(parse_json(repair_array(text)), listed), filled)
