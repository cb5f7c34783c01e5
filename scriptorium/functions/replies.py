"""Column functions over model replies: strict JSON, entity records, letter lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions.text import py_strip

# Entity categories in record order; dates are never explained.
CATEGORIES = ("People", "Productions", "Companies", "Theaters", "Dates")
EXPLAINED_CATEGORIES = ("People", "Productions", "Companies", "Theaters")


def _bind(value, body):
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strict_json(reply):
    """The reply as VARIANT when the whole string is one JSON value, NULL otherwise.

    The Spark parser stops after the first value, so trailing text would slip through. Inside an
    array, and again inside an object, trailing text breaks the enclosing value.
    """
    in_array = F.try_parse_json(F.concat(F.lit("["), reply, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), reply, F.lit("}")))
    return F.when(in_array.isNotNull(), F.try_variant_get(in_object, "$.v", "variant"))


def is_json(text):
    """Whether the whole string is one JSON value, as :func:`strict_json` has it, by one parse and without the value.

    A mark stands behind it in a list, which a text cannot bring along: it is made of the text's digest.
    """
    mark = F.concat(F.lit("~"), F.xxhash64(text).cast("string"))
    read = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')))
    return F.coalesce(F.try_variant_get(read, "$[1]", "string") == mark, F.lit(False))


def _items(value, path):
    return F.try_variant_get(value, path, "array<variant>")


def _all_strings(items):
    kind = F.forall(items, lambda x: F.coalesce(F.schema_of_variant(x) == "STRING", F.lit(False)))
    return F.coalesce(kind, F.lit(False))


def _as_strings(items):
    return F.transform(items, lambda x: F.try_variant_get(x, "$", "string"))


def _empty_list():
    return F.expr("array()").cast("array<string>")


def validate_entities(reply):
    """Struct of ``status`` and one string list per category.

    ``parsed``: all five keys hold lists of strings (other keys are ignored). ``defaulted``: not
    JSON, all lists are empty. ``invalid``: JSON of another shape, all lists are NULL.
    """
    def read(value):
        return F.struct(value.isNull().alias("broken"),
                        *[_items(value, f"$.{c}").alias(c) for c in CATEGORIES])

    def check(lists):
        valid = F.lit(True)
        for category in CATEGORIES:
            valid = valid & _all_strings(lists[category])
        return F.struct(valid.alias("valid"), lists.alias("lists"))

    def record(checked):
        lists, valid, broken = checked["lists"], checked["valid"], checked["lists"]["broken"]
        status = F.when(broken, "defaulted").when(valid, "parsed").otherwise("invalid")
        return F.struct(status.alias("status"), *[
            F.when(broken, _empty_list()).when(valid, _as_strings(lists[c])).alias(c)
            for c in CATEGORIES])

    value = strict_json(py_strip(reply))
    return _bind(value, lambda v: _bind(read(v), lambda lists: _bind(check(lists), record)))


def parse_letters(reply, full_text):
    """Struct of ``status`` (parsed / whole_text / failed) and the letter list.

    A JSON list of strings gives its items, a list with anything else fails, and every other
    reply falls back to the full text as the only letter.
    """
    def record(items):
        status = (F.when(items.isNull(), "whole_text")
                  .when(_all_strings(items), "parsed").otherwise("failed"))
        letters = (F.when(items.isNull(), F.array(full_text))
                   .when(_all_strings(items), _as_strings(items)))
        return F.struct(status.alias("status"), letters.alias("letters"))

    return _bind(_items(strict_json(py_strip(reply)), "$"), record)


def to_json_record(*cols):
    """One JSON object of the given columns; NULL fields are kept and nothing is escaped to ASCII."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
