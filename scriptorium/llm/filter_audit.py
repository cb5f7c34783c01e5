"""Audit of filters that are applied one after the other, in every order, from wide packed counters.

A document that fails some of n filters is known by its mask alone: for each of the n! orders the mask
says which filter removes it and which find it already gone. So every kind of document (mask, good,
toxic) maps to one big integer with a field for each order, step and measure, and a part of the corpus is
the sum of these integers, each times the number of its documents. Fields are wide enough for all
documents of the part, so no sum runs into the next field, and one pass over the table is enough.
"""

from __future__ import annotations

from functools import cache
from itertools import permutations

import pandas as pd
from pyspark.sql import functions as F

MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
# Blanks of the words, as fixed by the filters.
_BLANKS = r"[\x20\x09-\x0D]+"
_RESULT = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
           "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def words(text):
    return F.filter(F.split(text, _BLANKS), lambda w: w != "")


def text_failures(text):
    """Failure of the filters A to D for a text without nulls, as one struct."""
    items = words(text)
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return F.struct(
        (F.size(items) < 200).alias("A"), (100 * F.size(F.array_distinct(items)) < 50 * F.size(items)).alias("B"),
        (100 * capitals > 3 * F.char_length(text)).alias("C"), text.rlike("[#$%&*|]").alias("D"))


def repeats_earlier(rows, digest="_digest", key="doc_id"):
    """Adds E: whether a row with a smaller id has the same digest; never where the id is null.

    Least ids are aggregated before they are shuffled. The join is on digest and id, so a text with very
    many copies is no hot key: each of its ids meets the least one or nothing.
    """
    first = rows.groupBy(digest).agg(F.min(key).alias(key)).where(F.col(key).isNotNull()).withColumn("_first", F.lit(True))
    return rows.join(first, [digest, key], "left").withColumn("E", F.col("_first").isNull() & F.col(key).isNotNull()).drop("_first")


@cache
def packed_outcomes(names, mask, good, toxic, width):
    """The big integer of one document: fields of ``width`` bits by order, step and measure, lowest first."""
    total, place = 0, 0
    for order in permutations(range(len(names))):
        removed = False
        for step in order:
            fails = bool(mask >> step & 1)
            here = fails and not removed
            removed = removed or fails
            for value in (not removed, here, fails and not here, mask == 1 << step, here and good, here and toxic):
                total |= int(value) << place
                place += width
    return total


def unpacked(total, names, width):
    """Rows of (order, step, measures) of a sum of packed integers."""
    field, place = (1 << width) - 1, 0
    for order in permutations(names):
        for step, name in enumerate(order, 1):
            values = [total >> place + i * width & field for i in range(len(MEASURES))]
            place += len(MEASURES) * width
            yield "".join(order), step, name, values


def _audit(names):
    def run(counted: pd.DataFrame) -> pd.DataFrame:
        counts = [int(n) for n in counted["n"]]
        width = sum(counts).bit_length()
        total = sum(n * packed_outcomes(names, int(m), bool(g), bool(t), width)
                    for n, m, g, t in zip(counts, counted["mask"], counted["good"], counted["toxic"]))
        rows = list(unpacked(total, names, width))
        shares = {}
        for _, _, name, values in rows:
            shares[name] = shares.get(name, 0) + values[1]
        part = counted["part"].iloc[0]
        return pd.DataFrame([(part, order, step, *values, shares[name]) for order, step, name, values in rows],
                            columns=["part", "filter_order", "step", *MEASURES, "shapley"])
    return run


def audit_filters(rows, names):
    """One row per part, order of the filters and step, zeros included.

    ``rows`` have part (null counts as the empty string), one boolean column per filter, true where the row
    fails it, and good and toxic; null flags count as false. ``kept`` are the rows left after the step, ``removed`` those
    that go at it, ``redundant`` those that fail its filter but are gone already, ``unique_fails`` those that
    fail this filter only, and ``shapley`` sums ``removed`` of the step's filter over all orders. Rows
    are counted by part and mask before they are shuffled, so a part is a few rows, however hot. An empty table has no part.
    """
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    mask = sum((flag(name).cast("int") * (1 << i) for i, name in enumerate(names)), F.lit(0))
    counted = rows.select(F.coalesce("part", F.lit("")).alias("part"), mask.alias("mask"), flag("good").alias("good"),
                          flag("toxic").alias("toxic")).groupBy("part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    return counted.groupBy("part").applyInPandas(_audit(tuple(names)), _RESULT)


def audit_documents(docs, labels, key="doc_id", text="text", part="lang"):
    """The audit of five filters over whole texts, in the columns of :func:`audit_filters`.

    A: under 200 words; B: less than half of the words are distinct; C: more than 3 in 100 characters are
    A to Z; D: one of ``#$%&*|``; E: the text is that of a smaller id. A null text counts as empty, and empty
    texts are equal texts. A null id is never a copy, makes none and has no label. ``labels`` (doc_id, quality, toxic) may
    hold an id several times; one row with 1 is enough. Other columns are ignored.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(part).cast("string").alias("part"),
                       F.unhex(F.sha2(whole, 256)).alias("_digest"), text_failures(whole).alias("_fails"))
    rows = repeats_earlier(rows.select("doc_id", "part", "_digest", "_fails.*"))
    marked = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    return audit_filters(rows.join(marked, "doc_id", "left"), "ABCDE")
