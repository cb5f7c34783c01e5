"""Secrets in texts by a trigram inverted index, with Spark expressions alone.

1. From the pattern of each rule follows a Boolean query: sets of trigrams, one of which every text with a
   match holds whole. It is derived from the parsed pattern, over lower-cased letters.
2. The index has a row per trigram and text, for the trigrams that some rule asks for.
3. Postings are intersected: per text and set, the trigrams met are counted. A complete set makes the
   text a candidate for the rule.
4. Candidates are verified with the pattern itself. A rule without a trigram that every match must hold
   scans all texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as kinds, _parser as parser

from pyspark.sql import functions as F

from scriptorium.session import cut_lineage

# Candidates (id, hash and the rules to try) up to this number are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 500_000
# Strings of an alternative that are told apart before it counts as anything.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern, and the least length of one of its groups (0: the whole match).

    A match that is too short is dropped and is not tried again from a later place. Patterns keep to what
    Java's, Python's and RE2's expressions read alike.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


def _either_case(text):
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in text)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
# The base rules, and rules for tokens that carry the mark of their issuer.
BASE_RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", "[0-9a-f]{16,}", 0, 16),
)
MORE_RULES = (
    Rule("github", "gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("gitlab", "glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)


# A part of a pattern is (strings, queries): all strings it can be, or None where they are too many, and the
# alternatives of trigrams, one of which every match holds; (frozenset(),) asks for nothing.
_ANYTHING = (None, (frozenset(),))


def trigrams(text):
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _queries(part):
    strings, queries = part
    return queries if strings is None else tuple({trigrams(s) for s in strings}) or (frozenset(),)


def _both(a, b):
    """Queries of texts that hold a match of each part, as few sets as say it."""
    both = {x | y for x in a for y in b}
    return tuple(x for x in both if not any(y < x for y in both)) if len(both) <= MOST_STRINGS else a


def _in_line(parts):
    """One part after the other: neighbouring strings are joined, so that trigrams reach over them."""
    strings, queries, whole = ("",), (frozenset(),), True
    for part in parts:
        if part[0] is not None and len(strings) * len(part[0]) <= MOST_STRINGS:
            strings = tuple(dict.fromkeys(a + b for a in strings for b in part[0]))
            continue
        queries, whole = _both(queries, _queries((strings, ()))), False
        strings = part[0] or ("",)
        if part[0] is None:
            queries = _both(queries, part[1])
    return (strings, ()) if whole else (None, _both(queries, _queries((strings, ()))))


def _part(op, value):
    if op is kinds.LITERAL:
        return (chr(value).lower(),), ()
    if op is kinds.AT:
        return ("",), ()
    if op is kinds.IN and all(o in (kinds.LITERAL, kinds.RANGE) for o, _ in value):
        chars = {chr(c).lower() for o, v in value for c in ([v] if o is kinds.LITERAL else range(v[0], v[1] + 1))}
        return (tuple(sorted(chars)), ()) if len(chars) <= 8 else (None, (frozenset(),))
    if op is kinds.SUBPATTERN:
        return _line(value[3])
    if op is kinds.BRANCH:
        lines = [_line(line) for line in value[1]]
        if all(strings is not None for strings, _ in lines):
            return tuple(dict.fromkeys(s for strings, _ in lines for s in strings)), ()
        return None, tuple({q for line in lines for q in _queries(line)})
    if op is kinds.MAX_REPEAT:
        least, most, inner = value
        inner = _line(inner)
        if most == 1:
            return (tuple(dict.fromkeys(("", *inner[0]))), ()) if inner[0] is not None else _ANYTHING
        if least and inner[0] is not None and len(inner[0]) ** least <= MOST_STRINGS and least == most:
            return _in_line([inner] * least)
        return (None, _queries(inner)) if least else _ANYTHING
    return _ANYTHING


def _line(items):
    return _in_line([_part(op, value) for op, value in items])


def trigram_queries(pattern):
    """Sets of trigrams, one of which is in every lower-cased text with a match; empty: no such trigram."""
    found = _queries(_line(parser.parse(pattern)))
    return () if any(not q for q in found) else tuple(sorted(found, key=sorted))


def trigram_index(rows, queries):
    """The postings (gram, doc_id, _h) of the trigrams that the queries ask for, in order of the trigram."""
    wanted = F.array(*[F.lit(g) for g in sorted({g for q in queries for g in q})])
    # A text is lower-cased once; a search for three bytes is faster than a pattern of all of them.
    grams = F.transform(F.array(F.lower("text")), lambda low: F.filter(wanted, lambda g: low.contains(g)))[0]
    return cut_lineage(rows.select(F.explode(grams).alias("gram"), "doc_id", "_h").sortWithinPartitions("gram"), "postings")


def candidates(index, asked):
    """(doc_id, _h, rules): the rules of which some set of trigrams is complete in the text."""
    spark = index.sparkSession
    sets = [(kind, n, gram, len(q)) for kind, queries in asked.items() for n, q in enumerate(queries) for gram in sorted(q)]
    sets = spark.createDataFrame(sets, "rule string, n int, gram string, size int")
    # The sets are as many as the patterns make them, a few hundred rows.
    met = index.join(F.broadcast(sets), "gram").groupBy("doc_id", "_h", "rule", "n", "size").agg(
        F.count_distinct("gram").alias("met")).where("met = size")
    return met.groupBy("doc_id", "_h").agg(F.collect_set("rule").alias("rules"))


_SPANS = "cast(array() as array<struct<start: bigint, end: bigint>>)"
_RUN = 128


def running(values):
    """Running totals of an array, run by run, so that the work is about linear in its length."""
    none = F.expr("cast(array() as array<bigint>)")

    def totals(items, of):
        start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("all"))
        return F.aggregate(items, start, lambda done, x: F.struct(
            (done["at"] + of(x)).alias("at"), F.concat(done["all"], F.array(done["at"] + of(x))).alias("all")))
    runs = F.transform(F.sequence(F.lit(1), F.size(values), F.lit(_RUN)), lambda at: totals(
        F.slice(values, at, _RUN), lambda x: x))
    return F.flatten(F.zip_with(runs, totals(runs, lambda r: r["at"])["all"], lambda run, end: F.transform(
        run["all"], lambda x: x + end - run["at"])))


def rule_spans(text, rule):
    """Spans (start, end) of the matches of a rule, in code points, from the pieces between them."""
    found = lambda group: F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group)), F.char_length)
    # With every match goes the text before it; the last piece has no match.
    before = F.transform(F.split(text, rule.pattern), F.char_length)
    steps = F.filter(F.zip_with(before, found(0), lambda gap, size: F.struct(
        (gap + size).alias("step"), size.alias("size"))), lambda x: x["size"].isNotNull())
    ends = running(F.transform(steps, lambda x: x["step"]))
    both = F.zip_with(ends, F.transform(steps, lambda x: x["size"]), lambda end, size: F.struct(
        (end - size).alias("start"), end.alias("end")))
    judged = F.filter(F.zip_with(both, found(rule.group), lambda span, n: F.struct(span.alias("span"), n.alias("n"))),
                      lambda x: x["n"] >= rule.least)
    return F.when(text.rlike(rule.pattern), F.transform(judged, lambda x: x["span"])).otherwise(F.expr(_SPANS))


def find_secrets(docs, base=BASE_RULES, more=MORE_RULES, key="doc_id", text="text", broadcast_rows=BROADCAST_ROWS):
    """Per document: doc_id, n_<kind> of each base rule, base_sha256, spans, n_more.

    ``spans`` are kind:start:end of all rules by start, then kind as listed, in code points with the end
    exclusive; ``base_sha256`` is the SHA-256 of those of the base rules alone. A null text counts as
    empty, a null id is a document, repeated rows each have their result, other columns are ignored.
    """
    rules = (*base, *more)
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
        "_h", F.xxhash64("text"))
    asked = {rule.kind: trigram_queries(rule.pattern) for rule in rules}
    full = [kind for kind, queries in asked.items() if not queries]
    asked = {kind: queries for kind, queries in asked.items() if queries}
    tried = rows.withColumn("rules", F.lit(None).cast("array<string>"))
    if asked:
        index = trigram_index(rows, [q for queries in asked.values() for q in queries])
        found = cut_lineage(candidates(index, asked), "candidates").withColumnsRenamed({"doc_id": "_id", "_h": "_hash"})
        found = F.broadcast(found) if found.count() <= broadcast_rows else found
        tried = rows.join(found, (F.col("_h") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")

    def verified(rule):
        spans = rule_spans(F.col("text"), rule)
        wanted = F.lit(True) if rule.kind in full else F.coalesce(F.array_contains("rules", rule.kind), F.lit(False))
        return F.when(wanted, spans).otherwise(F.expr(_SPANS))
    checked = tried.select("doc_id", F.struct(*[verified(r).alias(r.kind) for r in rules]).alias("s"))

    def listed(chosen):
        # Sorted as (start, place of the kind in the list).
        one = lambda rule: F.transform(F.col(f"s.{rule.kind}"), lambda x: F.struct(
            x["start"].alias("start"), F.lit(rules.index(rule)).alias("place"), x["end"].alias("end")))
        names = F.array(*[F.lit(r.kind) for r in rules])
        return F.array_join(F.transform(F.array_sort(F.concat(*[one(r) for r in chosen])), lambda x: F.concat_ws(
            ":", F.get(names, x["place"]), x["start"].cast("string"), x["end"].cast("string"))), ",")
    size = lambda r: F.size(F.col(f"s.{r.kind}")).cast("bigint")
    return checked.select("doc_id", *[size(r).alias(f"n_{r.kind}") for r in base],
                          F.sha2(listed(base), 256).alias("base_sha256"), listed(rules).alias("spans"),
                          sum((size(r) for r in more), F.lit(0).cast("bigint")).alias("n_more"))
