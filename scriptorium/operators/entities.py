"""Typed entities: extraction, long and record form, and their explanations."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions.replies import CATEGORIES, EXPLAINED_CATEGORIES
from scriptorium.operators.correct import bare, tokens
from scriptorium.operators.gazetteer import IN_ROW, joined_names, names_in_row, written

# The date formats that are found in a text.
_MONTH = ("(?:January|February|March|April|May|June|July|August|September|October|November"
          "|December)")
DATES = (r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b"
         rf"|\b{_MONTH} [0-9]{{1,2}}, [0-9]{{4}}\b"
         rf"|\b[0-9]{{1,2}} {_MONTH} [0-9]{{4}}\b")


def _words(text):
    """Words in lower case without punctuation at their ends."""
    return F.filter(F.transform(tokens(text), lambda t: F.lower(bare(t))), lambda w: w != "")


def name_index(gazetteer):
    """Gazetteer(category, name) by normalised name: the phrase, its length and its entities."""
    named = (gazetteer.select("category", "name", _words(F.col("name")).alias("_w"))
             .where(F.size("_w") > 0)
             .groupBy("category", F.array_join("_w", " ").alias("phrase"),
                      F.size("_w").alias("n_words"))
             .agg(F.min("name").alias("name")))
    return named.groupBy("phrase", "n_words").agg(
        F.array_sort(F.collect_list(F.struct("category", "name"))).alias("found"))


def extract_entities(df, gazetteer, key="doc_id", text="text", in_row=IN_ROW):
    """Add one list per category: gazetteer names and dates, in order of first occurrence.

    At a position the longest name wins. A gazetteer of at most ``in_row`` names is broadcast as an automaton
    and looked up inside the row. A larger one is joined with the runs of words that its bitmaps let
    through, and only matches are shuffled by ``key``, of which ``df`` has one row each.
    """
    # Found before the names, so that a caller who wants only the lists joins without the texts.
    dated = df.withColumn("Dates", F.array_distinct(
        F.regexp_extract_all(F.col(text), F.lit(DATES), F.lit(0))))
    index, size = written(name_index(gazetteer))
    if size <= in_row:
        named = names_in_row(dated, index, text, EXPLAINED_CATEGORIES)
        return named.select(*dated.columns, *[F.col(f"_names.{c}").alias(c) for c in EXPLAINED_CATEGORIES])
    # Sorted by position and length: the last match at a position is the longest one there.
    hits = joined_names(df, index, key, text).groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("pos", "n_words", "found"))).alias("_hits"))
    longest = F.filter("_hits", lambda h, i: F.coalesce(
        F.get("_hits", i + 1)["pos"] != h["pos"], F.lit(True)))
    found = hits.select(key, F.flatten(F.transform(longest, lambda h: h["found"])).alias("_found"))
    none = F.expr("array()").cast(found.schema["_found"].dataType)

    def names(category):
        mine = F.filter(F.coalesce("_found", none), lambda e: e["category"] == category)
        return F.array_distinct(F.transform(mine, lambda e: e["name"]))

    lists = {c: names(c) for c in EXPLAINED_CATEGORIES}
    return dated.join(found, key, "left").withColumns(lists).drop("_found")


def unpivot_entities(records, key="doc_id", categories=CATEGORIES):
    """Records with one list per category to rows (key, category, ord, entity), ord from 1."""
    lists = F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).alias("items"))
                      for c in categories])
    return (records.select(key, F.explode(lists).alias("_l"))
            .select(key, F.col("_l.category").alias("category"),
                    F.posexplode("_l.items").alias("_pos", "entity"))
            .select(key, "category", (F.col("_pos") + 1).cast("bigint").alias("ord"), "entity"))


def entity_record(entities, key="doc_id", categories=CATEGORIES):
    """Rows (key, category, ord, entity) to one record per key with one list per category."""
    def items(category):
        pairs = F.array_sort(F.collect_list(
            F.when(F.col("category") == category, F.struct("ord", "entity"))))
        return F.transform(pairs, lambda p: p["entity"]).alias(category)
    return entities.groupBy(key).agg(*[items(c) for c in categories])


def distinct_requests(entities, categories=EXPLAINED_CATEGORIES):
    """The (category, entity) pairs to explain, each once for all documents."""
    return (entities.where(F.col("category").isin(*categories))
            .select("category", "entity").distinct())


def attach_explanations(entities, knowledge):
    """Explanation of every entity, NULL where none is known.

    ``knowledge`` has one row per (category, entity). An entity that most documents name makes
    the left side skewed, which AQE splits; the right side has a single row for it.
    """
    return entities.join(knowledge.select("category", "entity", "explanation"),
                         ["category", "entity"], "left")


def explain_entities(entities, knowledge=None, explain=None, categories=EXPLAINED_CATEGORIES):
    """Entities of the explained categories with their explanation.

    The explanations come from a ``knowledge`` table, or from ``explain``, a function from
    distinct requests (category, entity) to (category, entity, explanation).
    """
    if knowledge is None:
        knowledge = explain(distinct_requests(entities, categories))
    return attach_explanations(entities.where(F.col("category").isin(*categories)), knowledge)


def latest_explanations(explanations, key="doc_id"):
    """One row per (key, category, entity): of repeated entities the explanation that comes last.

    The rows come from a lookup by (category, entity), and a grouping that contains these columns
    would run inside its partitions, so that AQE could not split an entity most documents
    name. Partitioning by document first leaves it free to, and serves the maps as well.
    """
    last = F.max_by("explanation", F.struct("ord", "explanation"))
    return (explanations.where(F.col("explanation").isNotNull()).repartition(key)
            .groupBy(key, "category", "entity").agg(last.alias("explanation")))


def explanation_maps(explanations, key="doc_id", categories=EXPLAINED_CATEGORIES):
    """One record per key with one map entity -> explanation per category."""
    def entries(category):
        pairs = F.array_sort(F.collect_list(
            F.when(F.col("category") == category, F.struct("entity", "explanation"))))
        return F.map_from_entries(pairs).alias(category)
    return latest_explanations(explanations, key).groupBy(key).agg(
        *[entries(c) for c in categories])
