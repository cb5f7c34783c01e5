"""The whole run over a set of documents: lines in, result tables out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F

from scriptorium.functions.replies import CATEGORIES, EXPLAINED_CATEGORIES, to_json_record
from scriptorium.functions.text import parse_page_number
from scriptorium.operators.correct import aligned_words, bare, correct_text, effective_text, tokens
from scriptorium.operators.decoding import decode_texts, learn_model
from scriptorium.operators.entities import (
    explain_entities, explanation_maps, extract_entities, unpivot_entities)
from scriptorium.operators.layout import assemble_text, with_empty_documents
from scriptorium.operators.letters import GREETING, SIGN_OFF, letter_arrays, letter_rows
from scriptorium.operators.status import FAILED, SUCCEEDED, failed_documents
from scriptorium.plans.model_tasks import (
    correct_with_model, explain_with_model, extract_with_model, split_with_model)
from scriptorium.session import cut_lineage
from scriptorium.sources.sinks import write_files, write_json, write_table

# Endings of the files that a document is said to have.
RAW, CORRECTED, COMBINED = ".raw.txt", ".corrected.txt", ".combined_output.json"
# Replies that give a result; a reply that is no JSON has a default result.
GOOD_REPLIES = ("parsed", "defaulted", "whole_text")
# The result tables of a run.
TABLES = ("raw_text", "corrected", "entities", "explanations", "letters", "doc_status", "entity_records", "combined")


@dataclass(frozen=True)
class RunConfig:
    """Options of a run.

    ``materialise`` writes raw texts, corrected texts, entity records and letters once, so that the
    result tables read them instead of computing them again, also after the loss of an executor.
    ``export`` says that loose files per document are wanted, which ``doc_status`` then names.
    """

    key: str = "doc_id"
    order: tuple = ("page", "line_no")
    greeting: str = GREETING
    signoff: str = SIGN_OFF
    output: str = "output"
    materialise: bool = False
    export: bool = False


def document_run(files, lines, lexicon=None, gazetteer=None, knowledge=None, config=RunConfig(),
                 jobs=None, model=None, pairs=None):
    """Result tables of a run, by name.

    ``files`` names the documents, each at least once, and ``lines`` has one row per OCR line. The
    text tasks follow the rules with ``lexicon``, ``gazetteer`` and ``knowledge``, or go to ``model``
    (:class:`plans.model_tasks.Model`) when one is given. With ``pairs(raw, corrected)``, texts and their
    corrections, the correction is decoded in context (:mod:`operators.decoding`) instead of looked up in ``lexicon``. ``jobs(key, outcome)``, with a ``reason``
    where one is known, keeps documents whose OCR did not succeed out of every later step; they are
    reported as failed. A document without a job goes on. ``doc_status`` has exactly one row per
    document of ``files``: a step that failed for a document makes its status FAILED, names the step
    in ``reason`` and leaves the other results of the document in place.
    """
    key = config.key
    keep = cut_lineage if config.materialise else lambda df, label: df
    files = files.select(key).distinct()
    failed = None
    if jobs is not None:
        reason = ["reason"] if "reason" in jobs.columns else []
        failed = failed_documents(jobs.select(key, "outcome", *reason)).join(files, key, "left_semi")
        files = files.join(failed.select(key), key, "left_anti")
    # Lines of documents that are not in files are dropped by the join on files.
    raw = keep(with_empty_documents(files, assemble_text(lines, key, config.order), key), "raw")
    docs = keep(_corrected(raw, lexicon, model, key, pairs), "corrected").withColumn(
        "text", effective_text(F.col("raw_text"), F.col("corrected_text")))
    texts = docs.select(key, "text")
    if model is None:
        explain = None
        records = extract_entities(texts, gazetteer, key)
        combined = letter_arrays(texts, "text", config.greeting, config.signoff).select(
            key, parse_page_number(F.col("text")).alias("page_number"), "letters",
            F.lit("parsed").alias("letter_status"))
        records = records.withColumn("entity_status", F.lit("parsed"))
    else:
        explain = lambda wanted: explain_with_model(wanted, model)
        records = extract_with_model(texts, model, key)
        combined = split_with_model(texts, model, key).select(key, "page_number", "letters", "letter_status")
    records = keep(records.select(key, *CATEGORIES, "entity_status"), "records")
    combined = keep(combined, "combined")
    entities = unpivot_entities(records, key)
    return {
        "raw_text": docs.select(key, "raw_text"),
        "corrected": docs.select(key, "corrected_text"),
        "entities": entities,
        "explanations": explain_entities(entities, knowledge, explain),
        "letters": letter_rows(combined.drop("letter_status")),
        "doc_status": _doc_status(docs, records, combined, failed, config),
        "entity_records": records.drop("entity_status"),
        "combined": combined.drop("letter_status"),
    }


def _corrected(raw, lexicon, model, key, pairs=None):
    none = F.lit(None).cast("string")
    if model is None and pairs is not None:
        words = F.explode(F.array_distinct(F.transform(tokens(F.col("raw_text")), bare))).alias("word")
        reading = learn_model(pairs, aligned_words(pairs), raw.select(words).distinct())
        return decode_texts(raw, reading, key, "raw_text").withColumn("correct_error", none)
    if model is None:
        return correct_text(raw, lexicon, key, "raw_text").withColumn("correct_error", none)
    replies = correct_with_model(raw.select(key, F.col("raw_text").alias("text")), model, key)
    return raw.join(replies.select(key, "corrected_text", F.col("error").alias("correct_error")), key, "left")


def _doc_status(docs, records, combined, failed, config):
    """One row per document: what it became, which steps failed, where its results are.

    A path names the file that :func:`export_documents` writes for a result that exists; without
    ``config.export`` there is no such file, and the path is the result table.
    """
    key = config.key
    name = F.col(key).cast("string")

    def place(ending, table):
        if config.export:
            return F.concat(F.lit(config.output + "/"), name, F.lit("/"), name, F.lit(ending))
        return F.lit(f"{config.output}/{table}")
    n_entities = sum((F.size(c) for c in CATEGORIES), F.lit(0))
    # Only counts and outcomes go through the joins, not texts.
    status = docs.select(
        key, (F.col("raw_text") == "").alias("_empty"), F.col("correct_error").isNotNull().alias("_uncorrected"),
        F.col("corrected_text").isNotNull().alias("_corrected"), "n_lines",
    ).join(records.select(key, "entity_status", n_entities.cast("bigint").alias("n_entities")), key, "left").join(
        combined.select(key, "page_number", "letter_status", F.size("letters").cast("bigint").alias("n_letters")),
        key, "left")
    broken = lambda column: ~F.coalesce(F.col(column), F.lit("missing")).isin(*GOOD_REPLIES)
    steps = F.array_compact(F.array(
        F.when(F.col("_uncorrected"), "correct_text"), F.when(broken("entity_status"), "extract_entities"),
        F.when(broken("letter_status"), "split_letters")))
    status = status.withColumn("_steps", steps).select(
        key, F.when(F.size("_steps") > 0, FAILED).otherwise(SUCCEEDED).alias("status"),
        F.when(F.size("_steps") > 0, F.concat(F.lit("failed: "), F.array_join("_steps", ", ")))
        .when(F.col("_empty"), "no_text").alias("reason"),
        place(RAW, "raw_text").alias("raw_path"),
        F.when(F.col("_corrected"), place(CORRECTED, "corrected")).alias("corrected_path"),
        F.when(~broken("letter_status"), place(COMBINED, "combined")).alias("combined_path"),
        "n_lines", "n_entities", "page_number", "n_letters")
    if failed is None:
        return status
    paths = [F.lit(None).cast("string").alias(p)
             for p in ("raw_path", "corrected_path", "combined_path")]
    counts = [F.lit(None).cast("bigint").alias(c)
              for c in ("n_lines", "n_entities", "page_number", "n_letters")]
    return status.unionByName(
        failed.select(key, F.lit(FAILED).alias("status"), "reason", *paths, *counts))


def explanation_records(tables, key="doc_id"):
    """One record per document with one map per category, empty where nothing is explained."""
    maps = explanation_maps(tables["explanations"], key)
    none = F.expr("map()").cast("map<string,string>")
    return tables["entity_records"].select(key).join(maps, key, "left").select(
        key, *[F.coalesce(c, none).alias(c) for c in EXPLAINED_CATEGORIES])


def write_document_run(tables, out, batch_id=None):
    """Write every result table below ``out``."""
    for name, table in tables.items():
        write_table(table, f"{out}/{name}", batch_id)


def write_json_records(tables, out, key="doc_id"):
    """Write the nested records of all documents as JSON lines: entities, explanations, letters."""
    write_json(tables["entity_records"], f"{out}/entities_json")
    write_json(explanation_records(tables, key), f"{out}/entities_explained_json")
    write_json(tables["combined"], f"{out}/combined_output_json")


def export_documents(tables, out, key="doc_id"):
    """Write the loose files that ``doc_status`` names, inside tasks and without an added line end.

    ``out`` is a folder that all executors share. Meant for a moderate number of documents; the
    result tables hold the same and scale.
    """
    write_files(tables["raw_text"], out, key, "raw_text", RAW)
    write_files(tables["corrected"].where(F.col("corrected_text").isNotNull()), out, key, "corrected_text", CORRECTED)
    combined = tables["combined"]
    rest = [c for c in combined.columns if c != key]
    write_files(combined.select(key, to_json_record(*rest).alias("combined")), out, key, "combined", COMBINED)
