"""The four text tasks through a model: build requests, call, parse, fall back."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from scriptorium.functions.replies import CATEGORIES, parse_letters, validate_entities
from scriptorium.functions.text import parse_page_number, py_strip
from scriptorium.operators.model import (
    apply_model, attach_responses, entity_text, render_prompt, stored_replies)
from scriptorium.session import cut_lineage


@dataclass(frozen=True)
class Model:
    """A back end with its request layout and call limits.

    ``known`` holds earlier replies (request_id, response, error), and ``store`` is a folder in which
    replies are kept as they come; answered requests are not sent again. ``timeout``, ``backoff`` and
    ``rate`` as in :func:`operators.model.apply_model`.
    """

    backend: object
    prompts: DataFrame
    layout: str = "system_and_user"
    name: str = "echo"
    attempts: int = 1
    parallelism: int | None = None
    threads: int = 1
    known: DataFrame | None = None
    timeout: float | None = None
    backoff: float = 0.0
    rate: float | None = None
    store: str | None = None


def prompt_of(prompts, task):
    """The prompt of a task as a value; of several the greatest one, and none is an error."""
    row = prompts.where((F.col("task") == task) & F.col("prompt").isNotNull()).agg(F.max("prompt").alias("prompt")).first()
    if row.prompt is None:
        raise ValueError(f"no prompt for task {task}")
    return row.prompt


def ask(texts, task, model):
    """Rows with a ``text`` to the same rows with ``response`` and ``error``.

    Replies are written once: a later step or a retried task reads them instead of calling
    the model again.
    """
    requests = render_prompt(
        texts.withColumns({"task": F.lit(task), "prompt": F.lit(prompt_of(model.prompts, task))}), model.layout, model.name)
    earlier = [] if model.known is None else [model.known]
    if model.store is not None:
        # Read before new replies are added to it.
        earlier.append(cut_lineage(stored_replies(texts.sparkSession, model.store), "stored"))
    answered = [e.where(F.col("error").isNull()).select("request_id", "response", "error", F.lit(0).alias("attempt")) for e in earlier]
    known = reduce(lambda a, b: a.unionByName(b), answered).dropDuplicates(["request_id"]) if answered else None
    replies = cut_lineage(
        apply_model(requests, model.backend, model.parallelism, model.attempts, known, model.threads, model.timeout,
                    model.backoff, model.rate, model.store), "replies")
    if known is not None:
        replies = replies.unionByName(known)
    return attach_responses(requests, replies).drop(
        "task", "prompt", "model", "system", "user", "request_id")


def correct_with_model(texts, model, key="doc_id"):
    """(key, corrected_text, error); a failed call leaves the text NULL."""
    return ask(texts.select(key, "text"), "correct_text", model).select(
        key, py_strip(F.col("response")).alias("corrected_text"), "error")


def extract_with_model(texts, model, key="doc_id"):
    """(key, entity_status, one list per category); failed or invalid replies have no entities."""
    replies = ask(texts.select(key, "text"), "extract_entities", model)
    checked = replies.select(key, "error", validate_entities(F.col("response")).alias("_r"))
    none = F.expr("array()").cast("array<string>")
    failed = F.col("error").isNotNull()
    return checked.select(
        key, F.when(failed, "failed").otherwise(F.col("_r.status")).alias("entity_status"),
        *[F.when(failed, none).otherwise(F.coalesce(F.col(f"_r.{c}"), none)).alias(c)
          for c in CATEGORIES])


def explain_with_model(requests, model):
    """(category, entity, explanation) of distinct (category, entity) requests."""
    texts = requests.withColumn("text", entity_text(F.col("category"), F.col("entity")))
    return ask(texts, "explain_entities", model).select(
        "category", "entity", py_strip(F.col("response")).alias("explanation"))


def split_with_model(texts, model, key="doc_id"):
    """(key, page_number, letters, letter_status); empty text and failed calls have no letters."""
    replies = ask(texts.select(key, "text"), "split_letters", model)
    checked = replies.withColumn("_r", parse_letters(F.col("response"), F.col("text")))
    none = F.expr("array()").cast("array<string>")
    failed = F.col("error").isNotNull()
    return checked.select(
        key, parse_page_number(F.col("text")).alias("page_number"),
        F.when(failed | (F.col("text") == ""), none)
        .otherwise(F.coalesce("_r.letters", none)).alias("letters"),
        F.when(failed, "failed").otherwise(F.col("_r.status")).alias("letter_status"))
