"""Stages of the corpus pipeline: each takes documents and returns those it keeps, in the same columns.

Rows travel as one struct, so a column of any name passes. A stage uses doc_id, text and source; what
it does with nulls, empty texts and repeated rows is what its operator says.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.llm import decontaminate, mixing, near_copies, pii, quality
from scriptorium.llm.rows import packed, same_row
from scriptorium.session import cut_lineage


def _held_out(column, n, remainder):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n == remainder, F.lit(False))


def quality_stage(spark, docs, sf_dir):
    """Documents that the quality classifier does not reject; it learns from labelled rows of ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit_quality(docs.where(~_held_out("doc_id", 3, 1)), labels)
    scored = quality.score_quality(packed(docs, "text"), model, keep=("_doc",))
    return scored.where("predicted = 1").select("_doc.*")


def near_copies_stage(spark, docs, sf_dir):
    """One document of each group of near copies, the one with the least doc_id; the others go.

    Rows whose text is null or has no word all stay.
    """
    kept = near_copies.near_copies(docs).where("stays").groupBy(F.xxhash64("doc_id", "_h").alias("_row")).agg(
        F.max("has_words").alias("has_words"))
    rows = packed(docs, F.xxhash64("doc_id", F.xxhash64("text")).alias("_row")).join(kept, "_row")
    # Rows of one id and one text with words are copies, of which one stays; a row without a word has a number of its own.
    own = F.when(~F.col("has_words"), F.monotonically_increasing_id())
    return rows.withColumn("_own", own).dropDuplicates(["_row", "_own"]).select("_doc.*")


def decontamination_stage(spark, docs, sf_dir):
    """Documents that share no window with a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.decontaminate(docs, benchmark).where("contaminated").select("doc_id", "_h").distinct()
    found = cut_lineage(found, "contaminated")
    rows = packed(docs, "doc_id", F.xxhash64("text").alias("_h"))
    return rows.join(found, same_row(rows, found), "left_anti").select("_doc.*")


def pii_stage(spark, docs, sf_dir):
    """All documents, personal data in their texts replaced by its kind; n_chars follows the text."""
    clean = pii.redact_pii(docs)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.coalesce(length, "n_chars"))
    return clean


def mixing_stage(spark, docs, sf_dir):
    """The documents that the mix takes, with size, source_size, target and taken (tokens, repeats counted).

    Every document is one row, however often it is taken: the rows have the target weights only if each
    counts taken / size times.
    """
    rows = cut_lineage(packed(docs, F.monotonically_increasing_id().alias("_row")), "rows")
    flat = rows.select("_row", *[F.col(f"_doc.{c}").alias(c) for c in ("doc_id", "source", "text")])
    mixed = mixing.mix_sources(flat, mixing.word_count(F.col("text")), keep=("_row",))
    added = ("size", "source_size", "target", "taken")
    taken = mixed.select("_row", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")).where("taken > 0")
    return rows.join(taken, "_row").select(*[F.col(f"_doc.`{c}`") for c in docs.columns if c not in added], *added)
