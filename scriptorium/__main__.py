"""Command line: a whole run over stored OCR results or text files.

    spark-submit --py-files scriptorium.zip scriptorium_run.py --responses DIR --output DIR ...
"""

from __future__ import annotations

import argparse
import importlib
import time

from pyspark.sql import functions as F

from scriptorium.functions.files import base_name, is_supported_file
from scriptorium.functions.text import split_lines
from scriptorium.operators import layout
from scriptorium.operators.status import FAILED, last_wins, run_summary
from scriptorium.plans.batches import batches_summary, current_table, run_in_batches
from scriptorium.plans.document_run import (
    TABLES, RunConfig, document_run, export_documents, write_document_run, write_json_records)
from scriptorium.plans.model_tasks import Model
from scriptorium.session import build_session, cut_lineage
from scriptorium.sources import documents, ocr, sinks
from scriptorium.sources.listing import below, list_files

BATCH_SIZE = 5


def options(arguments=None):
    parser = argparse.ArgumentParser(prog="scriptorium", description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--responses", help="folder of OCR response pages (JSON)")
    source.add_argument("--layouts", help="folder of layout results (JSON)")
    source.add_argument("--texts", help="folder of text files")
    parser.add_argument("--output", required=True)
    parser.add_argument("--lexicon", help="table (wrong, right)")
    parser.add_argument("--pairs", help="table (raw, corrected) of texts that teach the correction, instead of a lexicon")
    parser.add_argument("--gazetteer", help="table (category, name)")
    parser.add_argument("--knowledge", help="table (category, entity, explanation)")
    parser.add_argument("--backend", help="model back end instead of the three tables")
    parser.add_argument("--backend-module", help="module that registers the back end")
    parser.add_argument("--prompts", help="prompt catalog (JSON)")
    parser.add_argument("--layout", default="system_and_user")
    parser.add_argument("--model-name", default="")
    parser.add_argument("--attempts", type=int, default=1)
    parser.add_argument("--tasks", type=int, help="tasks that call the model")
    parser.add_argument("--threads", type=int, default=4, help="calls per task at a time")
    parser.add_argument("--timeout", type=float, help="seconds to wait for a reply")
    parser.add_argument("--backoff", type=float, default=0.0, help="seconds before a call is repeated, doubled each time")
    parser.add_argument("--rate", type=float, help="calls a second, over all tasks")
    parser.add_argument("--replies", help="folder in which replies are kept; those in it are not asked for again")
    parser.add_argument("--json-lines", action="store_true", help="every line of the JSON files is an object; long files are split")
    parser.add_argument("--batch-size", type=int, help="documents of a batch; a run that was killed goes on with its batch")
    parser.add_argument("--incremental", action="store_true", help="only documents with new or changed files, in batches")
    parser.add_argument("--export-files", action="store_true",
                        help="also write loose files per document below --output")
    return parser.parse_args(arguments)


def document_key(path, root):
    """Path of a file below the input folder without its extension: names in two folders differ."""
    rest = below(path, root)
    folder = F.regexp_extract(rest, "^(.*/)?", 0)
    return F.concat(folder, base_name(F.substring_index(rest, "/", -1)))


def input_files(spark, chosen):
    """All files of the input (path, name, length, modified) with their unit: what has to be read together."""
    if chosen.texts:
        files = list_files(spark, chosen.texts, recursive=True).where(is_supported_file(F.col("name"), (".txt",)))
        return files.withColumn("unit", document_key(F.col("path"), chosen.texts))
    unit = ocr.file_unit(F.col("path")) if chosen.responses else F.col("path")
    return ocr.json_files(spark, chosen.responses or chosen.layouts).withColumn("unit", unit)


def read_input(chosen, files):
    """Documents of the files, their lines, their jobs (outcome and reason) and their boxes where there are any."""
    files = files.withColumn("name", F.substring_index("path", "/", -1)).select("path", "name", "length", "modified")
    if chosen.texts:
        found = documents.text_bodies(files).select(
            document_key(F.col("path"), chosen.texts).alias("doc_id"), "path", "text")
        # Of files with one name and several spellings of the ending the last one counts.
        texts = last_wins(cut_lineage(found, "texts"), "doc_id", ["path"])
        jobs = texts.where(F.col("text").isNull()).select(
            "doc_id", F.lit("not_utf8").alias("reason"), F.lit(FAILED).alias("outcome"))
        lines = texts.select("doc_id", F.lit(1).alias("page"),
                             F.posexplode(split_lines(F.col("text"))).alias("line_no", "text"))
        return texts.select("doc_id"), lines, jobs, None
    if chosen.layouts:
        results = cut_lineage(ocr.layout_results(files, chosen.json_lines), "layouts")
        jobs = results.where("corrupt").select(
            "doc_id", F.lit(FAILED).alias("outcome"), F.lit("unreadable_page").alias("reason")).distinct()
        lines = layout.flatten_layout(results)
        boxes = layout.collect_boxes(lines, "doc_id", ("line_no",), ("page", "text", "polygon"))
        return results.select("doc_id"), lines, jobs, boxes
    # Read once, used for lines, boxes and outcomes.
    pages = cut_lineage(ocr.response_pages(files, chosen.json_lines), "pages").withColumnRenamed("job_id", "doc_id")
    jobs = ocr.incomplete_jobs(pages.withColumnRenamed("doc_id", "job_id")).withColumnRenamed("job_id", "doc_id")
    blocks = ocr.explode_blocks(pages.withColumnRenamed("doc_id", "job_id")).withColumnRenamed("job_id", "doc_id")
    lines = layout.ocr_lines(blocks).withColumnsRenamed({"page_ord": "page", "block_ord": "line_no"})
    return pages.select("doc_id"), lines, jobs, layout.page_boxes(pages, "doc_id")


def processing(spark, chosen):
    """Function from input files to result tables, with the tables and the model that the options name."""
    config = RunConfig(output=chosen.output, materialise=True, export=chosen.export_files)
    if chosen.backend:
        if chosen.backend_module:
            importlib.import_module(chosen.backend_module)
        model = Model(chosen.backend, documents.read_prompts(spark, chosen.prompts), chosen.layout,
                      chosen.model_name, chosen.attempts, chosen.tasks, chosen.threads, None, chosen.timeout,
                      chosen.backoff, chosen.rate, chosen.replies)
        rules = (None, None, None)
    else:
        model = None
        table = lambda path, schema: (spark.read.parquet(path) if path
                                      else spark.createDataFrame([], schema))
        rules = (table(chosen.lexicon, "wrong string, right string"),
                 table(chosen.gazetteer, "category string, name string"),
                 table(chosen.knowledge, "category string, entity string, explanation string"))

    pairs = spark.read.parquet(chosen.pairs) if chosen.pairs and model is None else None

    def process(files):
        found, lines, jobs, boxes = read_input(chosen, files)
        tables = document_run(found, lines, *rules, config=config, jobs=jobs, model=model, pairs=pairs)
        if chosen.export_files:
            export_documents(tables, chosen.output)
        if boxes is not None:
            tables["boxes"] = boxes
        return tables
    return process


def run(spark, chosen):
    """The run that the options ask for; returns its summary."""
    started = time.time()
    files, process = input_files(spark, chosen), processing(spark, chosen)
    if chosen.batch_size or chosen.incremental:
        size = chosen.batch_size or BATCH_SIZE
        done = run_in_batches(spark, files, chosen.output, process, size, (*TABLES, "boxes"), chosen.incremental)
        summary = batches_summary(done, size)
        read = {name: current_table(spark, chosen.output, name) for name in ("entity_records", "explanations", "combined", "boxes")
                if name != "boxes" or not chosen.texts}
        if done.isEmpty():
            return summary
    else:
        tables = process(files)
        write_document_run(tables, chosen.output)
        read = {name: spark.read.parquet(f"{chosen.output}/{name}") for name in tables}
        status = read["doc_status"].withColumns({
            "started": F.timestamp_seconds(F.lit(started)),
            "finished": F.timestamp_seconds(F.lit(time.time()))})
        # The whole input is one batch.
        summary = run_summary(status, 1).select(
            "n_files", F.when(F.col("n_files") > 0, 1).otherwise(0).cast("bigint").alias("n_batches"),
            F.col("n_files").alias("batch_size"), "n_success", "n_failed", "elapsed")
    write_json_records(read, chosen.output)
    if "boxes" in read:
        sinks.write_json(read["boxes"], f"{chosen.output}/coords_json")
    return summary


def main():
    """Entry point of the launcher script."""
    run(build_session(), options()).show(truncate=False)


if __name__ == "__main__":
    main()
