"""Runs in batches of documents, with a ledger that says which files every batch has taken.

The ledger is a table with one row per file and committed batch. A run takes the documents that have a file
the ledger does not know in this state (path, time of change, length), so a changed file is taken again under its own path, and a
run that was killed goes on with the batch that it had not committed, whose output is replaced.
"""

from __future__ import annotations

import logging
import time

from pyspark.sql import Observation, functions as F

from scriptorium.functions.text import format_elapsed
from scriptorium.operators.numbering import assign_batches
from scriptorium.operators.status import SUCCEEDED
from scriptorium.session import cut_lineage, read_or_empty
from scriptorium.sources.listing import opened, qualified
from scriptorium.sources.sinks import write_table

STATE = ("path", "modified", "length")
LEDGER, BATCHES = "run_ledger", "run_batches"
_LEDGER = "unit string, path string, modified timestamp, length bigint, batch_id int"
_BATCHES = ("batch_id int, n_files bigint, n_documents bigint, n_failed bigint, started timestamp, finished timestamp")
log = logging.getLogger(__name__)


def pending(files, ledger):
    """Files of the units of which some file is new or has changed; ``files`` have a unit and their state."""
    known = ledger.select(*STATE).distinct()
    fresh = files.join(known, list(STATE), "left_anti").select("unit").distinct()
    return files.join(fresh, "unit", "left_semi")


def numbered(files, batch_size, first):
    """``files`` with the batch of their unit: ``batch_size`` units at a time in order of their name."""
    units = assign_batches(files.select("unit").distinct(), batch_size, ["unit"])
    return files.join(units.select("unit", (F.col("batch_id") + first).cast("int").alias("batch_id")), "unit")


def remove_tables(spark, out, names):
    """Remove what an earlier run has written to tables that this one writes anew."""
    for name in names:
        store, root = opened(qualified(spark, f"{out}/{name}"))
        if store.get_file_info(root).type.name == "Directory":
            store.delete_dir(root)


def run_in_batches(spark, files, out, process, batch_size, tables, incremental=False):
    """Run ``process`` over batches of units and return the batches of this run, one row each.

    ``files`` (unit, path, modified, length) are all files of the input; all files of a unit are in one
    batch. ``process(files of a batch)`` gives tables by name, ``doc_status`` among them, of which each is written to ``out`` under
    the number of the batch; ``tables`` names them. The rows of the batch go to the ledger last: that commits it. Without
    ``incremental`` earlier output and ledger are removed first, unless the last run was not finished.
    """
    ledger = read_or_empty(spark, f"{out}/{LEDGER}", _LEDGER)
    if not incremental and not _unfinished(spark, out):
        remove_tables(spark, out, [*tables, LEDGER, BATCHES])
        ledger = spark.createDataFrame([], _LEDGER)
    todo = cut_lineage(pending(files.select("unit", *STATE), ledger), "pending")
    last = ledger.agg(F.max("batch_id")).first()[0]
    first = 0 if last is None else last + 1
    todo = cut_lineage(numbered(todo, batch_size, first), "numbered")
    _mark(spark, out, True)
    count = todo.agg(F.max("batch_id")).first()[0]
    for batch_id in range(first, first if count is None else count + 1):
        started = time.time()
        mine = todo.where(F.col("batch_id") == batch_id)
        seen = Observation(f"batch {batch_id}")
        made = process(mine.drop("batch_id"))
        for name, table in made.items():
            if name == "doc_status":
                table = table.observe(seen, F.count("*").alias("documents"), F.count_if(F.col("status") != SUCCEEDED).alias("failed"))
            write_table(table, f"{out}/{name}", batch_id)
        n_files = mine.count()
        row = (batch_id, n_files, seen.get["documents"], seen.get["failed"])
        done = spark.createDataFrame([row], _BATCHES.split(", started")[0]).select(
            "*", F.timestamp_seconds(F.lit(started)).alias("started"), F.timestamp_seconds(F.lit(time.time())).alias("finished"))
        write_table(done.drop("batch_id"), f"{out}/{BATCHES}", batch_id)
        write_table(mine.drop("batch_id"), f"{out}/{LEDGER}", batch_id)
        log.info("batch %d: %d files, %d documents, %d failed", *row)
    _mark(spark, out, False)
    return read_or_empty(spark, f"{out}/{BATCHES}", _BATCHES).where(F.col("batch_id") >= first)


def _mark(spark, out, running):
    """A file that stands as long as a run has batches left."""
    store, root = opened(qualified(spark, out))
    store.create_dir(root, recursive=True)
    if running:
        with store.open_output_stream(f"{root}/run_unfinished", compression=None) as stream:
            stream.write(b"")
    elif _unfinished(spark, out):
        store.delete_file(f"{root}/run_unfinished")


def _unfinished(spark, out):
    store, root = opened(qualified(spark, out))
    return store.get_file_info(f"{root}/run_unfinished").type.name == "File"


def batches_summary(batches, batch_size):
    """The summary of a run from its batches, in the columns of :func:`operators.status.run_summary`."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    seconds = F.unix_seconds(F.max("finished")) - F.unix_seconds(F.min("started"))
    return batches.agg(
        total("n_documents").alias("n_files"), F.count("*").cast("bigint").alias("n_batches"),
        F.lit(batch_size).cast("bigint").alias("batch_size"),
        (total("n_documents") - total("n_failed")).cast("bigint").alias("n_success"), total("n_failed").alias("n_failed"),
        format_elapsed(F.coalesce(seconds, F.lit(0))).alias("elapsed"))


def current_table(spark, out, name, key="doc_id"):
    """The rows of a table that belong to the last batch in which their document came.

    The last batch of a document is the one of ``doc_status``, which has a row for it in every batch, so
    rows of an earlier version are gone also where the later one has none.
    """
    last = spark.read.parquet(f"{out}/doc_status").groupBy(key).agg(F.max("batch_id").alias("batch_id"))
    return spark.read.parquet(f"{out}/{name}").join(last, [key, "batch_id"], "left_semi").drop("batch_id")
