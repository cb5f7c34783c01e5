"""Runs over newly arrived files, in batches of a fixed number of files."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.sources.sinks import write_table

# A file stream needs its schema named; this is the one of the binary file source.
BINARY_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def incremental_run(spark, source, out, checkpoint, process, batch_size=5, fmt="binaryFile",
                    schema=None, options=None):
    """Process all files not seen before, ``batch_size`` at a time, and stop.

    ``process(batch) -> dict of tables`` is a batch plan; each table goes to ``out/<name>`` under
    its batch number. The checkpoint remembers finished files, and a batch that runs twice
    replaces its own output, so every file counts once. Spark knows a file by its path: a changed file
    has to come under a new path. A document that comes again is in several batches; :func:`current`
    reads its last version.
    """
    reader = spark.readStream.format(fmt).option("maxFilesPerTrigger", batch_size)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    if schema is None and fmt == "binaryFile":
        schema = BINARY_FILES
    if schema is not None:
        reader = reader.schema(schema)

    def run_batch(batch, batch_id):
        for name, table in process(batch).items():
            write_table(table, f"{out}/{name}", batch_id)

    query = (reader.load(source).writeStream.foreachBatch(run_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def current(spark, path, key):
    """The rows of the last batch in which each ``key`` came, from a table that a run has written.

    The last batches are aggregated before they meet the rows, so a document with very many rows is
    not gathered in one task.
    """
    rows = spark.read.parquet(path)
    last = rows.groupBy(key).agg(F.max("batch_id").alias("batch_id"))
    return rows.join(last, [key, "batch_id"], "left_semi")
