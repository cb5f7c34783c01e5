"""Result tables and per-document files."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import functions as F

from scriptorium.functions.replies import to_json_record
from scriptorium.session import cut_lineage
from scriptorium.sources.listing import opened, qualified


def write_table(df, path, batch_id=None):
    """Write a result table. With a ``batch_id`` only that batch is replaced, so a retried batch
    leaves one copy; without one the whole table is replaced."""
    if batch_id is None:
        df.write.mode("overwrite").parquet(path)
    else:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_text(df, path, batch_id=None):
    """Raw and corrected texts, one row per document, replacing an earlier version."""
    write_table(df, path, batch_id)


def write_json(df, path, key="doc_id"):
    """One JSON object per line and document; NULL fields stay, non-ASCII is not escaped."""
    df.select(to_json_record(*df.columns).alias("value")).write.mode("overwrite").text(path)


def export_text(df, path, name, text, buckets=64):
    """Whole texts as files with their exact characters: ``<bucket>/<name>.txt`` below ``path``.

    Names are dealt out over a fixed number of folders, whatever the number of documents.
    """
    folder = F.concat(F.lit("part-"), F.pmod(F.xxhash64(F.col(name)), F.lit(buckets)).cast("string"))
    rows = df.select(F.concat_ws("/", folder, F.col(name).cast("string")).alias("name"), F.col(text).alias("text"))
    write_files(rows, path, "name", "text", ".txt", nested=False)


def _staged(folder, ending, nested):
    def write(batches):
        import uuid
        for batch in batches:
            names, targets = batch.column(0).to_pylist(), []
            for name, text in zip(names, batch.column(1).to_pylist()):
                store, root = opened(folder)
                place = f"{name}/{name}{ending}" if nested else f"{name}{ending}"
                staged = f"{uuid.uuid4().hex}"
                with store.open_output_stream(f"{root}/{staged}", compression=None) as stream:
                    stream.write((text or "").encode())
                targets.append((staged, place))
            yield pa.RecordBatch.from_arrays([pa.array([t[i] for t in targets], pa.string()) for i in (0, 1)], ["staged", "place"])
    return write


def _published(folder, path):
    def move(batches):
        from pyarrow import fs
        for batch in batches:
            for staged, place in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (store, source), (_, root) = opened(folder), opened(path)
                source, target = f"{source}/{staged}", f"{root}/{place}"
                # A task that runs again finds what it has moved already.
                if store.get_file_info(source).type == fs.FileType.File:
                    store.create_dir(target.rpartition("/")[0], recursive=True)
                    store.move(source, target)
            yield batch
    return move


def write_files(df, path, name, text, ending, nested=True):
    """One file per row, ``<name>/<name><ending>`` or ``<name><ending>`` below ``path``: all of them or none.

    Tasks write into a folder of staged files and put their names into a table, so Spark's own commit
    decides which attempt of a task counts. Only when that table is whole do tasks move its files to
    their places. What lost or speculative attempts have left is removed with the folder, also when the
    first step fails, which then has replaced nothing. A path without scheme lies in the session's default file system.
    Returns the number of files.
    """
    spark = df.sparkSession
    path = qualified(spark, path)
    folder = f"{path}/_staging-{uuid.uuid4().hex}"
    store, root = opened(folder)
    store.create_dir(root, recursive=True)
    try:
        rows = df.select(F.col(name).cast("string").alias("name"), F.col(text).alias("text"))
        staged = cut_lineage(rows.mapInArrow(_staged(folder, ending, nested), "staged string, place string"), "staged")
        moved = staged.mapInArrow(_published(folder, path), "staged string, place string")
        moved.write.format("noop").mode("overwrite").save()
        return staged.count()
    finally:
        store.delete_dir(root)
