"""Folders listed and files read in tasks, those with hidden names and empty ones included.

Spark's own file sources list on the driver and hide names that begin with ``_`` or ``.``. Here every
folder is a row: a task lists it and the folders it finds are the rows of the next round, so
the driver sees one number per level and no file. Paths are opened with ``pyarrow.fs``, so the store has to be
one that Arrow knows (local, HDFS, S3, GCS, Azure).
"""

from __future__ import annotations

import io
import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import functions as F

from scriptorium.session import cut_lineage

_LISTED = "path string, name string, length bigint, modified timestamp, is_folder boolean"
# Folders that hold what a writer has not committed, or its log; they are never input.
UNCOMMITTED = r"^(_temporary|_delta_log|_spark_metadata|\.spark-staging.*|_staging-.*)$"
# Bytes of files that one task reads, and of a range of lines.
TASK_BYTES = 64 << 20
# Times its size that a packed file counts when tasks are dealt out.
UNPACKED = 8
# Content in a row batch that goes to Spark at once.
BATCH_BYTES = 16 << 20
_ARROW_SCHEME = {"s3a": "s3", "s3n": "s3"}


def qualified(spark, path):
    """The path with the scheme of the session's default file system, where it has none."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.makeQualified(where).toString()


def matched(spark, path):
    """The paths that a pattern stands for; a path without wildcards stands for itself if it exists."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [store.makeQualified(s.getPath()).toString() for s in store.globStatus(where) or []]


def opened(path):
    """The file system of a qualified path and the path inside it."""
    from pyarrow import fs
    scheme, _, rest = path.partition(":")
    scheme = _ARROW_SCHEME.get(scheme, scheme)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{scheme}:{rest}")


def _children(batches):
    from pyarrow import fs
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            store, root = opened(folder)
            info = store.get_file_info(root)
            found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(root))
            base = folder.rstrip("/")
            for start in range(0, len(found), 10_000):
                part = [i for i in found[start:start + 10_000] if i.type in (fs.FileType.File, fs.FileType.Directory)]
                own = info.type == fs.FileType.File
                yield pa.RecordBatch.from_arrays([
                    pa.array([base if own else f"{base}/{i.base_name}" for i in part], pa.string()),
                    pa.array([i.base_name for i in part], pa.string()),
                    pa.array([i.size or 0 for i in part], pa.int64()),
                    pa.array([i.mtime for i in part], pa.timestamp("us", "UTC")),
                    pa.array([i.type == fs.FileType.Directory for i in part], pa.bool_())],
                    ["path", "name", "length", "modified", "is_folder"])


def list_files(spark, path, recursive=False):
    """Files of a folder, or of all folders below it: path, name, length, modified.

    ``path`` may be a file or hold wildcards. Nothing is left out but what a writer has not committed
    (:data:`UNCOMMITTED`). Each level is one job, in which every folder is listed by one task.
    """
    folders = spark.createDataFrame([(p,) for p in matched(spark, path)], "path string")
    levels = []
    while True:
        tasks = max(1, spark.sparkContext.defaultParallelism)
        level = cut_lineage(folders.repartition(tasks, "path").mapInArrow(_children, _LISTED), "listed")
        levels.append(level.where("not is_folder"))
        folders = level.where(F.col("is_folder") & ~F.col("name").rlike(UNCOMMITTED)).select("path")
        if not recursive or folders.isEmpty():
            break
    return reduce(lambda a, b: a.unionAll(b), levels).drop("is_folder")


def _dealt(files, size):
    """Files over as many tasks as their bytes ask for, by a sum that Spark works out."""
    total = files.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    tasks = max(1, min(total.n, total.bytes // TASK_BYTES + 8))
    return files.repartition(int(tasks), F.xxhash64("path", *(["start"] if "start" in files.columns else [])))


def _bodies(batches):
    for batch in batches:
        rows, size = [], 0
        for i, path in enumerate(batch.column(0).to_pylist()):
            store, where = opened(path)
            with store.open_input_stream(where, compression=None) as stream:
                rows.append((i, stream.read()))
            size += len(rows[-1][1])
            if size >= BATCH_BYTES:
                yield _with(batch, rows)
                rows, size = [], 0
        if rows:
            yield _with(batch, rows)


def _with(batch, rows):
    taken = batch.take(pa.array([i for i, _ in rows]))
    return pa.RecordBatch.from_arrays([*taken.columns, pa.array([b for _, b in rows], pa.binary())], [*batch.schema.names, "content"])


def read_bodies(files):
    """Files (path, name, length, modified) with their ``content``, read in tasks."""
    return _dealt(files, "length").mapInArrow(_bodies, _LISTED.replace("is_folder boolean", "content binary"))


def _range_lines(batches):
    for batch in batches:
        for path, start, end in zip(*(batch.column(i).to_pylist() for i in range(3))):
            store, where = opened(path)
            packed, rows, size = end < 0, [], 0
            with io.BufferedReader(store.open_input_stream(where) if packed else store.open_input_file(where), 1 << 20) as stream:
                at = start
                if start:
                    # A line belongs to the range in which it begins: the rest of the line before is passed over.
                    stream.seek(start - 1)
                    at += len(stream.readline()) - 1
                while packed or at < end:
                    line = stream.readline()
                    if not line:
                        break
                    at, size = at + len(line), size + len(line)
                    rows.append(line.removesuffix(b"\n"))
                    if size >= BATCH_BYTES:
                        yield _lines(path, rows)
                        rows, size = [], 0
            if rows:
                yield _lines(path, rows)


def _lines(path, rows):
    texts = [r[:-1] if r.endswith(b"\r") else r for r in rows]
    return pa.RecordBatch.from_arrays([pa.array([path] * len(texts), pa.string()), pa.array(texts, pa.binary())], ["_file", "value"])


def read_lines(files, range_bytes=TASK_BYTES, further=None, schema="_file string, value binary"):
    """The lines of files as (_file, value as bytes), long files by many tasks: each reads a range of bytes.

    Files whose name ends with ``.gz`` are unpacked and read by one task each. ``further`` takes the row
    batches on in the same tasks, to rows of ``schema``.
    """
    read = _range_lines if further is None else lambda batches: further(_range_lines(batches))
    whole = F.col("name").rlike(r"\.gz$")
    ranges = F.transform(F.sequence(F.lit(0).cast("bigint"), F.greatest("length", F.lit(1)) - 1, F.lit(range_bytes).cast("bigint")),
                         lambda at: F.struct(at.alias("start"), F.least(at + range_bytes, "length").alias("end")))
    packed = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.lit(-1).cast("bigint").alias("end")))
    parts = files.where("length > 0").select("path", F.explode(F.when(whole, packed).otherwise(ranges)).alias("_r"), "length").select(
        "path", "_r.*", F.when(F.col("_r.end") < 0, F.col("length") * UNPACKED).otherwise(F.col("_r.end") - F.col("_r.start")).alias("size"))
    return _dealt(parts, F.greatest("size", F.lit(1))).select("path", "start", "end").mapInArrow(read, schema)


def below(path, root):
    """The part of a path below the folder it was listed from."""
    return F.regexp_replace(path, "^.*?" + re.escape(root.rstrip("/").removeprefix("file:")) + "/", "")
