"""OCR results: response pages with blocks, and layout results with pages and lines."""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyspark.sql import functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from scriptorium.functions.replies import is_json
from scriptorium.sources.listing import list_files, read_bodies, read_lines

# Record shapes of the OCR results.
BOX = "struct<Left:double,Top:double,Width:double,Height:double>"
RESPONSE_PAGE = (
    "JobStatus string, StatusMessage string, NextToken string, "
    "Blocks array<struct<BlockType:string,Text:string,Confidence:double,"
    f"Geometry:struct<BoundingBox:{BOX}>>>")
LAYOUT_RESULT = "doc_id string, pages array<struct<lines:array<struct<content:string,polygon:array<double>>>>>"

_PAGE_FILE = r"([^/]+)/([0-9]+)(?:\.json)?$"


def read_response_pages(spark, path, lines=False):
    """Response pages of OCR jobs, one row per page: job_id, page_ord, Blocks, status, corrupt.

    The JSON holds ``job_id`` and ``page_ord`` next to the response, or the file is called
    ``<job_id>/<page number>``. What cannot be read is a row with ``corrupt`` set, under the name of
    its file. ``lines`` as in :func:`json_records`.
    """
    return response_pages(json_files(spark, path), lines)


def response_pages(files, lines=False):
    """:func:`read_response_pages` of listed files."""
    pages = json_records(files, f"job_id string, page_ord bigint, {RESPONSE_PAGE}", lines)
    return pages.select(
        F.coalesce("job_id", F.regexp_extract("_file", _PAGE_FILE, 1)).alias("job_id"),
        F.coalesce("page_ord", F.regexp_extract("_file", _PAGE_FILE, 2).try_cast("bigint"))
        .alias("page_ord"),
        "Blocks", "JobStatus", "StatusMessage", "NextToken", "corrupt")


def json_files(spark, path):
    """Files of a folder and all below it that hold JSON: those called so, and others that are not hidden."""
    name = F.col("name")
    return list_files(spark, path, recursive=True).where(
        ~name.startswith("._") & (F.lower(name).rlike(r"\.json(\.gz)?$") | ~name.rlike("^[_.]")))


# What Arrow reads other than Spark does, or takes for JSON: a whole -0, numbers that are none, halves of characters.
# A hint is looked for first, and only where it stands the pattern.
_ODD = ((b"-0", re.compile(rb"-0\s*[,}\]]")), (b"NaN", re.compile(rb"[:,\[]\s*-?NaN")), (b"Inf", re.compile(rb"[:,\[]\s*-?Inf")),
        (b"\\u", re.compile(rb"\\u[dD]")))
# The reader of Arrow takes a block with a size of 32 bits.
_LARGEST_BLOCK = 1 << 30


def _is_plain(line):
    """Whether a line may be an object that Arrow reads just as Spark does."""
    if not line.startswith(b"{") or any(hint in line and odd.search(line) for hint, odd in _ODD):
        return False
    try:
        line.decode()
    except UnicodeDecodeError:
        return False
    return True


def _read_plain(lines, schema, key):
    """Lines as a struct array with a record each; None if one of them is anything but one object of this shape."""
    from pyarrow import json
    # Every line gets its number under a key that no line knows, so no object ends in another line than its own.
    data = b"\n".join([b'{"%s":%d,%s' % (key, n, line[1:]) for n, line in enumerate(lines)])
    if len(data) >= _LARGEST_BLOCK:
        return None
    try:
        read = json.read_json(pa.BufferReader(data), json.ReadOptions(use_threads=False, block_size=len(data) + 1), json.ParseOptions(
            explicit_schema=schema.append(pa.field(key.decode(), pa.int64())), unexpected_field_behavior="error"))
    except pa.ArrowException:
        return None
    if read.column(key.decode()).to_pylist() != [*range(len(lines))]:
        return None
    batch, = read.select(schema.names).combine_chunks().to_batches()
    return batch.to_struct_array()


def _read_parts(lines, schema, key):
    """Struct arrays that together have a row for each line, null for lines that are left to Spark."""
    if not lines:
        return []
    if (found := _read_plain(lines, schema, key)) is not None:
        return [found]
    if len(lines) == 1:
        return [pa.nulls(1, pa.struct(schema))]
    half = len(lines) // 2
    return [*_read_parts(lines[:half], schema, key), *_read_parts(lines[half:], schema, key)]


def _parsed(schema):
    """Lines (_file, value) with ``_record``, the object that a line is; those with a record lose their value.

    Arrow reads what is surely an object of this shape, many times faster than Spark does. All else keeps its value.
    """
    kind = pa.struct(schema)

    def run(batches):
        key = f"_{uuid.uuid4().hex}".encode()
        for batch in batches:
            lines = batch.column(1).to_pylist()
            parts, some = [], []
            for line in lines:
                if _is_plain(line):
                    some.append(line)
                else:
                    parts += [*_read_parts(some, schema, key), pa.nulls(1, kind)]
                    some = []
            parts += _read_parts(some, schema, key)
            records = pa.concat_arrays([p.cast(kind) for p in parts]) if parts else pa.nulls(0, kind)
            values = pa.array([None if known else line for known, line in zip(records.is_valid().to_pylist(), lines)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), values, records], ["_file", "value", "_record"])
    return run


def json_records(files, schema, lines=False):
    """JSON objects of the given shape in listed files, with ``_file`` and ``corrupt``; nothing unreadable is dropped.

    By default a file is one object or a list of them, over any number of lines; a file that is
    neither is read line by line. With ``lines`` every line of every file is an object, and long files
    are read by many tasks. Hidden names and folders are read too; bytes that are not UTF-8 are a corrupt record.
    """
    shape = T.StructType.fromDDL(schema)
    record = f"struct<{', '.join(f'{f.name}:{f.dataType.simpleString()}' for f in shape)}>"
    if lines:
        texts = read_lines(files, further=_parsed(to_arrow_schema(shape)), schema=f"_file string, value binary, _record {record}")
    else:
        texts = read_bodies(files).select(
            F.col("path").alias("_file"), F.col("content").alias("value"), F.lit(None).cast(record).alias("_record"))
    texts = texts.select("_file", "_record", F.coalesce(F.try_validate_utf8(F.col("value").cast("string")), F.lit("")).alias("value"))
    if not lines:
        own = F.filter(F.split("value", "\r?\n"), lambda line: F.trim(line) != "")
        texts = texts.select("_file", "_record", F.explode_outer(
            F.when(is_json(F.col("value")), F.array("value")).otherwise(own)).alias("value"))
    text = F.coalesce("value", F.lit(""))
    read = texts.select("_file", F.when(F.col("_record").isNotNull(), F.array("_record")).when(
        is_json(text), F.from_json("value", f"array<{record}>")).alias("_read"))
    return read.select("_file", F.col("_read").isNull().alias("corrupt"), F.explode_outer("_read").alias("_r")).select(
        "_file", "corrupt", "_r.*")


def file_unit(path):
    """What has to be read together with a page file: its job's folder, or the file itself."""
    return F.when(path.rlike("/" + _PAGE_FILE), F.regexp_replace(path, "/[^/]+$", "")).otherwise(path)


def incomplete_jobs(pages):
    """Jobs that were not read in full: (job_id, outcome, reason).

    A job is complete if all of its pages could be read, its page numbers have no hole, none stands
    twice, and its last page names no further one. A status other than success is a failure too,
    with the service's message as its reason.
    """
    last = F.max_by("NextToken", "page_ord")
    per_job = pages.groupBy("job_id").agg(
        F.max(F.coalesce("corrupt", F.lit(False))).alias("corrupt"), last.alias("more"),
        (F.max("page_ord") - F.min("page_ord") + 1 != F.count("page_ord")).alias("holes"),
        F.max(F.when(~F.col("JobStatus").isin("SUCCEEDED", "PARTIAL_SUCCESS"), F.struct(
            F.col("JobStatus").alias("status"), F.col("StatusMessage").alias("message")))).alias("bad"))
    reason = (F.when(F.col("bad").isNotNull(), F.coalesce("bad.message", F.lower("bad.status")))
              .when(F.col("corrupt"), "unreadable_page")
              .when(F.col("more").isNotNull() | F.col("holes"), "incomplete_pages"))
    return per_job.select("job_id", reason.alias("reason")).where(F.col("reason").isNotNull()).select(
        "job_id", F.lit("FAILED").alias("outcome"), "reason")


def explode_blocks(pages):
    """One row per block, ordered inside a job by (page_ord, block_ord)."""
    return (pages.select("job_id", "page_ord", F.posexplode("Blocks").alias("block_ord", "_b"))
            .select("job_id", "page_ord", "block_ord",
                    F.col("_b.BlockType").alias("block_type"),
                    F.col("_b.Text").alias("text"),
                    F.col("_b.Confidence").alias("confidence"),
                    F.col("_b.Geometry.BoundingBox").alias("box")))


def read_ocr_pages(spark, path, lines=False):
    return explode_blocks(read_response_pages(spark, path, lines))


def read_layout_results(spark, path, lines=False):
    """Layout results, one row per document, for :func:`operators.layout.flatten_layout`.

    An unreadable file is a document called like the file, without pages and with ``corrupt`` set.
    """
    return layout_results(json_files(spark, path), lines)


def layout_results(files, lines=False):
    """:func:`read_layout_results` of listed files."""
    results = json_records(files, LAYOUT_RESULT, lines)
    name = F.regexp_replace(F.substring_index("_file", "/", -1), r"\.json$", "")
    return results.select(F.coalesce("doc_id", name).alias("doc_id"), "pages", "corrupt")


def unified_boxes(words, lines):
    """Word boxes and line boxes in one shape: word boxes have no page, line boxes no confidence."""
    word_rows = words.select(
        F.col("job_id").alias("doc_id"), F.lit(None).cast("int").alias("page"),
        F.lit("word").alias("level"), F.struct("page_ord", F.col("block_ord").cast("bigint")
                                               .alias("pos")).alias("ord"),
        "text", "confidence", F.array("box.Left", "box.Top", "box.Width", "box.Height").alias("box"))
    line_rows = lines.select(
        F.col("doc_id").cast("string").alias("doc_id"), "page", F.lit("line").alias("level"),
        F.struct(F.col("page").cast("bigint").alias("page_ord"),
                 F.col("line_no").cast("bigint").alias("pos")).alias("ord"),
        "text", F.lit(None).cast("double").alias("confidence"), F.col("polygon").alias("box"))
    return word_rows.unionByName(line_rows)
