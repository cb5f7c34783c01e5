"""WARC archives: records written by tasks, an index of them, and reads of byte ranges by the index.

Every task writes archives of its own, a gzip member per record, and returns one index row per record:
archive, offset, length, url and digest. The index of the tasks that were committed is the truth, so an
archive that a lost executor has begun is never read. Reading sorts the wanted index rows by archive
and offset and joins neighbouring records to one range read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import functions as F

from scriptorium.session import cut_lineage, work_dir

# Names and line ends of the format.
VERSION, END = b"WARC/1.1", b"\r\n"
RESPONSE, REVISIT = "response", "revisit"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# A new archive is begun beyond this; one read spans at most RANGE_BYTES and skips at most GAP_BYTES.
ARCHIVE_BYTES = 256 << 20
RANGE_BYTES, GAP_BYTES = 4 << 20, 64 << 10
LEVEL = 3
_DATE = "2000-01-01T00:00:00Z"
_CONTROL = re.compile(r"[\x00-\x20\x7f%]")


def payload_digest(payload):
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(fields):
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields if v is not None)]
    return END.join(lines) + END + END


def record(page, url, payload, digest, refers_to=None):
    """The bytes of a response record, or of a revisit record if ``refers_to`` is given.

    The block of a revisit is the HTTP header alone, which states the length of the full payload.
    """
    revisit = refers_to is not None
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
             + str(len(payload)).encode() + END + END + (b"" if revisit else payload))
    head = _header([
        ("WARC-Type", REVISIT if revisit else RESPONSE),
        ("WARC-Record-ID", f"<urn:page:{'' if page is None else page}>"),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", None if url is None else _CONTROL.sub(lambda m: f"%{ord(m.group()):02X}", url)),
        ("WARC-Payload-Digest", "sha1:" + digest),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", f"<urn:page:{refers_to}>" if revisit else None),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", len(block))])
    return head + block + END + END


def parse(data):
    """(header fields, block) of the bytes of one record; raises ValueError where they do not fit."""
    head, mark, rest = data.partition(END + END)
    lines = head.split(END)
    if not mark or lines[0] != VERSION:
        raise ValueError("not a WARC record")
    fields = {k.decode().lower(): v.strip().decode() for k, _, v in (line.partition(b":") for line in lines[1:])}
    length = int(fields["content-length"])
    if rest[length:] != END + END:
        raise ValueError("a WARC record of another length than stated")
    return fields, rest[:length]


def _gzip(data):
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


_INDEX = "page_id bigint, archive string, `offset` bigint, length bigint, url string, digest string, record_type string"
_INDEX_TYPES = [("page_id", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string())]


def _table(rows, types):
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(types)],
                                      [n for n, _ in types])


def _write(folder, archive_bytes):
    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        name = stream = None
        offset = 0
        for batch in batches:
            rows = []
            for page, url, html, refers_to in zip(*(batch.column(i) for i in range(4))):
                if stream is None:
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    store.create_dir(root, recursive=True)
                    stream = store.open_output_stream(f"{root}/{name}", compression=None)
                page, url, refers_to = page.as_py(), url.as_py(), refers_to.as_py()
                payload = (html.as_py() or "").encode("utf-8", "replace")
                digest = payload_digest(payload)
                data = _gzip(record(page, url, payload, digest, refers_to))
                stream.write(data)
                rows.append((page, name, offset, len(data), url, digest, RESPONSE if refers_to is None else REVISIT))
                offset += len(data)
                if offset >= archive_bytes:
                    stream.close()
                    stream = None
            yield _table(rows, _INDEX_TYPES)
        if stream is not None:
            stream.close()
    return run


def write_archives(pages, folder, min_bytes=0, page="page_id", url="url", html="html", archive_bytes=ARCHIVE_BYTES):
    """Write a record per row below ``folder`` (a URI that all executors share); returns the index.

    Of the rows with equal payloads of at least ``min_bytes`` bytes the one with the largest page id is a
    response and the others revisit it; smaller payloads are all responses. A null payload is empty.
    Rows that share the largest id, and all rows of a payload whose ids are all null, are responses.
    The largest ids are aggregated by digest from a scan of its own, so what is shuffled by a frequent
    payload is one row per task; only payloads that occur more than once are joined back, and Spark
    splits that join where a digest is frequent.
    """
    rows = pages.select(F.col(page).cast("bigint").alias("page_id"), F.col(url).alias("url"),
                        F.coalesce(F.col(html), F.lit("")).alias("html"))
    content = F.encode("html", "UTF-8")
    rows = rows.withColumn("sha1", F.sha1(content))
    repeated = cut_lineage(rows.where(F.octet_length("html") >= min_bytes).groupBy("sha1").agg(
        F.max("page_id").alias("latest"), F.count("*").alias("n")).where("n > 1").select("sha1", "latest"), "repeated")
    planned = rows.join(repeated, "sha1", "left").select(
        "page_id", "url", "html",
        F.when(F.coalesce(F.col("page_id") != F.col("latest"), F.col("latest").isNotNull()), F.col("latest")).alias("refers_to"))
    # Written at once: the archives are made when the index is, and only then.
    return cut_lineage(planned.mapInArrow(_write(folder, archive_bytes), _INDEX), "index")


_READ = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string")
_READ_TYPES = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
               ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())]


def ranges(rows, gap_bytes=GAP_BYTES, range_bytes=RANGE_BYTES):
    """Runs of index rows (archive, offset, length, …) that are read at once, in the order given."""
    run = []
    for row in rows:
        if run and (row[0] != run[-1][0] or row[1] - (run[-1][1] + run[-1][2]) > gap_bytes
                    or row[1] < run[-1][1] or row[1] + row[2] - run[0][1] > range_bytes):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def _page(name):
    found = name[len("<urn:page:"):-1] if name else ""
    return int(found) if found else None


def _read_back(data, url, digest):
    fields, block = parse(zlib.decompress(data, 31))
    head, _, body = block.partition(END + END)
    size = int(re.search(rb"(?i)^content-length: *(\d+)", head, re.MULTILINE).group(1))
    kind, stated = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    if stated != digest or kind == RESPONSE and (payload_digest(body) != digest or len(body) != size):
        raise ValueError(f"a damaged record of page {fields['warc-record-id']}")
    refers_to = _page(fields.get("warc-refers-to"))
    return _page(fields["warc-record-id"]), size, stated, kind, refers_to, url


def _read(folder):
    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        name = source = None

        def rows_of():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(5)))
        out = []
        for run_rows in ranges(rows_of()):
            archive, first = run_rows[0][0], run_rows[0][1]
            if archive != name:
                if source is not None:
                    source.close()
                name, source = archive, store.open_input_file(f"{root}/{archive}")
            last = run_rows[-1]
            data = source.read_at(max(r[1] + r[2] for r in run_rows) - first, first)
            for _, offset, length, url, digest in run_rows:
                out.append(_read_back(data[offset - first:offset - first + length], url, digest))
            if len(out) >= 1000:
                yield _table(out, _READ_TYPES)
                out = []
        if source is not None:
            source.close()
        yield _table(out, _READ_TYPES)
    return run


def read_records(index, folder):
    """Read the records of index rows: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    The rows are dealt out by ranges of (archive, offset), sorted, and neighbours are read together. A
    payload is compared with its digest; a record that does not fit its index row is an error. Length
    and digest of a revisit are those of the full payload, as its header states them.
    """
    wanted = index.select("archive", "offset", "length", "url", "digest")
    return wanted.repartitionByRange("archive", "offset").sortWithinPartitions("archive", "offset").mapInArrow(
        _read(folder), _READ)


def archive_folder(spark):
    """A new folder for archives where all executors can write."""
    return work_dir(spark, "warc")
