import json

import pytest

from pyspark.sql import functions as F

from scriptorium.operators import layout
from scriptorium.session import cut_lineage, work_dir
from scriptorium.sources import documents, listing, ocr, sinks


def test_scan_documents(spark, tmp_path):
    for name in ("a.JPG", "b b.pdf", "c.txt", "._d.png", "e.tiff"):
        (tmp_path / name).write_bytes(b"12345")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "f.png").write_bytes(b"1")
    files = documents.scan_documents(spark, str(tmp_path))
    assert files.columns == ["path", "name", "length"]
    assert sorted((r.name, r.length) for r in files.collect()) == [("a.JPG", 5), ("b b.pdf", 5), ("e.tiff", 5)]
    deep = documents.scan_documents(spark, str(tmp_path), with_content=True, recursive=True)
    assert {r.name: bytes(r.content) for r in deep.collect()}["f.png"] == b"1"


def test_read_text(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("é\r\nx\ry\n".encode())
    (tmp_path / "b.txt").write_bytes(b"\xff\xfe")
    got = {r.name: r.text for r in documents.read_text(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": "é\nx\ny\n", "b.txt": None}


def test_read_prompts(spark, tmp_path):
    catalog = {"correct_text": "fix", "split_letters": "split"}
    (tmp_path / "p.json").write_text(json.dumps(catalog, indent=2))
    assert dict(map(tuple, documents.read_prompts(spark, str(tmp_path / "p.json")).collect())) == catalog
    assert {r.task for r in documents.read_prompts(spark).collect()} == {
        "correct_text", "extract_entities", "explain_entities", "split_letters"}


def block(kind, text, left=None):
    box = {"BoundingBox": {"Left": left, "Top": 0.5, "Width": 1.0, "Height": 2.0}}
    return {"BlockType": kind, "Text": text, "Confidence": 90.5, "Geometry": box, "Id": "ignored"}


def test_read_ocr_pages_from_job_folders(spark, tmp_path):
    job = tmp_path / "job 1"
    job.mkdir()
    pages = [[block("PAGE", None), block("LINE", "a b"), block("WORD", "a", .1), block("WORD", "b", .2)],
             [block("LINE", "c"), block("WORD", "c", .3)]]
    for i in range(12):
        page = {"JobStatus": "SUCCEEDED", "NextToken": str(i), "Blocks": pages[i] if i < 2 else []}
        (job / str(i + 1)).write_text(json.dumps(page))
    blocks = ocr.read_ocr_pages(spark, str(tmp_path))
    words = layout.ocr_words(blocks).orderBy("page_ord", "block_ord").collect()
    assert [(w.page_ord, w.text, w.confidence, w.box.Left) for w in words] == [
        (1, "a", 90.5, .1), (1, "b", 90.5, .2), (2, "c", 90.5, .3)]
    assert [r.text for r in layout.ocr_lines(blocks).orderBy("page_ord").collect()] == ["a b", "c"]
    raw = layout.assemble_pages(ocr.read_response_pages(spark, str(tmp_path))).first()
    assert raw.raw_text == "a b\nc"
    boxes = layout.collect_boxes(layout.ocr_words(blocks), "job_id", ("page_ord", "block_ord")).first()
    assert [b.text for b in boxes.boxes] == ["a", "b", "c"]


def test_layout_results_and_unified_boxes(spark, tmp_path):
    result = {"doc_id": "d", "pages": [{"lines": [{"content": "x", "polygon": [1, 2]}]}, {"lines": None}]}
    (tmp_path / "r.json").write_text(json.dumps(result))
    lines = layout.flatten_layout(ocr.read_layout_results(spark, str(tmp_path / "r.json")))
    assert [tuple(r) for r in lines.collect()] == [("d", 1, 0, "x", [1.0, 2.0])]
    words = spark.createDataFrame(
        [("j", 1, 2, "w", 9.0, (1.0, 2.0, 3.0, 4.0))],
        f"job_id string, page_ord bigint, block_ord int, text string, confidence double, box {ocr.BOX}")
    both = ocr.unified_boxes(words, lines).orderBy("level").collect()
    assert [(r.doc_id, r.page, r.level, r.text, r.confidence, r.box) for r in both] == [
        ("d", 1, "line", "x", None, [1.0, 2.0]), ("j", None, "word", "w", 9.0, [1.0, 2.0, 3.0, 4.0])]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "é\n1", None), ("b", "", 2)], "doc_id string, text string, n int")
    out = str(tmp_path / "t")
    for _ in range(2):
        sinks.write_text(df, out, batch_id=0)
        sinks.write_text(df, out, batch_id=1)
    assert sorted((r.doc_id, r.batch_id) for r in spark.read.parquet(out).collect()) == [
        ("a", 0), ("a", 1), ("b", 0), ("b", 1)]
    sinks.write_json(df, str(tmp_path / "j"))
    lines = "".join(p.read_text("utf-8") for p in (tmp_path / "j").glob("part-*")).splitlines()
    assert sorted(lines) == ['{"doc_id":"a","text":"é\\n1","n":null}', '{"doc_id":"b","text":"","n":2}']
    sinks.export_text(df, str(tmp_path / "x"), "doc_id", "text")
    got = documents.read_text(spark, str(tmp_path / "x"), recursive=True)
    assert sorted((r.name, r.text) for r in got.collect()) == [("a.txt", "é\n1"), ("b.txt", "")]


def test_nothing_unreadable_is_dropped(spark, tmp_path):
    page = lambda status="SUCCEEDED", **more: {"JobStatus": status, "Blocks": [block("LINE", "x")], **more}
    files = {"pretty/1": json.dumps(page(), indent=2), "broken/1": '{"JobStatus": "SUCC', "empty/1": "", "open/1": json.dumps(page(NextToken="2")),
             "hole/1": json.dumps(page(NextToken="2")), "hole/3": json.dumps(page()), "bad/1": json.dumps(page("FAILED", StatusMessage="too dark")),
             "two/1": json.dumps(page(NextToken="2")), "two/2": json.dumps(page()), "text/1": '"a string"'}
    for name, text in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    pages = ocr.read_response_pages(spark, str(tmp_path))
    assert {r.job_id for r in pages.collect()} == {n.split("/")[0] for n in files}
    assert {r.job_id: r.reason for r in ocr.incomplete_jobs(pages).collect()} == {
        "broken": "unreadable_page", "empty": "unreadable_page", "text": "unreadable_page",
        "open": "incomplete_pages", "hole": "incomplete_pages", "bad": "too dark"}
    assert {r.job_id for r in layout.assemble_pages(pages).where("raw_text = 'x'").collect()} >= {"pretty", "two"} - {"two"}
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "part.json").write_text('{"job_id":"a","page_ord":1}\n{"job_id":"b"\n\n{"job_id":"c","page_ord":1}\n')
    for lines in (True, False):
        rows = ocr.read_response_pages(spark, str(tmp_path / "lines"), lines).collect()
        assert [r.job_id for r in rows if not r.corrupt] == ["a", "c"] and sum(r.corrupt for r in rows) >= 1


def tree(root, files):
    for name, data in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)


def test_no_file_is_lost(spark, tmp_path):
    files = {"a.txt": b"a", "_x/b.txt": b"b", ".y/c.txt": b"c", "_d.txt": b"", "z/_e/.f.txt": b"\xff", "z/g.TXT": b"g"}
    tree(tmp_path, files | {"._h.txt": b"h", "n.md": b"n", "_temporary/0/t.txt": b"t", "z/_delta_log/1.txt": b"1"})
    got = {r.path.removeprefix(f"file:{tmp_path}/"): r.text for r in documents.read_text(spark, str(tmp_path), recursive=True).collect()}
    assert got == {"a.txt": "a", "_x/b.txt": "b", ".y/c.txt": "c", "_d.txt": "", "z/_e/.f.txt": None, "z/g.TXT": "g"}
    flat = documents.scan_documents(spark, str(tmp_path), suffixes=(".txt",))
    assert sorted((r.name, r.length) for r in flat.collect()) == [("_d.txt", 0), ("a.txt", 1)]
    assert [r.name for r in documents.scan_documents(spark, str(tmp_path / "*" / "b.txt"), suffixes=(".txt",)).collect()] == ["b.txt"]
    assert documents.scan_documents(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "void").mkdir()
    assert documents.read_text(spark, str(tmp_path / "void")).count() == 0


def test_pages_in_hidden_folders_are_read(spark, tmp_path):
    page = json.dumps({"JobStatus": "SUCCEEDED", "Blocks": [block("LINE", "x")]}).encode()
    tree(tmp_path, {"j1/0": page, "_j2/0.json": page, ".j3/_0.json": page, "j1/_SUCCESS": b"", "j1/.0.json.crc": b"x"})
    for lines in (False, True):
        rows = ocr.read_response_pages(spark, str(tmp_path), lines).collect()
        assert sorted((r.job_id, r.corrupt) for r in rows if r.page_ord == 0) == [("_j2", False), ("j1", False)]
        assert len(rows) == 3


def test_lines_of_ranges_are_those_of_the_file(spark, tmp_path):
    import gzip
    import random
    rng = random.Random(3)
    texts = {f"f{i}": b"".join(bytes(rng.choices(b"ab\r ", k=rng.randrange(30))) + b"\n" for _ in range(rng.randrange(9))) + b"x" * rng.randrange(2)
             for i in range(25)}
    tree(tmp_path, texts | {"g.gz": gzip.compress(b"one\ntwo\n")})
    files = listing.list_files(spark, str(tmp_path))
    expected = sorted((n, line.removesuffix(b"\r")) for n, data in texts.items()
                      for line in data.removesuffix(b"\n").split(b"\n") if data) + [("g.gz", b"one"), ("g.gz", b"two")]
    for size in (1, 7, 1 << 20):
        got = listing.read_lines(files, size).select(F.substring_index("_file", "/", -1).alias("n"), "value")
        assert sorted((r.n, bytes(r.value)) for r in got.collect()) == sorted(expected)


def test_staged_files_are_all_or_none(spark, tmp_path):
    out = tmp_path / "out"
    rows = spark.createDataFrame([("a", "one"), ("b", ""), ("c", None)], "name string, text string")
    assert sinks.write_files(rows, str(out), "name", "text", ".txt") == 3
    assert {p.name: p.read_text() for p in out.rglob("*.txt")} == {"a.txt": "one", "b.txt": "", "c.txt": ""}
    bad = spark.createDataFrame([("a", "new"), ("b", "new")], "name string, text string").withColumn(
        "text", F.when(F.col("name") == "b", F.raise_error(F.lit("broken")).cast("string")).otherwise(F.col("text")))
    with pytest.raises(Exception, match="broken"):
        sinks.write_files(bad, str(out), "name", "text", ".txt")
    assert (out / "a" / "a.txt").read_text() == "one" and not list(out.glob("_staging*"))
    assert sinks.write_files(rows.limit(1).select("name", F.lit("again").alias("text")), f"file://{out}", "name", "text", ".txt") == 1
    assert sum((p.read_text() == "again") for p in out.rglob("*.txt")) == 1


def test_an_attempt_that_runs_again_moves_nothing_twice(tmp_path):
    import pyarrow as pa
    folder, out = tmp_path / "_staging-1", tmp_path
    folder.mkdir()
    batch = pa.RecordBatch.from_pydict({"name": ["a"], "text": ["one"]})
    # Two attempts of a task: the first one's rows are in the table.
    first, lost = (list(sinks._staged(f"file:{folder}", ".txt", False)([batch]))[0] for _ in range(2))
    assert len(list(folder.iterdir())) == 2
    for _ in range(2):
        list(sinks._published(f"file:{folder}", f"file:{out}")([first]))
    assert (out / "a.txt").read_text() == "one" and len(list(folder.iterdir())) == 1


def test_work_dir_is_never_local_on_a_cluster():
    from types import SimpleNamespace
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(sparkContext=context, conf={})
    with pytest.raises(RuntimeError):
        work_dir(session, "x")


def test_work_dir_follows_the_session(spark):
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second and first.startswith(spark.sparkContext.getCheckpointDir())
    df = spark.range(5).withColumn("r", F.rand())
    copy = cut_lineage(df)
    assert copy.collect() == copy.collect() and copy.dtypes == df.dtypes


ODD_LINES = [b'{"job_id":"a","page_ord":1}', b'{"page_ord":"x"}', b'{"page_ord":1.0}', b'{"page_ord":-0}', b'{"job_id":5}', b'{}', b"", b"  ", b"null", b"5",
             b'{"job_id":"a","job_id":"b"}', b'{"job_id":"two"}{"job_id":"objects"}', b'{"job_id":"a"},{"job_id":"b"}', b'[{"job_id":"l"},{"page_ord":3}]',
             b'{"job_id":"open"', b',"page_ord":4}', b'{"job_id":"junk"} 1', b'{"job_id":"a"}] [1', b" {\"job_id\":\"blank\"}", b"{'job_id':'single'}",
             b'{"Blocks":[null,{"Text":"x","Confidence":-0},{"Confidence":-0.0},{"Confidence":7}]}', b'{"Blocks":[{"Confidence":NaN}]}',
             b'{"Blocks":[{"Confidence":1e400},{"Confidence":1e-400},{"Confidence":12345678901234567890}]}', b'{"Blocks":[{"Confidence":-Infinity}]}',
             b'{"Blocks":[{"Text":"\\u00e9\\ud83d\\ude00\\t\\"","Id":1}]}', '{"job_id":"é, Infinity, -0, NaN"}'.encode(), b'{"job_id":"\\udc00"}', b'{"job_id":"\xff"}',
             b'{"job_id":"\x01"}', b'{"Blocks":{"Text":"x"}}', b'{"Blocks":[{"Geometry":{"BoundingBox":{"Left":1}}},{"Geometry":{}}],"JobStatus":null}',
             b'{"other":{"a":1,"a":2}}', b'{"job_id":"last","page_ord":9223372036854775807}', b'{"page_ord":9223372036854775808}']


def test_lines_are_the_same_records_whoever_reads_them(spark, tmp_path, monkeypatch):
    folders = [tmp_path / f"{n}" for n in range(len(ODD_LINES) + 1)]
    for folder, lines in zip(folders, [ODD_LINES, *([line] for line in ODD_LINES)]):
        folder.mkdir()
        (folder / "part.json").write_bytes(b"\n".join(lines) + b"\n")

    def read():
        pages = ocr.json_records(ocr.json_files(spark, str(tmp_path)), f"job_id string, page_ord bigint, {ocr.RESPONSE_PAGE}", True)
        return sorted(map(repr, pages.collect()))
    found = read()
    monkeypatch.setattr(ocr, "_is_plain", lambda line: False)
    assert found == read() and len(found) >= 2 * len(ODD_LINES)


def test_plain_lines_are_not_left_to_spark(spark):
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(T.StructType.fromDDL(f"job_id string, page_ord bigint, {ocr.RESPONSE_PAGE}"))
    lines = [json.dumps({"job_id": str(n), "page_ord": n, "Blocks": [{"Text": "é -0 Inf", "Confidence": 9}]}).encode() for n in range(50)]
    lines[20:21] = [b'{"job_id":"open"', b"{}"]
    batch = pa.RecordBatch.from_arrays([pa.array(["f"] * len(lines)), pa.array(lines, pa.binary())], ["_file", "value"])
    out, = ocr._parsed(schema)([batch])
    assert [n for n, value in enumerate(out.column(1).to_pylist()) if value is not None] == [20, 21]
    assert [r and r["page_ord"] for r in out.column(2).to_pylist()] == [*range(20), None, None, *range(21, 50)]


def test_response_lines_are_response_pages(spark, tmp_path):
    from scriptorium.sources import derived
    texts = [(1, "a  bc \n\ud83d".replace("\ud83d", "\U0001F600 \"x\"\\\t") + "\nx\r\ny\rz\nlast line"), (2, ""), (3, None), (None, "no id"), (4, "w\n" * 23)]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    layouts = derived.v_layout(spark, str(tmp_path))
    pages = derived.response_pages(layouts).where("page_ord is null or page_ord <> 1").withColumn("NextToken", F.nullif("page_ord", F.lit(0)).cast("string"))
    lines = derived.response_lines(layouts, lambda n: {"NextToken": F.nullif(n, F.lit(0)).cast("string")}, lambda n: n.isNull() | (n != 1))
    shape = f"job_id string, page_ord bigint, {ocr.RESPONSE_PAGE}"
    read = lambda df, value: sorted(map(repr, df.select(F.from_json(value, shape).alias("r")).select("r.*").collect()))
    assert read(lines, "value") == read(pages, F.to_json(F.struct("job_id", "page_ord", "JobStatus", "Blocks", "NextToken")))


def test_one_parse_tells_json_as_two_do(spark):
    from scriptorium.functions.replies import is_json, strict_json
    texts = [line.decode("utf-8", "replace") for line in ODD_LINES] + ['"abc', '"a"', "1,2", "1]", "[1],[2", '1,"x":2', "1}", None, " 1 ", '{"a":', "1] junk", "//", '"~"', "true x"]
    rows = spark.createDataFrame([(t,) for t in texts], "v string").select("v", is_json(F.col("v")).alias("one"), strict_json(F.col("v")).isNotNull().alias("two"))
    assert [tuple(r) for r in rows.collect() if r.one != r.two] == []
