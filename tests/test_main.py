import json

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from scriptorium.__main__ import input_files, options, processing, run
from scriptorium.plans import batches
from scriptorium.plans.document_run import TABLES, write_document_run


def test_run_over_responses(spark, tmp_path):
    box = {"BoundingBox": {"Left": 0.0, "Top": 0.0, "Width": 1.0, "Height": 1.0}}
    block = lambda kind, text: {"BlockType": kind, "Text": text, "Confidence": 1.0, "Geometry": box}
    pages = {"j1/1": [block("LINE", "12"), block("WORD", "12"), block("LINE", "Dear tbe Globe")],
             "j1/2": [block("LINE", "Yours truly,")], "j2/1": []}
    for name, blocks in pages.items():
        (tmp_path / "ocr" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "ocr" / name).write_text(json.dumps({"JobStatus": "SUCCEEDED", "Blocks": blocks}))
    spark.createDataFrame([("tbe", "the")], "wrong string, right string").write.parquet(str(tmp_path / "lex"))
    spark.createDataFrame([("Theaters", "The Globe")], "category string, name string").write.parquet(
        str(tmp_path / "gaz"))
    out = str(tmp_path / "out")
    summary = run(spark, options(["--responses", str(tmp_path / "ocr"), "--output", out,
                                  "--lexicon", str(tmp_path / "lex"), "--gazetteer", str(tmp_path / "gaz")])).first()
    assert (summary.n_files, summary.n_success, summary.n_failed) == (2, 2, 0)
    corrected = {r.doc_id: r.corrected_text for r in spark.read.parquet(f"{out}/corrected").collect()}
    assert corrected == {"j1": "12\nDear the Globe\nYours truly,", "j2": ""}
    records = {r.doc_id: r.Theaters for r in spark.read.json(f"{out}/entities_json").collect()}
    assert records == {"j1": ["The Globe"], "j2": []}
    coords = spark.read.json(f"{out}/coords_json").collect()
    assert [(c.doc_id, [b.text for b in c.boxes]) for c in coords] == [("j1", ["12"])]


def test_run_over_texts_with_a_model(spark, tmp_path):
    (tmp_path / "a.txt").write_text("7\nhello ")
    out = str(tmp_path / "out")
    run(spark, options(["--texts", str(tmp_path), "--output", out, "--backend", "echo"]))
    status = spark.read.parquet(f"{out}/doc_status").first()
    assert (status.doc_id, status.page_number, status.n_letters, status.reason) == ("a", 7, 1, None)


def test_run_over_layouts(spark, tmp_path):
    result = {"doc_id": "d", "pages": [{"lines": [{"content": "x", "polygon": [1.0]}, {"content": "y"}]}]}
    (tmp_path / "r.json").write_text(json.dumps(result))
    out = str(tmp_path / "out")
    run(spark, options(["--layouts", str(tmp_path / "r.json"), "--output", out]))
    assert spark.read.parquet(f"{out}/raw_text").first().raw_text == "x\ny"
    boxes = spark.read.json(f"{out}/coords_json").first().boxes
    assert [(b.page, b.text, b.polygon) for b in boxes] == [(1, "x", [1.0]), (1, "y", [])]


def test_equal_names_hidden_and_broken_texts(spark, tmp_path):
    """Every input file is one row of the status, whatever happens to it."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    for name, data in {"x/a.txt": b"one", "y/a.txt": b"two", "l.txt": b"\xff\xfe", "_h.txt": b"h", "d.tar.txt": b"d", "d.tar.TXT": b"D"}.items():
        (source / name).parent.mkdir(parents=True, exist_ok=True)
        (source / name).write_bytes(data)
    summary = run(spark, options(["--texts", str(source), "--output", out, "--export-files"])).first()
    status = {r.doc_id: r for r in spark.read.parquet(f"{out}/doc_status").collect()}
    assert {k: (r.status, r.reason) for k, r in status.items()} == {
        "x/a": ("SUCCEEDED", None), "y/a": ("SUCCEEDED", None), "l": ("FAILED", "not_utf8"),
        "_h": ("SUCCEEDED", None), "d.tar": ("SUCCEEDED", None)}
    assert (summary.n_files, summary.n_success, summary.n_failed) == (5, 4, 1)
    raw = {r.doc_id: r.raw_text for r in spark.read.parquet(f"{out}/raw_text").collect()}
    assert raw == {"x/a": "one", "y/a": "two", "d.tar": "d", "_h": "h"}


def letters_in(source, **texts):
    source.mkdir(exist_ok=True)
    for name, text in texts.items():
        (source / f"{name}.txt").write_text(text)


def test_batches_of_a_run(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    letters_in(source, **{f"d{i}": f"{i}\nhello" for i in range(7)})
    chosen = options(["--texts", str(source), "--output", out, "--batch-size", "3"])
    for _ in range(2):
        summary = run(spark, chosen).first()
        assert (summary.n_files, summary.n_batches, summary.batch_size, summary.n_success) == (7, 3, 3, 7)
        status = spark.read.parquet(f"{out}/doc_status")
        assert sorted((r.batch_id, r["count"]) for r in status.groupBy("batch_id").count().collect()) == [(0, 3), (1, 3), (2, 1)]
    assert spark.read.json(f"{out}/combined_output_json").count() == 7


def test_incremental_runs_take_what_is_new_or_changed(spark, tmp_path):
    import os
    source, out = tmp_path / "in", str(tmp_path / "out")
    letters_in(source, a="1\nDear Globe", b="2\nb")
    spark.createDataFrame([("Theaters", "Globe")], "category string, name string").write.parquet(str(tmp_path / "gaz"))
    chosen = options(["--texts", str(source), "--output", out, "--incremental", "--gazetteer", str(tmp_path / "gaz")])
    assert run(spark, chosen).first().n_files == 2
    nothing = run(spark, chosen).first()
    assert (nothing.n_files, nothing.n_batches) == (0, 0)
    letters_in(source, a="9\nnobody", c="3\nc")
    os.utime(source / "a.txt", (10 ** 9, 10 ** 9))
    assert run(spark, chosen).first().n_files == 2
    pages = {r.doc_id: r.page_number for r in batches.current_table(spark, out, "combined").collect()}
    assert pages == {"a": 9, "b": 2, "c": 3}
    # The new version of a names no theatre, so that of the old one is gone.
    assert batches.current_table(spark, out, "entities").count() == 0
    assert {r.doc_id: r.Theaters for r in spark.read.json(f"{out}/entities_json").collect()} == {"a": [], "b": [], "c": []}


def test_a_killed_run_goes_on_with_its_batch(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    letters_in(source, **{f"d{i}": f"{i}\nhello" for i in range(6)})
    chosen = options(["--texts", str(source), "--output", out, "--batch-size", "2"])
    files, whole = input_files(spark, chosen), processing(spark, chosen)
    taken = []

    def dies(mine):
        taken.append(sorted(r.unit for r in mine.collect()))
        if len(taken) == 2:
            write_document_run({"letters": whole(mine)["letters"]}, out, 1)
            raise KeyboardInterrupt
        return whole(mine)
    with pytest.raises(KeyboardInterrupt):
        batches.run_in_batches(spark, files, out, dies, 2, TABLES)
    summary = run(spark, chosen).first()
    assert taken == [["d0", "d1"], ["d2", "d3"]] and (summary.n_files, summary.n_batches) == (4, 2)
    for table in ("doc_status", "letters"):
        rows = spark.read.parquet(f"{out}/{table}").collect()
        assert sorted((r.doc_id, r.batch_id) for r in rows) == [(f"d{i}", i // 2) for i in range(6)]
    assert run(spark, chosen).first().n_files == 6


def test_pages_of_a_job_stay_in_one_batch(spark, tmp_path):
    page = lambda text, **more: json.dumps({"JobStatus": "SUCCEEDED", "Blocks": [
        {"BlockType": "LINE", "Text": text, "Confidence": 1.0, "Geometry": None}], **more})
    for job in range(3):
        (tmp_path / "ocr" / f"j{job}").mkdir(parents=True)
        for n in (1, 2):
            (tmp_path / "ocr" / f"j{job}" / str(n)).write_text(page(f"line {n}", **({"NextToken": "2"} if n == 1 else {})))
    out = str(tmp_path / "out")
    chosen = options(["--responses", str(tmp_path / "ocr"), "--output", out, "--incremental", "--batch-size", "1"])
    assert tuple(run(spark, chosen).first())[:5] == (3, 3, 1, 3, 0)
    (tmp_path / "ocr" / "j1" / "2").write_text(page("another line"))
    assert run(spark, chosen).first().n_files == 1
    raw = {r.doc_id: r.raw_text for r in batches.current_table(spark, out, "raw_text").collect()}
    assert raw == {"j0": "line 1\nline 2", "j1": "line 1\nanother line", "j2": "line 1\nline 2"}


def test_failed_jobs_are_reported_with_their_reason(spark, tmp_path):
    page = {"JobStatus": "FAILED", "StatusMessage": "too dark", "Blocks": []}
    (tmp_path / "ocr" / "j").mkdir(parents=True)
    (tmp_path / "ocr" / "j" / "1").write_text(json.dumps(page))
    out = str(tmp_path / "out")
    summary = run(spark, options(["--responses", str(tmp_path / "ocr"), "--output", out])).first()
    row = spark.read.parquet(f"{out}/doc_status").first()
    assert (row.status, row.reason, row.raw_path) == ("FAILED", "too dark", None) and summary.n_failed == 1


def test_exported_files_are_those_of_the_status(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("7\nhello")
    out = str(tmp_path / "out")
    run(spark, options(["--texts", str(tmp_path / "in"), "--output", out, "--export-files"]))
    row = spark.read.parquet(f"{out}/doc_status").first()
    assert Path(row.raw_path).read_text() == "7\nhello"
    assert json.loads(Path(row.combined_path).read_text())["letters"] == ["7\nhello"]


def test_the_package_runs_from_a_zip(tmp_path):
    root = Path(__file__).resolve().parents[1]
    shutil.make_archive(str(tmp_path / "scriptorium"), "zip", root, "scriptorium")
    code = ("import sys; sys.path.insert(0, sys.argv[1]); import scriptorium.__main__; "
            "from scriptorium.sources.documents import packaged_prompts; print(len(packaged_prompts()), scriptorium.__file__)")
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path / "scriptorium.zip")], cwd=tmp_path, capture_output=True, text=True)
    assert done.stdout.startswith("4 ") and "scriptorium.zip" in done.stdout, done.stderr
