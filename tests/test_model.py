import json
import time

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import model
from scriptorium.plans.document_run import (
    RunConfig, document_run, write_document_run, write_json_records)
from scriptorium.plans.model_tasks import Model, ask, split_with_model
from scriptorium.sources.documents import read_prompts


def requests(spark, texts):
    rows = [(f"r{i}", "correct_text", None, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "request_id string, task string, system string, user string")


def test_attempts_and_errors_are_data(spark):
    def flaky():
        seen = {}

        def call(task, system, user):
            seen[user] = seen.get(user, 0) + 1
            if user == "never" or (user == "second" and seen[user] < 2):
                raise RuntimeError("busy")
            return user.upper()
        return call

    got = model.apply_model(requests(spark, ["a", "never", "second"]), flaky, attempts=2).collect()
    assert sorted(map(tuple, got)) == [
        ("r0", "A", None, 1), ("r1", None, "RuntimeError: busy", 2), ("r2", "SECOND", None, 2)]
    once = model.apply_model(requests(spark, ["second"]), flaky).first()
    assert once.response is None and once.attempt == 1


def test_equal_requests_are_sent_once_and_known_ones_never(spark):
    calls = spark.sparkContext.accumulator(0)

    def counting():
        def call(task, system, user):
            calls.add(1)
            return user
        return call

    many = requests(spark, ["a", "b"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50))))
    known = spark.createDataFrame([("r0", "old", None), ("r1", None, "failed")],
                                  "request_id string, response string, error string")
    got = model.apply_model(many, counting, parallelism=3, known=known).collect()
    assert [r.request_id for r in got] == ["r1"] and calls.value == 1


def test_threads_wait_together(spark):
    def slow():
        import threading
        meet = threading.Barrier(4)

        def call(task, system, user):
            meet.wait(timeout=20)
            return user
        return call

    got = model.apply_model(requests(spark, list("abcd")), slow, parallelism=1, threads=4).collect()
    assert sorted((r.request_id, r.response, r.error) for r in got) == [
        ("r0", "a", None), ("r1", "b", None), ("r2", "c", None), ("r3", "d", None)]


def test_parallelism_sets_the_number_of_tasks(spark):
    df = model.apply_model(requests(spark, list("abcdefgh")), "echo", parallelism=3)
    assert df.rdd.getNumPartitions() == 3


def test_a_hanging_call_ends_as_an_error(spark):
    def hanging():
        import time

        def call(task, system, user):
            if user == "b":
                time.sleep(600)
            return user
        return call
    started = time.time()
    got = model.apply_model(requests(spark, list("abc")), hanging, parallelism=1, threads=3, timeout=0.5).collect()
    assert {r.request_id: (r.response, r.error) for r in got} == {
        "r0": ("a", None), "r1": (None, "TimeoutError: no reply within 0.5 s"), "r2": ("c", None)}
    assert time.time() - started < 60


def test_pauses_double_and_are_shortened_by_chance():
    pauses = []

    def call(*request):
        raise OSError("busy")
    assert model.send(call, ("t", None, "u"), attempts=9, backoff=1.0, sleep=pauses.append) == (None, "OSError: busy", 9)
    longest = [min(60.0, 2.0 ** n) for n in range(8)]
    assert all(0.5 * top <= p <= top for p, top in zip(pauses, longest)) and len(pauses) == 8


def test_calls_keep_their_pace():
    now, began = [0.0], []
    pace = model.Pace(4.0, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(9):
        pace.wait()
        began.append(now[0])
    assert began == pytest.approx([n / 4 for n in range(9)])


def counting(folder, dies=False):
    """A back end that leaves a file for every call, and can take its task down after some."""
    def factory():
        import os
        import uuid

        def call(task, system, user):
            (folder / f"{user}-{uuid.uuid4().hex}").touch()
            if dies and len(list(folder.iterdir())) > 150:
                raise SystemExit
            return user
        return call
    return factory


def test_replies_outlast_a_run_that_failed(spark, tmp_path):
    calls, store = tmp_path / "calls", str(tmp_path / "store")
    calls.mkdir()
    wanted = requests(spark, [f"t{i}" for i in range(300)]).coalesce(1)
    with pytest.raises(Exception):
        model.apply_model(wanted, counting(calls, dies=True), parallelism=1, store=store).collect()
    first = len(list(calls.iterdir()))
    kept = model.stored_replies(spark, store).count()
    assert 0 < kept < 300 and first < 300
    again = model.apply_model(wanted, counting(calls), parallelism=1, store=store).collect()
    assert len(again) == 300 - kept and len(list(calls.iterdir())) == first + 300 - kept
    texts = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "doc_id int, text string")
    counted = Model(counting(calls), read_prompts(spark), store=str(tmp_path / "asked"))
    for _ in range(2):
        got = ask(texts, "correct_text", counted)
        assert sorted((r.doc_id, r.response) for r in got.collect()) == [(i, f"t{i}") for i in range(5)]
    assert len(list(calls.iterdir())) == first + 300 - kept + 5


def test_layouts(spark):
    rows = spark.createDataFrame(
        [("correct_text", "P", "t"), ("explain_entities", "E", "Category: c\nEntity: e"),
         ("split_letters", "S", "t")], "task string, prompt string, text string")
    both = {r.task: (r.system, r.user) for r in model.render_prompt(rows).collect()}
    assert both == {"correct_text": ("P", "t"), "explain_entities": ("E", "Category: c\nEntity: e"),
                    "split_letters": (None, "S\nText:\nt")}
    single = {r.task: (r.system, r.user) for r in model.render_prompt(rows, "single_user").collect()}
    assert single["correct_text"] == (None, "P\nText:\nt")
    assert single["explain_entities"] == (None, "E\nCategory: c\nEntity: e")
    with pytest.raises(ValueError):
        model.render_prompt(rows, "other")


def test_missing_reply_is_an_error(spark):
    wanted = spark.createDataFrame([("x",), ("y",)], "request_id string")
    replies = spark.createDataFrame([("x", "ok", None, 1)], model.RESPONSE_SCHEMA)
    got = {r.request_id: (r.response, r.error) for r in model.attach_responses(wanted, replies).collect()}
    assert got == {"x": ("ok", None), "y": (None, "no response")}


def test_known_replies_are_used(spark):
    texts = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id int, text string")
    prompts = read_prompts(spark)
    first = Model("echo", prompts)
    asked = model.render_prompt(model.attach_prompt(
        texts.withColumn("task", F.explode(F.array(F.lit("correct_text")))), prompts))
    known = asked.where("doc_id = 1").select("request_id", F.lit("kept").alias("response"),
                                             F.lit(None).cast("string").alias("error"))
    got = ask(texts, "correct_text", Model("echo", prompts, known=known))
    assert sorted((r.doc_id, r.response) for r in got.collect()) == [(1, "kept"), (2, "b")]
    assert sorted((r.doc_id, r.response) for r in ask(texts, "correct_text", first).collect()) == [
        (1, "a"), (2, "b")]


def scripted():
    """Answers each task; one text breaks correction, another gets useless replies."""
    def call(task, system, user):
        if task == "correct_text":
            if "broken" in user:
                raise RuntimeError("no answer")
            return " " + user.replace("tbe", "the") + "\n"
        if "useless" in user:
            return "sorry" if task == "extract_entities" else '["x", 1]'
        if task == "extract_entities":
            return json.dumps({"People": ["Ann", "Ann"], "Productions": [], "Companies": [], "Theaters": ["Globe"],
                               "Dates": ["1920"]})
        if task == "explain_entities":
            return "about " + user.split("Entity: ")[1]
        return json.dumps(user.split("\nText:\n")[1].split("\n\n"))
    return call


LINES = {1: ["12", "Dear tbe", "", "second"], 2: ["broken tbe"], 3: ["useless"], 4: [], 5: ["timed out"]}


def run(spark, **options):
    lines = spark.createDataFrame([(d, 1, i, t) for d, ls in LINES.items() for i, t in enumerate(ls)],
                                  "doc_id int, page int, line_no int, text string")
    files = spark.createDataFrame([(d,) for d in LINES], "doc_id int")
    jobs = files.withColumn("outcome", F.when(F.col("doc_id") == 5, "TIMED_OUT").otherwise("SUCCEEDED"))
    return document_run(files, lines, jobs=jobs, **options)


def test_document_run_with_a_model(spark, tmp_path):
    tables = run(spark, model=Model(scripted, read_prompts(spark)), config=RunConfig(materialise=True))
    corrected = {r.doc_id: r.corrected_text for r in tables["corrected"].collect()}
    assert corrected == {1: "12\nDear the\n\nsecond", 2: None, 3: "useless", 4: ""}
    letters = [tuple(r) for r in tables["letters"].orderBy("doc_id", "letter_no").collect()]
    assert letters == [(1, 12, 1, "12\nDear the"), (1, 12, 2, "second"), (2, None, 1, "broken tbe")]
    explained = {(r.doc_id, r.category, r.ord): r.explanation for r in tables["explanations"].collect()}
    assert explained[(1, "People", 2)] == "about Ann" and explained[(2, "Theaters", 1)] == "about Globe"
    assert not any(doc == 3 for doc, *_ in explained)
    status = {r.doc_id: r for r in tables["doc_status"].collect()}
    assert status[5].status == "FAILED" and status[5].reason == "timeout" and status[5].raw_path is None
    assert status[2].corrected_path is None and status[2].raw_path == "output/raw_text"
    assert (status[2].status, status[2].reason) == ("FAILED", "failed: correct_text")
    assert status[3].reason == "failed: split_letters"
    assert status[4].reason == "no_text" and status[4].n_letters == 0
    write_document_run(tables, str(tmp_path / "out"))
    write_json_records(tables, str(tmp_path / "out"))
    explained = spark.read.json(str(tmp_path / "out" / "entities_explained_json"))
    assert explained.count() == 4 and explained.where("doc_id = 1").first().People.Ann == "about Ann"
    combined = spark.read.json(str(tmp_path / "out" / "combined_output_json"))
    assert combined.where("doc_id = 4").first().letters == []
    assert spark.read.parquet(str(tmp_path / "out" / "letters")).count() == 3


def test_document_run_with_rules(spark):
    lexicon = spark.createDataFrame([("tbe", "the")], "wrong string, right string")
    gazetteer = spark.createDataFrame([("People", "second")], "category string, name string")
    knowledge = spark.createDataFrame([("People", "second", "a name")],
                                      "category string, entity string, explanation string")
    tables = run(spark, lexicon=lexicon, gazetteer=gazetteer, knowledge=knowledge)
    status = {r.doc_id: r for r in tables["doc_status"].collect()}
    assert [status[d].status for d in sorted(status)] == ["SUCCEEDED"] * 4 + ["FAILED"]
    assert status[1].page_number == 12 and status[1].n_entities == 1 and status[1].n_lines == 4
    assert {r.doc_id: r.corrected_text for r in tables["corrected"].collect()}[2] == "broken the"
    assert [r.explanation for r in tables["explanations"].collect()] == ["a name"]


def test_failed_split_has_no_letters(spark):
    texts = spark.createDataFrame([(1, "useless"), (2, "")], "doc_id int, text string")
    got = {r.doc_id: (r.letters, r.letter_status) for r in
           split_with_model(texts, Model(scripted, read_prompts(spark))).collect()}
    assert got == {1: ([], "failed"), 2: ([], "parsed")}


def failing():
    def call(task, system, user):
        raise RuntimeError("down")
    return call


def test_status_has_every_document_once(spark):
    """Repeated names, failed jobs, a model that is down, documents without lines, and no documents."""
    files = spark.createDataFrame([(1,), (1,), (2,), (3,)], "doc_id int")
    lines = spark.createDataFrame([(1, 1, 0, "x"), (9, 1, 0, "y")], "doc_id int, page int, line_no int, text string")
    jobs = spark.createDataFrame([(2, "FAILED", "too dark"), (8, "FAILED", None)], "doc_id int, outcome string, reason string")
    tables = document_run(files, lines, jobs=jobs, model=Model(failing, read_prompts(spark)))
    status = {r.doc_id: (r.status, r.reason) for r in tables["doc_status"].collect()}
    broken = "failed: correct_text, extract_entities, split_letters"
    assert tables["doc_status"].count() == 3
    assert status == {1: ("FAILED", broken), 2: ("FAILED", "too dark"), 3: ("FAILED", broken)}
    assert document_run(files.limit(0), lines, model=Model(failing, read_prompts(spark)))["doc_status"].count() == 0


def test_a_task_without_a_prompt_is_an_error(spark):
    prompts = read_prompts(spark).where("task <> 'split_letters'")
    texts = spark.createDataFrame([(1, "a")], "doc_id int, text string")
    with pytest.raises(Exception, match="no prompt for task split_letters"):
        split_with_model(texts, Model("echo", prompts)).collect()


def test_the_greatest_of_several_prompts_counts(spark):
    prompts = spark.createDataFrame([("correct_text", "a"), ("correct_text", "b")], "task string, prompt string")
    rows = spark.createDataFrame([("correct_text",)], "task string")
    assert [r.prompt for r in model.attach_prompt(rows, prompts).collect()] == ["b"]
