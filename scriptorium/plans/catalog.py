"""The registered queries: one per operator, over the given tables."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Window, functions as F

from scriptorium.functions.files import (
    base_name, content_type, derive_paths, file_ext, is_supported_file, route_preparation)
from scriptorium.functions.replies import (
    CATEGORIES, EXPLAINED_CATEGORIES, parse_letters, strict_json, to_json_record,
    validate_entities)
from scriptorium.functions.text import (
    format_elapsed, parse_page_number, py_strip, rewrite_suffix, run_stamp, split_lines)
from scriptorium.operators import (
    correct, decoding, entities, evaluate, layout, letters, model, numbering, status)
from scriptorium.plans.document_run import RunConfig, document_run
from scriptorium.plans.model_tasks import (
    Model, ask, correct_with_model, explain_with_model, extract_with_model, split_with_model)
from scriptorium.session import cut_lineage, work_dir
from scriptorium.sources import derived, documents, ocr, sinks
from scriptorium.streaming.incremental import current, incremental_run
from scriptorium.streaming.tracker import track_jobs

BATCH_SIZE = 10
MAX_POLLS = 2
PAGES_PER_FILE = 5000
DEADLINE_SECONDS = 6 * 3600


def _joined(df, key, names=CATEGORIES):
    """Lists as strings, so that results are flat."""
    return df.select(key, *[F.array_join(c, "|").alias(c.lower()) for c in names])


def _exported(spark, sf_dir):
    """Letter texts written as one file per conversation."""
    path = work_dir(spark, "texts")
    sinks.export_text(derived.v_letters(spark, sf_dir), path, "conv_id", "body")
    return path


_DOCUMENT_NAME = r"/([^/]+)\.txt$"


def a1_scan_documents(spark, sf_dir):
    files = documents.scan_documents(spark, _exported(spark, sf_dir), suffixes=(".txt",),
                                     recursive=True)
    return files.select(F.regexp_extract("path", _DOCUMENT_NAME, 1).cast("bigint").alias("conv_id"),
                        "length")


def _write_pages(pages, path):
    """Response pages, a line of JSON each, as packed files of so many lines: unpacked they are twenty times the text they hold."""
    pages.write.options(**{"compression": "gzip", "zlib.compress.level": "THREE"}).option("maxRecordsPerFile", PAGES_PER_FILE).text(path)


def a2_read_ocr_pages(spark, sf_dir):
    path = work_dir(spark, "responses")
    _write_pages(derived.response_lines(derived.v_layout(spark, sf_dir)), path)
    blocks = ocr.read_ocr_pages(spark, path, lines=True)
    return blocks.select(
        F.col("job_id").cast("bigint").alias("job_id"), "page_ord",
        F.col("block_ord").cast("bigint").alias("block_ord"), "block_type", "text", "confidence",
        F.col("box.Left").alias("box_left"), F.col("box.Top").alias("box_top"),
        F.col("box.Width").alias("box_width"), F.col("box.Height").alias("box_height"))


def a2_incomplete_jobs(spark, sf_dir):
    """Jobs with lost pages: every seventh page is missing, and some jobs have failed themselves."""
    path = work_dir(spark, "responses")
    failed = _outcomes(spark, sf_dir).where(F.col("outcome") == status.FAILED).select(
        F.col("job_id").alias("doc_id"), F.lit(status.FAILED).alias("_failed"))
    # Known of a document before its pages are built, so that no page is shuffled with its blocks.
    layouts = derived.v_layout(spark, sf_dir).withColumn("n_pages", F.size("pages")).join(failed, "doc_id", "left")
    _write_pages(derived.response_lines(layouts, lambda page_ord: {
        "JobStatus": F.coalesce("_failed", F.lit("SUCCEEDED")),
        "NextToken": F.when(page_ord + 1 < F.col("n_pages"), (page_ord + 1).cast("string"))}, lambda page_ord: page_ord % 7 != 6), path)
    jobs = ocr.incomplete_jobs(ocr.read_response_pages(spark, path, lines=True))
    return jobs.select(F.col("job_id").cast("bigint").alias("doc_id"), "outcome", "reason")


def a2_assemble_pages(spark, sf_dir):
    path = work_dir(spark, "responses")
    _write_pages(derived.response_lines(derived.v_layout(spark, sf_dir)), path)
    raw = layout.assemble_pages(ocr.read_response_pages(spark, path, lines=True))
    return raw.select(F.col("job_id").cast("bigint").alias("doc_id"), "raw_text", "n_lines")


def a3_read_layout_pages(spark, sf_dir):
    path = work_dir(spark, "layouts")
    (derived.v_layout(spark, sf_dir).withColumn("doc_id", F.col("doc_id").cast("string"))
     .write.json(path))
    lines = layout.flatten_layout(ocr.read_layout_results(spark, path, lines=True))
    return lines.select(F.col("doc_id").cast("bigint").alias("doc_id"), "page", "line_no", "text")


def a4_read_text(spark, sf_dir):
    texts = documents.read_text(spark, _exported(spark, sf_dir), recursive=True)
    return texts.select(F.regexp_extract("path", _DOCUMENT_NAME, 1).cast("bigint").alias("conv_id"),
                        "text")


def a6_write_text(spark, sf_dir):
    path = work_dir(spark, "raw")
    raw = layout.assemble_text(derived.v_lines(spark, sf_dir)).select("doc_id", "raw_text")
    sinks.write_text(raw, path, batch_id=0)
    return spark.read.parquet(path).select("doc_id", "raw_text")


def a7_write_json(spark, sf_dir):
    path = work_dir(spark, "combined")
    texts = derived.v_letters(spark, sf_dir)
    combined = letters.letter_arrays(texts, "body").select(
        "conv_id", parse_page_number(F.col("body")).alias("page_number"), "letters")
    sinks.write_json(combined, path)
    back = spark.read.schema("conv_id bigint, page_number bigint, letters array<string>").json(path)
    return letters.letter_rows(back)


def b1_is_supported_file(spark, sf_dir):
    files = derived.v_files(spark, sf_dir)
    return files.where(is_supported_file(F.col("name"))).select("doc_id", "name")


def b2_derive_paths(spark, sf_dir):
    return derive_paths(derived.v_files(spark, sf_dir)).drop("length")


def b3_lower_extension(spark, sf_dir):
    return derived.v_files(spark, sf_dir).select("doc_id", "name", file_ext(F.col("name")).alias("ext"))


def b4_route_preparation(spark, sf_dir):
    paths = derive_paths(derived.v_files(spark, sf_dir))
    routes = [route_preparation(paths, p).withColumn("provider", F.lit(p)) for p in ("aws", "azure")]
    return routes[0].unionByName(routes[1]).select("doc_id", "provider", "action", "prepared_path")


def b5_guess_content_type(spark, sf_dir):
    routed = route_preparation(derive_paths(derived.v_files(spark, sf_dir)), "azure")
    return routed.select("doc_id", "prepared_path",
                         content_type(F.col("prepared_path")).alias("content_type"))


def b6_split_blocks(spark, sf_dir):
    blocks = derived.v_blocks(spark, sf_dir)
    words = layout.ocr_words(blocks).select(
        "doc_id", "page", "line_no", "word_no", F.lit("word").alias("level"), "text", "confidence")
    lines = layout.ocr_lines(blocks).select(
        "doc_id", "page", "line_no", "word_no", F.lit("line").alias("level"), "text",
        F.lit(None).cast("double").alias("confidence"))
    return words.unionByName(lines)


def b7_effective_text(spark, sf_dir):
    return derived.v_pairs(spark, sf_dir).select(
        "doc_id", correct.effective_text(F.col("raw"), F.col("corrected")).alias("text"))


def _outcomes(spark, sf_dir):
    return status.first_terminal_status(derived.v_poll(spark, sf_dir), max_retries=MAX_POLLS)


def b8_failed_documents(spark, sf_dir):
    return status.failed_documents(_outcomes(spark, sf_dir)).select("job_id", "outcome", "reason")


def b9_warn_empty_ocr(spark, sf_dir):
    """Documents whose OCR job did not succeed have no lines."""
    files = derived.table(spark, sf_dir, "documents").select("doc_id")
    failed = status.failed_documents(_outcomes(spark, sf_dir)).select(F.col("job_id").alias("doc_id"))
    return layout.empty_documents(files, derived.v_lines(spark, sf_dir).join(failed, "doc_id", "left_anti"))


def _prepared(spark, sf_dir):
    files = derive_paths(derived.v_files(spark, sf_dir).where(is_supported_file(F.col("name"))))
    return status.last_wins(files.select("base_name", "name", "doc_id"), "base_name",
                            ["name", "doc_id"])


def d1_handoff(spark, sf_dir):
    # Jobs exist for documents that have a label, by the base name of their file.
    labels = derived.table(spark, sf_dir, "labels").select("doc_id").distinct()
    named = derived.v_files(spark, sf_dir).join(labels, "doc_id").select(
        base_name(F.col("name")).alias("base_name"),
        F.concat(F.lit("job-"), F.col("doc_id").cast("string")).alias("job_id"))
    jobs = status.last_wins(named, "base_name", ["job_id"])
    prepared = _prepared(spark, sf_dir)
    ready = status.handoff(jobs, prepared).withColumn("state", F.lit("ready"))
    waiting = (status.not_handed_over(prepared, jobs)
               .withColumn("job_id", F.lit(None).cast("string"))
               .withColumn("state", F.lit("not_submitted")))
    return ready.unionByName(waiting).select("base_name", "name", "doc_id", "job_id", "state")


DOCUMENT_TASKS = ("correct_text", "extract_entities", "split_letters")


def _tasks(spark, sf_dir):
    tasks = F.explode(F.array(*[F.lit(t) for t in DOCUMENT_TASKS])).alias("task")
    return derived.table(spark, sf_dir, "documents").select("doc_id", "text", tasks)


def d2_attach_prompt(spark, sf_dir):
    rows = model.attach_prompt(_tasks(spark, sf_dir).drop("text"), documents.read_prompts(spark))
    return rows.select("doc_id", "task", "prompt")


def d3_attach_responses(spark, sf_dir):
    """Customers without an order get no reply; an empty reply is a reply."""
    replies = derived.v_responses(spark, sf_dir)
    buyers = derived.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("request_id")).distinct()
    answered = replies.join(buyers, "request_id", "left_semi").withColumn(
        "error", F.lit(None).cast("string"))
    return model.attach_responses(replies.select("request_id"), answered)


def d4_attach_explanations(spark, sf_dir):
    rows = entities.attach_explanations(derived.v_entities(spark, sf_dir),
                                        derived.v_knowledge(spark, sf_dir))
    return rows.select("doc_id", "category", "ord", "entity", "explanation")


def e1_assemble_raw_text(spark, sf_dir):
    files = derived.table(spark, sf_dir, "documents").select("doc_id")
    return layout.with_empty_documents(files, layout.assemble_text(derived.v_lines(spark, sf_dir)))


def e2_collect_boxes(spark, sf_dir):
    # Boxes are many times the text, so pages are brought together before they are built.
    boxes = layout.page_boxes(derived.response_pages(derived.v_layout(spark, sf_dir), spread=("job_id",)))
    whole = lambda value: value.cast("int").cast("string")
    shown = F.transform("boxes", lambda b: F.concat_ws(
        ":", b["text"], whole(b["confidence"]), *[whole(b["box"][f]) for f in ("Left", "Top", "Width", "Height")]))
    return boxes.select(F.col("job_id").cast("bigint").alias("doc_id"), F.size("boxes").cast("bigint").alias("n_boxes"),
                        F.array_join(shown, " ").alias("boxes"))


def e3_last_wins_by_key(spark, sf_dir):
    files = derived.v_files(spark, sf_dir).select(
        base_name(F.col("name")).alias("base_name"), "name", "doc_id")
    order = ["name", "doc_id"]
    kept = status.last_wins(files, "base_name", order).withColumn("state", F.lit("kept"))
    lost = status.superseded(files, "base_name", order).withColumn("state", F.lit("superseded"))
    return kept.unionByName(lost)


def e4_build_entity_record(spark, sf_dir):
    return _joined(entities.entity_record(derived.v_entities(spark, sf_dir)), "doc_id")


def _explained(spark, sf_dir):
    """Explanations that differ between repeats of an entity, so that the last one shows."""
    rows = entities.explain_entities(derived.v_entities(spark, sf_dir),
                                     derived.v_knowledge(spark, sf_dir))
    return rows.withColumn("explanation", F.concat(
        "explanation", F.lit(" at "), F.col("ord").cast("string")))


def e5_build_explanation_maps(spark, sf_dir):
    maps = entities.explanation_maps(_explained(spark, sf_dir))
    entries = F.array(*[F.struct(F.lit(c).alias("category"), F.map_entries(c).alias("entries"))
                        for c in EXPLAINED_CATEGORIES])
    return (maps.select("doc_id", F.explode(entries).alias("m"))
            .select("doc_id", "m.category", F.explode("m.entries").alias("e"))
            .select("doc_id", "category", F.col("e.key").alias("entity"),
                    F.col("e.value").alias("explanation")))


def e6_run_summary(spark, sf_dir):
    times = derived.v_poll(spark, sf_dir).groupBy("job_id").agg(
        F.min("ts").alias("started"), F.max("ts").alias("finished"))
    rows = _outcomes(spark, sf_dir).join(times, "job_id").withColumnRenamed("outcome", "status")
    return status.run_summary(rows, BATCH_SIZE)


def f1_assign_batches(spark, sf_dir):
    files = derived.v_files(spark, sf_dir).where(is_supported_file(F.col("name")))
    return numbering.assign_batches(files.select("doc_id", "name"), BATCH_SIZE, ["name", "doc_id"])


def f2_number_pages(spark, sf_dir):
    pages = layout.number_pages(derived.v_layout(spark, sf_dir), "pages")
    text = F.array_join(F.transform(F.col("item.lines"), lambda l: l["content"]), "\n")
    return pages.select("doc_id", "page", text.alias("page_text"))


def f3_first_terminal_status(spark, sf_dir):
    return _outcomes(spark, sf_dir)


def g1_unpivot_entities(spark, sf_dir):
    records = entities.entity_record(derived.v_entities(spark, sf_dir))
    return entities.unpivot_entities(records, categories=EXPLAINED_CATEGORIES)


def g2_distinct_requests(spark, sf_dir):
    return entities.distinct_requests(derived.v_entities(spark, sf_dir))


def _padded(text):
    return F.concat(F.lit("\u00a0 \n\t"), text, F.lit(" \n\u3000\u00a0"))


def h1_py_strip(spark, sf_dir):
    return derived.table(spark, sf_dir, "documents").select(
        "doc_id", py_strip(_padded(F.col("text"))).alias("stripped"))


def h2_parse_page_number(spark, sf_dir):
    return derived.v_letters(spark, sf_dir).select(
        "conv_id", parse_page_number(F.col("body")).alias("page_number"))


def h3_strict_json(spark, sf_dir):
    return derived.v_responses(spark, sf_dir).select(
        "request_id", strict_json(F.col("response")).isNotNull().alias("is_json"))


def h4_validate_entities(spark, sf_dir):
    checked = derived.v_responses(spark, sf_dir).select(
        "request_id", validate_entities(F.col("response")).alias("r")).select("request_id", "r.*")
    return checked.select("request_id", "status",
                          *[F.array_join(c, "|").alias(c.lower()) for c in CATEGORIES])


def h5_parse_letters(spark, sf_dir):
    full = F.concat(F.lit("full text "), F.col("request_id").cast("string"))
    parsed = derived.v_responses(spark, sf_dir).select(
        "request_id", parse_letters(F.col("response"), full).alias("r")).select("request_id", "r.*")
    return parsed.select("request_id", "status", F.array_join("letters", "|").alias("letters"))


def _requests(spark, sf_dir, layout_name):
    rows = model.attach_prompt(_tasks(spark, sf_dir), documents.read_prompts(spark))
    return model.render_prompt(rows, layout_name)


def h6_render_prompt(spark, sf_dir):
    rows = _requests(spark, sf_dir, "system_and_user").withColumn("layout", F.lit("system_and_user"))
    single = _requests(spark, sf_dir, "single_user").withColumn("layout", F.lit("single_user"))
    return rows.unionByName(single).select(
        "doc_id", "task", "layout", "system", F.length("user").cast("bigint").alias("user_chars"),
        "request_id")


def h7_to_json_record(spark, sf_dir):
    return derived.table(spark, sf_dir, "documents").select(
        "doc_id", to_json_record("doc_id", "lang", "source", "text").alias("record"))


def h8_rewrite_suffix(spark, sf_dir):
    path = F.concat(base_name(F.col("name")), F.lit(".corrected.txt"))
    return derived.v_files(spark, sf_dir).select(
        "doc_id", rewrite_suffix(path, ".corrected.txt", ".combined_output.json").alias("path"))


def h9_format_elapsed(spark, sf_dir):
    start = F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    elapsed = F.unix_seconds(F.col("ts").cast("timestamp")) - start
    return derived.v_poll(spark, sf_dir).select("event_id", format_elapsed(elapsed).alias("elapsed"))


def h10_format_run_stamp(spark, sf_dir):
    return derived.v_poll(spark, sf_dir).select("event_id", run_stamp(F.col("ts")).alias("stamp"))


def h11_split_lines(spark, sf_dir):
    # CRLF where the table has line ends, and a bare CR after each sentence.
    mixed = F.replace(F.replace("text", F.lit("\n"), F.lit("\r\n")), F.lit(". "), F.lit(".\r"))
    return derived.table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(split_lines(mixed)).alias("line_no", "line"))


def _misread(spark, sf_dir):
    """Texts in which letters were misread, and words read as one behind a mark that says where."""
    return derived.v_pairs(spark, sf_dir).select(
        "doc_id", F.replace("raw", F.lit(" and "), F.lit(" and_")).alias("raw"), "target")


def i1_correct_text(spark, sf_dir):
    pairs = _misread(spark, sf_dir)
    # Written first: its size decides how it is looked up.
    lexicon = cut_lineage(correct.paired_lexicon(pairs, "raw", "target"), "lexicon")
    return correct.correct_text(pairs.select("doc_id", "raw"), lexicon, text="raw").select(
        "doc_id", "corrected_text")


def i1_decode_text(spark, sf_dir):
    """Corrected by the model of misread letters that all texts teach, without a mark where words were joined."""
    pairs = derived.v_pairs(spark, sf_dir).select(
        "doc_id", F.replace("raw", F.lit(" and "), F.lit(" and")).alias("raw"), F.col("target").alias("corrected"))
    reading = decoding.learn_model(pairs, correct.aligned_words(pairs))
    return decoding.decode_texts(pairs.select("doc_id", "raw"), reading, text="raw").select("doc_id", "corrected_text")


def i1_aligned_words(spark, sf_dir):
    """How many words the misread texts have, and the share of them with a counterpart in the right ones."""
    counts = correct.unaligned_words(correct.aligned_words(_misread(spark, sf_dir), "raw", "target"))
    return counts.select("words", F.round(1 - F.col("unaligned") / F.greatest("words", F.lit(1)), 4).alias("aligned"))


def a5_read_prompts(spark, sf_dir):
    """The catalog of the package, written per language of the documents and read back as a user's own."""
    path = work_dir(spark, "prompts")
    catalog = {r.task: r.prompt for r in documents.read_prompts(spark).collect()}
    spoken = derived.table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n")).where("lang is not null")
    spoken.select("lang", *[F.concat(F.lit(prompt), F.lit(" Language: "), "lang", F.lit(", texts: "), F.col("n").cast("string")).alias(task)
                            for task, prompt in catalog.items()]).write.partitionBy("lang").json(path)
    langs = [r.lang for r in spoken.select("lang").orderBy("lang").collect()]
    return reduce(lambda a, b: a.unionByName(b), [
        documents.read_prompts(spark, f"{path}/lang={lang}").select(F.lit(lang).alias("lang"), "task", "prompt") for lang in langs])


def i1_corpus_lexicon(spark, sf_dir):
    return correct.corpus_lexicon(derived.table(spark, sf_dir, "documents"))


def i2_extract_entities(spark, sf_dir):
    found = entities.extract_entities(derived.v_entity_docs(spark, sf_dir),
                                      derived.gazetteer(spark, sf_dir), text="body")
    return _joined(found, "doc_id")


def i3_explain_entities(spark, sf_dir):
    knowledge = derived.v_knowledge(spark, sf_dir)
    look_up = lambda requests: entities.attach_explanations(requests, knowledge)
    rows = entities.explain_entities(derived.v_entities(spark, sf_dir), explain=look_up)
    return entities.latest_explanations(rows)


def i4_split_letters(spark, sf_dir):
    return letters.split_letters(derived.v_letters(spark, sf_dir), "conv_id", "body")


def _run(spark, sf_dir):
    """A run over the letter texts, misread by OCR; the status events say whose job failed."""
    bodies = derived.v_letters(spark, sf_dir).withColumnRenamed("conv_id", "doc_id")
    misread = F.replace("body", F.lit("th"), F.lit("tb"))
    lines = bodies.select("doc_id", F.posexplode(split_lines(misread)).alias("line_no", "text"))
    turns = derived.table(spark, sf_dir, "conversations")
    lexicon = cut_lineage(correct.paired_lexicon(
        turns.select(F.replace("text", F.lit("th"), F.lit("tb")).alias("raw"),
                     F.col("text").alias("corrected"))), "lexicon")
    conversations = turns.groupBy(F.col("conv_id").alias("doc_id")).agg(
        F.count("*").alias("turns"))
    jobs = _outcomes(spark, sf_dir).select(F.col("job_id").alias("doc_id"), "outcome")
    person = F.concat(F.lit("C"), F.col("doc_id").cast("string")).alias("name")
    people = conversations.select(F.lit("People").alias("category"), person, "turns")
    knowledge = people.select("category", F.col("name").alias("entity"), F.concat(
        F.lit("wrote "), F.col("turns").cast("string"), F.lit(" letters")).alias("explanation"))
    return document_run(bodies.select("doc_id"), lines, lexicon, people.select("category", "name"),
                        knowledge, RunConfig(order=("line_no",), materialise=True), jobs=jobs)


def i5_document_run(spark, sf_dir):
    """Status of every document after the whole run."""
    return _run(spark, sf_dir)["doc_status"]


def i5_run_letters(spark, sf_dir):
    return _run(spark, sf_dir)["letters"]


def i5_run_explanations(spark, sf_dir):
    return _run(spark, sf_dir)["explanations"].select(
        "doc_id", "category", "ord", "entity", "explanation")


def rule_backend():
    """Replies by rules, which fail for some texts: no correction of texts with a page heading, no
    list of entities for a signed page number, no JSON for texts that have no number."""
    def call(task, system, user):
        text = user if system else user.split("\nText:\n", 1)[1]
        if task == "correct_text":
            if text.startswith("Page ") or "|" in text:
                raise ValueError("unreadable")
            return text.replace("tb", "th")
        if task == "extract_entities":
            return "[]" if text.startswith("+") else json.dumps({c: [] for c in CATEGORIES})
        if text.startswith("Page "):
            raise ValueError("unreadable")
        return "no list" if text.startswith("Dear") else json.dumps([p for p in text.split("\n\n") if p.strip()])
    return call


def i5_run_failures(spark, sf_dir):
    """The whole run with a model that fails for some documents in each step."""
    bodies = derived.v_letters(spark, sf_dir).withColumnRenamed("conv_id", "doc_id")
    lines = bodies.select("doc_id", F.posexplode(split_lines(F.col("body"))).alias("line_no", "text"))
    model_ = Model(rule_backend, documents.read_prompts(spark), name="rules")
    tables = document_run(bodies.select("doc_id"), lines, model=model_,
                          config=RunConfig(order=("line_no",), materialise=True))
    return tables["doc_status"].select("doc_id", "status", "reason", "n_letters")


def i6_apply_model(spark, sf_dir):
    texts = derived.table(spark, sf_dir, "documents").select(
        "doc_id", _padded(F.col("text")).alias("text"))
    return ask(texts, "correct_text", _echo(spark)).select("doc_id", "response", "error")


def _echo(spark):
    """A model that replies with the text it gets, so that replies are known."""
    return Model("echo", documents.read_prompts(spark))


def i1_model_correction(spark, sf_dir):
    texts = derived.v_pairs(spark, sf_dir).select("doc_id", _padded(F.col("raw")).alias("text"))
    corrected = correct_with_model(texts, Model(rule_backend, documents.read_prompts(spark), name="rules"))
    return corrected.select("doc_id", "corrected_text", "error")


def i2_model_extraction(spark, sf_dir):
    texts = derived.v_responses(spark, sf_dir).select(
        F.col("request_id").alias("doc_id"), F.col("response").alias("text"))
    records = extract_with_model(texts, _echo(spark))
    return records.select("doc_id", F.col("entity_status").alias("status"),
                          *[F.array_join(c, "|").alias(c.lower()) for c in CATEGORIES])


def i3_model_explanations(spark, sf_dir):
    requests = entities.distinct_requests(derived.v_entities(spark, sf_dir))
    return explain_with_model(requests, _echo(spark))


def i4_model_letters(spark, sf_dir):
    texts = derived.v_letters(spark, sf_dir).select(F.col("conv_id").alias("doc_id"),
                                                    F.col("body").alias("text"))
    parted = split_with_model(texts, Model(rule_backend, documents.read_prompts(spark), name="rules"))
    return letters.letter_rows(parted.select("doc_id", "page_number", "letter_status", "letters"))


def j1_incremental_run(spark, sf_dir):
    """Every letter text arrives twice, first as a draft; the last arrival counts."""
    source, out, progress = (work_dir(spark, name) for name in ("arrivals", "letters", "progress"))
    texts = derived.v_letters(spark, sf_dir)
    for body in (F.concat(F.lit("draft "), "body"), F.col("body")):
        texts.select("conv_id", body.alias("body")).repartition(7, "conv_id").write.mode("append").parquet(source)
        incremental_run(
            spark, source, out, progress,
            lambda batch: {"letters": letters.split_letters(batch, "conv_id", "body")},
            batch_size=3, fmt="parquet", schema=texts.schema)
    return current(spark, f"{out}/letters", "conv_id").drop("batch_id")


def j2_job_tracker(spark, sf_dir):
    """Tracked over a stream of shuffled events with a deadline.

    Two events of no job, long after the others, end it: one in the micro-batch of the last events moves the
    watermark past them all, the other begins a micro-batch in which all outcomes are due.
    """
    source, out = work_dir(spark, "polls"), work_dir(spark, "outcomes")
    events = derived.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("job_id"), "event_id", F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") == "purchase", "SUCCEEDED")
        .when(F.col("event_type") == "error", "FAILED").otherwise("IN_PROGRESS").alias("status"))
    events.repartition(3, F.xxhash64("event_id")).write.parquet(source)
    span = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).select(
        "last", (F.unix_seconds("last") - F.unix_seconds("first") + 1).alias("seconds")).first()
    if span.last is not None:
        none = lambda name: F.lit(None).cast(events.schema[name].dataType).alias(name)
        later = F.timestamp_seconds(F.unix_seconds(F.lit(span.last)) + 2 * span.seconds + 3 * DEADLINE_SECONDS)
        for _ in range(2):
            spark.range(1).select(none("job_id"), F.lit(0).cast(events.schema["event_id"].dataType).alias("event_id"), later.alias("ts"),
                                  F.lit("IN_PROGRESS").alias("status")).write.mode("append").parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 4).parquet(source)
    # Events are shuffled over their whole span, so they may come that late.
    wait = f"{span.seconds if span.last is not None else 1} seconds"
    tracked = track_jobs(stream, MAX_POLLS, deadline_seconds=DEADLINE_SECONDS, watermark=wait).where("job_id is not null")
    query = (tracked.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", work_dir(spark, "progress"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(tracked.schema).parquet(out)


def _turn_pairs(spark, sf_dir):
    return derived.v_turns(spark, sf_dir).select(
        "doc_id", F.replace("text", F.lit("th"), F.lit("tb")).alias("raw"),
        F.col("text").alias("corrected"))


def k1_edit_distance(spark, sf_dir):
    measured = evaluate.edit_distance(_turn_pairs(spark, sf_dir), "raw", "corrected")
    return measured.select("doc_id", "distance", F.round("similarity", 6).alias("similarity"))


def _spread_pairs(spark, sf_dir):
    """Texts and their misread form. Measuring costs far more than reading, so texts are spread."""
    texts = derived.table(spark, sf_dir, "documents").select("doc_id", "text").repartition("doc_id")
    return texts.withColumn("raw", F.replace("text", F.lit("th"), F.lit("tb"))).withColumn(
        "longer", F.replace("text", F.lit("th"), F.lit("tth")))


def k1_line_distance(spark, sf_dir):
    return evaluate.line_distance(_spread_pairs(spark, sf_dir), "raw", "text")


def k1_document_distance(spark, sf_dir):
    """Whole documents against a reading with letters added, whose distance follows from the lengths."""
    measured = evaluate.edit_distance(_spread_pairs(spark, sf_dir), "longer", "text")
    return measured.select("doc_id", "distance", F.round("similarity", 6).alias("similarity"))


def k2_word_count(spark, sf_dir):
    pairs = derived.v_pairs(spark, sf_dir).select(
        "doc_id", "raw", correct.effective_text(F.col("raw"), F.col("corrected")).alias("text"))
    return evaluate.word_counts(pairs, "raw", "text").select(
        "doc_id", "raw_words", "corrected_words", "word_delta")


def k3_run_consistency(spark, sf_dir):
    runs = derived.versions(derived.v_turns(spark, sf_dir), "doc_id", F.col("text"))
    measured = evaluate.run_consistency(runs)
    return measured.select("doc_id", "n_runs", "n_variants",
                           F.round("identical_share", 6).alias("identical_share"),
                           F.round("avg_distance", 6).alias("avg_distance"), "min_distance", "max_distance")


QUERIES = {f.__name__: f for f in (
    a1_scan_documents, a2_read_ocr_pages, a2_assemble_pages, a2_incomplete_jobs, a3_read_layout_pages, a4_read_text, a5_read_prompts,
    a6_write_text, a7_write_json, b1_is_supported_file, b2_derive_paths, b3_lower_extension,
    b4_route_preparation, b5_guess_content_type, b6_split_blocks, b7_effective_text,
    b8_failed_documents, b9_warn_empty_ocr, d1_handoff, d2_attach_prompt, d3_attach_responses,
    d4_attach_explanations, e1_assemble_raw_text, e2_collect_boxes, e3_last_wins_by_key,
    e4_build_entity_record, e5_build_explanation_maps, e6_run_summary, f1_assign_batches,
    f2_number_pages, f3_first_terminal_status, g1_unpivot_entities, g2_distinct_requests,
    h1_py_strip, h2_parse_page_number, h3_strict_json, h4_validate_entities, h5_parse_letters,
    h6_render_prompt, h7_to_json_record, h8_rewrite_suffix, h9_format_elapsed,
    h10_format_run_stamp, h11_split_lines, i1_correct_text, i1_aligned_words, i1_decode_text, i1_corpus_lexicon,
    i1_model_correction, i2_extract_entities, i2_model_extraction, i3_explain_entities,
    i3_model_explanations, i4_split_letters, i4_model_letters, i5_document_run, i5_run_letters,
    i5_run_explanations, i5_run_failures, i6_apply_model, j1_incremental_run, j2_job_tracker, k1_edit_distance,
    k1_line_distance, k1_document_distance, k2_word_count, k3_run_consistency,
)}
