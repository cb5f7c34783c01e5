"""Inputs of the registered queries, derived from the given tables.

Every view covers its whole tables and whole texts.
"""

from __future__ import annotations

from json.encoder import encode_basestring

import pyarrow as pa
from pyspark.sql import functions as F

from scriptorium.functions.text import split_lines
from scriptorium.operators.layout import ordered_items

LINES_PER_PAGE = 5


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def v_files(spark, sf_dir):
    """File names with hidden prefixes, mixed-case and double extensions; names repeat."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    extension = (F.when(F.col("doc_id") % 8 == 0, ".jpg").when(F.col("doc_id") % 8 == 1, ".JPEG")
                 .when(F.col("doc_id") % 8 == 2, ".png").when(F.col("doc_id") % 8 == 3, ".tif")
                 .when(F.col("doc_id") % 8 == 4, ".TIFF").when(F.col("doc_id") % 8 == 5, ".pdf")
                 .when(F.col("doc_id") % 8 == 6, ".txt").otherwise(".tar.gz"))
    name = F.concat(F.when(F.col("doc_id") % 11 == 0, "._").otherwise(""), "source", F.lit("_"),
                    (F.col("doc_id") % 13).cast("string"), extension)
    return docs.select("doc_id", F.col("n_chars").alias("length"), name.alias("name"))


def v_lines(spark, sf_dir):
    """One row per text line, five lines to a page."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(split_lines(F.col("text"))).alias("pos", "text")).select(
        "doc_id", (F.floor(F.col("pos") / LINES_PER_PAGE) + 1).cast("int").alias("page"),
        F.col("pos").alias("line_no"), "text")


def v_layout(spark, sf_dir):
    """Documents as layout results: pages of five lines, the last one may be shorter."""
    lines = split_lines(F.col("text"))
    starts = F.sequence(F.lit(1), F.size("_lines"), F.lit(LINES_PER_PAGE))
    line = lambda text: F.struct(text.alias("content"),
                                 F.lit(None).cast("array<double>").alias("polygon"))
    pages = F.transform(starts, lambda s: F.struct(
        F.transform(F.slice("_lines", s, LINES_PER_PAGE), line).alias("lines")))
    return (table(spark, sf_dir, "documents").select("doc_id", lines.alias("_lines"))
            .select("doc_id", pages.alias("pages")))


def v_blocks(spark, sf_dir):
    """LINE, WORD and PAGE blocks of :func:`v_lines`, with made-up confidences and boxes."""
    lines = v_lines(spark, sf_dir)
    words = lines.select("doc_id", "page", "line_no", F.posexplode(F.split("text", " "))
                         .alias("word_no", "text")).where(F.col("text") != "")
    box = lambda left: F.struct(
        left.cast("double").alias("Left"), F.col("line_no").cast("double").alias("Top"),
        F.length("text").cast("double").alias("Width"), F.lit(1.0).alias("Height")).alias("box")
    line_rows = lines.select(
        "doc_id", "page", "line_no", F.lit(-1).alias("word_no"), F.lit("LINE").alias("block_type"),
        "text", F.lit(99.0).alias("confidence"), box(F.lit(0)))
    word_rows = words.select(
        "doc_id", "page", "line_no", "word_no", F.lit("WORD").alias("block_type"), "text",
        (50 + (F.length("text") * 7 + F.col("word_no")) % 50).cast("double").alias("confidence"),
        box(F.col("word_no")))
    page_rows = lines.select("doc_id", "page").distinct().select(
        "doc_id", "page", F.lit(-1).alias("line_no"), F.lit(-1).alias("word_no"),
        F.lit("PAGE").alias("block_type"), F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("double").alias("confidence"),
        F.lit(None).cast("struct<Left:double,Top:double,Width:double,Height:double>").alias("box"))
    return line_rows.unionByName(word_rows).unionByName(page_rows)


def v_response_pages(spark, sf_dir):
    """Blocks as response pages, built inside the document rows: job_id, page_ord, response."""
    return response_pages(v_layout(spark, sf_dir))


def _dealt_pages(layouts, spread=("doc_id", "_pos")):
    """A row per page, ``_pos`` and ``_page``. Building blocks costs far more than reading, so the pages are dealt out to tasks first."""
    others = [c for c in layouts.columns if c not in ("doc_id", "pages")]
    return layouts.select("doc_id", F.col("doc_id").cast("string").alias("job_id"), *others,
                          F.posexplode_outer("pages").alias("_pos", "_page")).repartition(*spread)


def response_pages(layouts, spread=("doc_id", "_pos")):
    """Layouts (doc_id, pages) as response pages; more columns of a document go to each of its pages.

    By ``spread`` they are dealt out; pages that are dealt out by ``job_id`` alone are there with all of their document.
    """
    others = [c for c in layouts.columns if c not in ("doc_id", "pages")]
    pages = _dealt_pages(layouts, spread)
    box = lambda left, top, text: F.struct(F.struct(
        left.cast("double").alias("Left"), top.cast("double").alias("Top"),
        F.length(text).cast("double").alias("Width"), F.lit(1.0).alias("Height"))
        .alias("BoundingBox"))
    block = lambda kind, text, confidence, geometry: F.struct(
        F.lit(kind).alias("BlockType"), text.alias("Text"), confidence.alias("Confidence"),
        geometry.alias("Geometry"))
    top = lambda i: F.col("_pos") * LINES_PER_PAGE + i
    page_block = block("PAGE", F.lit(None).cast("string"), F.lit(None).cast("double"),
                       box(F.lit(0), F.lit(0), F.lit("")))
    line_blocks = F.transform("_page.lines", lambda l, i: block(
        "LINE", l["content"], F.lit(99.0), box(F.lit(0), top(i), l["content"])))
    word_blocks = F.flatten(F.transform("_page.lines", lambda l, i: F.filter(
        F.transform(F.split(l["content"], " "), lambda w, j: block(
            "WORD", w, (50 + (F.length(w) * 7 + j) % 50).cast("double"), box(j, top(i), w))),
        lambda b: b["Text"] != "")))
    return pages.select(
        "job_id", F.col("_pos").cast("bigint").alias("page_ord"),
        F.lit("SUCCEEDED").alias("JobStatus"),
        F.concat(F.array(page_block), line_blocks, word_blocks).alias("Blocks"), *others)


def response_lines(layouts, more=lambda page_ord: {}, wanted=lambda page_ord: F.lit(True)):
    """:func:`response_pages` as JSON, a line each, where ``wanted`` of its number holds; the text is put together in Python.

    ``more`` has further fields as strings by name, or another ``JobStatus``; what is null is left out.
    """
    page_ord = F.col("_pos").cast("bigint")
    fields = {"JobStatus": F.lit("SUCCEEDED")} | more(page_ord)
    pages = _dealt_pages(layouts).where(wanted(page_ord)).select(
        "job_id", page_ord.alias("page_ord"), F.transform("_page.lines", lambda l: l["content"]).alias("lines"),
        *[value.alias(name) for name, value in fields.items()])
    return pages.mapInArrow(_written, "value string")


# Text that goes to Spark at once.
BATCH_CHARS = 4 << 20


def _blocks(lines, first):
    """The blocks of a page as JSON; ``first`` is the number of its first line. A line that is null leaves none of them."""
    if lines is None or None in lines:
        return None
    # What neighbouring blocks share stands together, which packs better.
    box = '"Geometry":{"BoundingBox":{"Height":1,"Top":%d,"Left":0,"Width":%d}}'
    out = ['{"BlockType":"PAGE",' + box % (0, 0) + "}"]
    out += ['{"Text":%s,"BlockType":"LINE",' % encode_basestring(line) + box % (top, len(line)) + ',"Confidence":99}'
            for top, line in enumerate(lines, first)]
    for top, line in enumerate(lines, first):
        head = f',"BlockType":"WORD","Geometry":{{"BoundingBox":{{"Height":1,"Top":{top},"Left":'
        out += [f'{{"Text":{encode_basestring(w)}{head}{j},"Width":{len(w)}}}}},"Confidence":{50 + (len(w) * 7 + j) % 50}}}'
                for j, w in enumerate(line.split(" ")) if w]
    return "[" + ",".join(out) + "]"


def _written(batches):
    """Pages (job_id, page_ord, lines, further fields) as lines of JSON."""
    rows, size = [], 0
    for batch in batches:
        names = batch.schema.names[3:]
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            for job_id, page_ord, lines, *others in zip(*(c.to_pylist() for c in part.columns)):
                fields = {"job_id": None if job_id is None else encode_basestring(job_id), "page_ord": page_ord} | {
                    name: None if value is None else encode_basestring(value) for name, value in zip(names, others)} | {
                    "Blocks": None if page_ord is None else _blocks(lines, page_ord * LINES_PER_PAGE)}
                rows.append("{" + ",".join([f'"{name}":{value}' for name, value in fields.items() if value is not None]) + "}")
                size += len(rows[-1])
                if size >= BATCH_CHARS:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["value"])
                    rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["value"])


def v_responses(spark, sf_dir):
    """Ten shapes of model replies."""
    shape = F.col("c_custkey") % 10
    full = F.concat(F.lit('{"People":["'), "c_name", F.lit('"],"Productions":[],"Companies":["'),
                    "c_mktsegment", F.lit('"],"Theaters":[],"Dates":["1920"]}'))
    rest = '"Productions":[],"Companies":[],"Theaters":[],"Dates":[]'
    reply = (F.when(shape == 0, full)
             .when(shape == 1, '{"People":["x"]}')
             .when(shape == 2, '{"People":["x","y"],' + rest + ',"Extra":1}')
             .when(shape == 3, '{"People":["x",1],' + rest + "}")
             .when(shape == 4, '["letter one","letter two"]')
             .when(shape == 5, "not json")
             .when(shape == 6, '["letter one"] trailing note')
             .when(shape == 7, "")
             .when(shape == 8, '["letter one",2]')
             .otherwise('{"People":null,' + rest + "}"))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("request_id"), reply.alias("response"))


def v_letters(spark, sf_dir):
    """One text per conversation: a letter per turn, below a page number line of several kinds."""
    number = F.col("conv_id").cast("string")
    head = (F.when(F.col("conv_id") % 4 == 0, F.concat(number, F.lit("\n")))
            .when(F.col("conv_id") % 4 == 1, F.concat(F.lit("Page "), number, F.lit("\n")))
            .when(F.col("conv_id") % 4 == 2, F.concat(F.lit("  +"), number, F.lit(" \n")))
            .otherwise(""))
    letter = F.concat(F.lit("Dear Sir:\n"), "text", F.lit("\nYours truly,\nC"), number, F.lit("\n\n"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", letter.alias("letter"))
    return (turns.groupBy("conv_id").agg(F.array_join(ordered_items(["turn"], "letter"), "")
                                         .alias("_letters"))
            .select("conv_id", F.concat(head, "_letters").alias("body")))


def v_entity_docs(spark, sf_dir):
    """One sentence per order with a person, a theater and a date."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    body = F.concat(F.lit("Dear "), "c_name", F.lit(", your company of "), "n_name",
                    F.lit(" wrote on "), F.col("o_orderdate").cast("date").cast("string"),
                    F.lit(" about "), "c_name", F.lit("."))
    return (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("o_orderkey").alias("doc_id"), body.alias("body")))


def gazetteer(spark, sf_dir):
    """Names of people and theaters."""
    people = table(spark, sf_dir, "customer").select(
        F.lit("People").alias("category"), F.col("c_name").alias("name"))
    theaters = table(spark, sf_dir, "nation").select(
        F.lit("Theaters").alias("category"), F.col("n_name").alias("name"))
    return people.unionByName(theaters)


def v_poll(spark, sf_dir):
    """Status events of jobs."""
    status = (F.when(F.col("event_type") == "purchase", "SUCCEEDED")
              .when(F.col("event_type") == "error", "FAILED").otherwise("IN_PROGRESS"))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("job_id"), "event_id", "ts", status.alias("status"))


def versions(df, key, text):
    """Three runs per text: 0 as read, 1 corrected, 2 corrected again with another mistake."""
    variants = F.array(F.replace(text, F.lit("th"), F.lit("tb")), text,
                       F.replace(text, F.lit("an"), F.lit("am")))
    return df.select(key, F.posexplode(variants).alias("run", "text"))


def v_pairs(spark, sf_dir):
    """Raw and corrected text of every document; correction failed (NULL) or gave '' for some."""
    replied = (F.when(F.col("doc_id") % 5 == 0, F.lit(None)).when(F.col("doc_id") % 5 == 1, "")
               .otherwise(F.col("text")))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.replace("text", F.lit("th"), F.lit("tb")).alias("raw"),
        F.col("text").alias("target"), replied.alias("corrected"))


def v_turns(spark, sf_dir):
    """Single conversation turns as short documents."""
    return table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("doc_id"), "text")


def v_entities(spark, sf_dir):
    """Entities of orders in long form, with repeats: doc_id, ord, category, entity."""
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").cast("bigint").alias("ord"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # One scan of each large table: a row gives all its entities at once.
    entry = lambda category, entity: F.struct(F.lit(category).alias("category"), entity.alias("entity"))
    bought = (lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
              .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
              .select(F.col("l_orderkey").alias("doc_id"), "ord", F.explode(F.array(
                  entry("Productions", F.col("p_name")), entry("Companies", F.col("s_name")))).alias("e")))
    ordered = (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
               .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
               .select(F.col("o_orderkey").alias("doc_id"), F.lit(1).cast("bigint").alias("ord"), F.explode(F.array(
                   entry("People", F.col("c_name")), entry("Theaters", F.col("n_name")),
                   entry("Dates", F.col("o_orderdate").cast("date").cast("string")))).alias("e")))
    return bought.unionByName(ordered).select("doc_id", "ord", "e.category", "e.entity")


def v_knowledge(spark, sf_dir):
    """Explanations by (category, entity); dates have none."""
    part = table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")

    def known(df, category, entity, explanation):
        return (df.groupBy(F.col(entity).alias("entity"))
                .agg(F.max(explanation).alias("explanation"))
                .select(F.lit(category).alias("category"), "entity", "explanation"))

    return (
        known(part, "Productions", "p_name", F.concat_ws(" / ", "p_type", "p_brand"))
        .unionByName(known(supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")),
                           "Companies", "s_name", F.concat(F.lit("supplier "), "n_name")))
        .unionByName(known(customer, "People", "c_name", F.col("c_mktsegment")))
        .unionByName(known(nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")),
                           "Theaters", "n_name", F.col("r_name"))))
