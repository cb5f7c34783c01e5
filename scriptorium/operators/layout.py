"""OCR blocks and page layouts to lines, words, boxes and raw text."""

from __future__ import annotations

from pyspark.sql import functions as F

LINE, WORD = "LINE", "WORD"


def ocr_lines(blocks):
    """LINE blocks without the word-only columns."""
    return blocks.where(F.col("block_type") == LINE).drop("block_type", "confidence", "box")


def ocr_words(blocks):
    """WORD blocks: text, confidence and box, next to their keys."""
    return blocks.where(F.col("block_type") == WORD).drop("block_type")


def number_pages(df, array_col, page_col="page", item_col="item"):
    """One row per array element, numbered from 1; a NULL array counts as empty.

    The outer explode keeps Spark from adding a filter on the size of the array, which would
    compute an array that is itself an expression a second time.
    """
    others = [c for c in df.columns if c != array_col]
    return (df.select(*others, F.posexplode_outer(array_col).alias("_pos", item_col))
            .where(F.col("_pos").isNotNull())
            .select(*others, (F.col("_pos") + 1).alias(page_col), item_col))


def flatten_layout(df, pages="pages", key="doc_id"):
    """Documents with nested pages and lines to one row per line.

    ``pages`` is ``array<struct<lines: array<struct<content, polygon>>>>``. The page number
    starts at 1; ``line_no`` counts lines through the whole document from 0. NULL pages or lines
    count as empty. Only explodes: no shuffle.
    """
    none = F.expr("array()")
    numbered = F.transform(
        F.coalesce(F.col(pages), none.cast(df.schema[pages].dataType)),
        lambda page, i: F.transform(page["lines"], lambda line: F.struct(
            (i + 1).alias("page"), line["content"].alias("text"),
            F.coalesce(line["polygon"], none.cast("array<double>")).alias("polygon"))))
    lines = F.flatten(F.filter(numbered, lambda page: page.isNotNull()))
    return (df.select(key, F.posexplode(lines).alias("line_no", "_line"))
            .select(key, "_line.page", "line_no", "_line.text", "_line.polygon"))


def ordered_items(order, value):
    """Aggregate: the values of a group as an array in the order of the ``order`` columns."""
    pairs = F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("_value"))))
    return F.transform(pairs, lambda p: p["_value"])


def assemble_text(lines, key="doc_id", order=("page", "line_no"), text="text", sep="\n"):
    """One row per document: its lines joined in order, as ``raw_text``.

    The collected group is the text of one document, which has to fit in one cell anyway. ``key``
    may be several columns, for instance document and page.
    """
    joined = F.array_join(ordered_items(order, text), sep)
    return lines.groupBy(key).agg(joined.alias("raw_text"), F.count("*").alias("n_lines"))


def with_empty_documents(files, raw, key="doc_id"):
    """Add documents without any line; their raw text is ``''``."""
    return files.select(key).join(raw, key, "left").select(
        key, F.coalesce("raw_text", F.lit("")).alias("raw_text"),
        F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines"))


def empty_documents(files, lines, key="doc_id"):
    """Documents for which no line was read."""
    return files.join(lines.select(key).distinct(), key, "left_anti")


def page_boxes(pages, key="job_id", order="page_ord", blocks="Blocks"):
    """One row per document: its word boxes in order, straight from response pages.

    The words of a page are picked inside its row, so one array per page is shuffled and not a row
    per word.
    """
    none = F.expr("array()").cast(pages.schema[blocks].dataType)
    words = F.transform(
        F.filter(F.coalesce(F.col(blocks), none), lambda b: b["BlockType"] == WORD),
        lambda b: F.struct(b["Text"].alias("text"), b["Confidence"].alias("confidence"),
                           b["Geometry"]["BoundingBox"].alias("box")))
    ordered = F.array_sort(F.collect_list(F.struct(order, "_words")))
    per_page = pages.select(key, order, words.alias("_words")).where(F.size("_words") > 0)
    return per_page.groupBy(key).agg(
        F.flatten(F.transform(ordered, lambda p: p["_words"])).alias("boxes"))


def collect_boxes(words, key="doc_id", order=("page", "line_no", "word_no"),
                  fields=("text", "confidence", "box")):
    """One row per document: its boxes as an ordered array of structs, without the order.

    For words that come as rows; :func:`page_boxes` shuffles less where they come as pages.
    """
    pairs = F.array_sort(F.collect_list(F.struct(*order, F.struct(*fields).alias("_box"))))
    return words.groupBy(key).agg(F.transform(pairs, lambda p: p["_box"]).alias("boxes"))


def assemble_pages(pages, key="job_id", order="page_ord", blocks="Blocks"):
    """Raw text straight from response pages, without a row per block.

    The lines of a page are picked inside its row, so that only one array per page is shuffled.
    """
    lines = F.transform(
        F.filter(F.coalesce(F.col(blocks), F.expr("array()").cast(pages.schema[blocks].dataType)),
                 lambda b: b["BlockType"] == LINE),
        lambda b: b["Text"])
    per_page = pages.select(key, order, lines.alias("_lines"))
    ordered = F.array_sort(F.collect_list(F.struct(order, "_lines")))
    return (per_page.groupBy(key).agg(
        F.flatten(F.transform(ordered, lambda p: p["_lines"])).alias("_all"))
        .select(key, F.array_join("_all", "\n").alias("raw_text"),
                F.size("_all").cast("bigint").alias("n_lines")))
