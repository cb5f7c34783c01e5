"""Page number and single letters of a document text."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions.text import parse_page_number, py_strip
from scriptorium.operators.layout import number_pages

# How a letter opens and how it is signed off.
GREETING = r"^(Dear|Friend|Gentlemen)"
SIGN_OFF = r"^(Sincerely yours|Yours truly|Yours sincerely)"


def _letter_starts(codes):
    """The line numbers where letters start, from one code per line as a string.

    Codes: ``b`` blank, ``s`` sign-off, ``g`` greeting, ``h`` both, ``x`` any other line. The first
    blank line after a sign-off closes a segment. A segment opens a new letter when it holds a
    greeting and an earlier segment held one too; otherwise it belongs to the letter before it. Every
    step goes once over a string or an array, so the work is linear in the lines.
    """
    segments = F.regexp_extract_all(codes, F.lit("[^sh]*+[sh][^b]*+b|.+"), F.lit(0))
    greeted = F.array_join(F.transform(
        segments, lambda s: F.when(s.rlike("[gh]"), F.concat(F.lit("|"), s)).otherwise(s)), "")
    parts = F.split(F.regexp_replace(greeted, r"^([^|]*+)\|", "$1"), r"\|")
    opened = F.array_join(F.transform(parts, lambda p: F.concat(F.lit("^"), F.substr(p, F.lit(2)))), "")
    places = F.transform(F.split(opened, ""), lambda c, i: F.when(c == "^", i))
    return F.filter(places, lambda i: i.isNotNull())


def letter_arrays(df, text="text", greeting=GREETING, signoff=SIGN_OFF, letters="letters"):
    """Add the letters of every text as an array; joined by newline they give the text back.

    A text lies in one row, so everything happens inside it: no explode and no shuffle. Empty
    text has no letters.
    """
    def code(line):
        signs, greets = line.rlike(signoff), line.rlike(greeting)
        return (F.when(py_strip(line) == "", "b").when(signs & greets, "h")
                .when(signs, "s").when(greets, "g").otherwise("x"))

    marked = (df.withColumn("_lines", F.split(F.col(text), "\n"))
              .withColumn("_starts", _letter_starts(F.array_join(F.transform("_lines", code), ""))))
    end = lambda i: F.coalesce(F.get("_starts", i + 1), F.size("_lines"))
    cut = F.transform(
        "_starts",
        lambda s, i: F.array_join(F.slice("_lines", s + 1, end(i) - s), "\n"))
    empty = F.expr("array()").cast("array<string>")
    return (marked.withColumn(letters, F.when(F.col(text) == "", empty).otherwise(cut))
            .drop("_lines", "_starts"))


def split_letters(df, key="doc_id", text="text", greeting=GREETING, signoff=SIGN_OFF):
    """One row per letter: key, page number, letter number from 1 and the letter."""
    arrays = letter_arrays(df, text, greeting, signoff).select(
        key, parse_page_number(F.col(text)).alias("page_number"), "letters")
    return letter_rows(arrays)


def letter_rows(records, letters="letters"):
    """Records with a letter list to one row per letter, numbered from 1."""
    rows = number_pages(records, letters, "letter_no", "letter")
    return rows.withColumn("letter_no", F.col("letter_no").cast("bigint"))
