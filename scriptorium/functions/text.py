"""Column functions over text, numbers and timestamps."""

from __future__ import annotations

from pyspark.sql import functions as F

# The characters that Python counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Line ends and the integer format of a page number line.
LINE_END = "\r\n|\n|\r"
PAGE_NUMBER = r"^([+-]?[0-9]+(?:_[0-9]+)*)$"
RUN_STAMP_FORMAT = "MM-dd-yyyy_HH-mm-ss"


def py_strip(text):
    """Remove Unicode white space at both ends; inner white space stays."""
    return F.btrim(text, F.lit(WHITESPACE))


def split_lines(text):
    """Lines of a text under universal newlines; ``''`` gives one empty line."""
    return F.split(text, LINE_END)


def first_line(text):
    return F.regexp_extract(text, r"^([^\r\n]*)", 1)


def parse_page_number(text):
    """The first line as BIGINT when it is an integer and nothing else, NULL otherwise."""
    number = F.regexp_extract(py_strip(first_line(text)), PAGE_NUMBER, 1)
    digits = F.replace(number, F.lit("_"), F.lit(""))
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def word_count(text):
    """Number of maximal runs without white space."""
    blanks = F.translate(text, WHITESPACE, " " * len(WHITESPACE))
    return F.size(F.filter(F.split(blanks, " "), lambda w: w != "")).cast("bigint")


def rewrite_suffix(path, old, new):
    """Replace every occurrence of ``old`` in a path."""
    return F.replace(path, F.lit(old), F.lit(new))


def format_elapsed(seconds):
    """``{h}h {m}m {s}s`` of a non-negative number of seconds; negative input gives NULL."""
    whole = F.floor(seconds).cast("bigint")
    parts = F.concat(
        F.floor(whole / 3600).cast("string"), F.lit("h "),
        F.floor(F.pmod(whole, F.lit(3600)) / 60).cast("string"), F.lit("m "),
        F.pmod(whole, F.lit(60)).cast("string"), F.lit("s"),
    )
    return F.when(whole >= 0, parts)


def run_stamp(ts):
    return F.date_format(ts, RUN_STAMP_FORMAT)
