"""Input folders, text files and the prompt catalog."""

from __future__ import annotations

import json
from importlib import resources

from pyspark.sql import functions as F

from scriptorium.functions.files import SUPPORTED_SUFFIXES, is_supported_file
from scriptorium.sources.listing import list_files, read_bodies


def packaged_prompts():
    """The catalog that comes with the package, also when that is a zip."""
    return json.loads(resources.files("scriptorium.sources").joinpath("prompts.json").read_text("utf-8"))


def scan_documents(spark, path, with_content=False, suffixes=SUPPORTED_SUFFIXES, recursive=False):
    """Supported files of a folder: path, name, length and, if asked for, content.

    Folders are listed and files read in tasks (:mod:`sources.listing`); empty files, names and folders that
    Spark's own sources hide are documents like others. ``._`` names are none.
    """
    files = list_files(spark, path, recursive).where(is_supported_file(F.col("name"), suffixes))
    return (read_bodies(files) if with_content else files).select("path", "name", "length", *(["content"] if with_content else []))


def universal_newlines(text):
    return F.regexp_replace(text, "\r\n?", "\n")


def text_bodies(files):
    """Text files (path, name, length, modified) as (path, name, text)."""
    text = F.try_validate_utf8(F.col("content").cast("string"))
    return read_bodies(files).select("path", "name", universal_newlines(text).alias("text"))


def read_text(spark, path, suffixes=(".txt",), recursive=False):
    """Whole text files as (path, name, text), UTF-8, with every line end read as a newline.

    A file that is not UTF-8 gives NULL text instead of an error.
    """
    return text_bodies(list_files(spark, path, recursive).where(is_supported_file(F.col("name"), suffixes)))


def read_prompts(spark, path=None):
    """Prompt catalog as (task, prompt); without a path the catalog that comes with the package."""
    if path is None:
        return spark.createDataFrame(sorted(packaged_prompts().items()), "task string, prompt string")
    catalog = spark.read.option("multiLine", True).json(path)
    return catalog.unpivot([], catalog.columns, "task", "prompt")
