"""Column functions over file names: selection, paths, preparation route, content type."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

# File suffixes that are read, and the content types of prepared files.
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".tif", ".tiff")
SUPPORTED_SUFFIXES = (".jpg", ".jpeg", ".pdf", ".png", ".tif", ".tiff")
CONTENT_TYPES = {
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".pdf": "application/pdf",
    ".png": "image/png",
    ".tif": "image/tiff",
    ".tiff": "image/tiff",
}
DEFAULT_CONTENT_TYPE = "application/octet-stream"
HIDDEN_PREFIX = "._"

# The last dot starts the extension, but leading dots belong to the base name.
_STEM_AND_EXT = r"(?s)^(\.*[^.].*)(\.[^.]*)$"


def is_supported_file(name, suffixes=SUPPORTED_SUFFIXES):
    lowered = F.lower(name)
    any_suffix = reduce(lambda a, b: a | b, [lowered.endswith(s) for s in suffixes])
    return ~name.startswith(HIDDEN_PREFIX) & any_suffix


def base_name(name):
    """Name without its extension (``a.tar.gz`` -> ``a.tar``, ``.hidden`` -> ``.hidden``)."""
    stem = F.regexp_extract(name, _STEM_AND_EXT, 1)
    return F.when(stem == "", name).otherwise(stem)


def file_ext(name):
    """Lower-case extension with its dot, ``''`` when there is none."""
    return F.lower(F.regexp_extract(name, _STEM_AND_EXT, 2))


def content_type(path):
    """Content type by extension of the last path element, with a general default."""
    known = F.create_map(*[F.lit(x) for pair in CONTENT_TYPES.items() for x in pair])
    ext = file_ext(F.substring_index(path, "/", -1))
    return F.coalesce(F.try_element_at(known, ext), F.lit(DEFAULT_CONTENT_TYPE))


def derive_paths(df, name="name", tmp="tmp", source="input", output="output"):
    """Add base name, source path, pdf path, object key and output folder of every file."""
    base = base_name(F.col(name))
    return df.withColumns({
        "base_name": base,
        "path_to_file": F.concat_ws("/", F.lit(source), F.col(name)),
        "pdf_file": F.concat(F.lit(tmp + "/"), base, F.lit(".pdf")),
        "s3_pdf_key": F.concat(base, F.lit(".pdf")),
        "doc_output_dir": F.concat_ws("/", F.lit(output), base),
    })


def route_preparation(df, provider, name="name", tmp="tmp"):
    """Add ``action`` and ``prepared_path`` for rows that went through :func:`derive_paths`.

    ``aws``: a pdf passes through and everything else is converted to pdf. ``azure``: an image
    is resized and everything else, pdf included, is converted to pdf.
    """
    ext = file_ext(F.col(name))
    if provider == "aws":
        special, action = ext == ".pdf", "pass"
        special_path = F.col("path_to_file")
    elif provider == "azure":
        special, action = ext.isin(*IMAGE_SUFFIXES), "resize"
        special_path = F.concat(F.lit(tmp + "/"), F.col("base_name"), F.lit("_resized"), ext)
    else:
        raise ValueError(f"unknown provider: {provider}")
    return df.withColumns({
        "action": F.when(special, action).otherwise("convert"),
        "prepared_path": F.when(special, special_path).otherwise(F.col("pdf_file")),
    })
