"""Identity of rows whose id may be null or repeated."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T


def with_identity(docs, key="doc_id", text="text", extra=()):
    """doc_id, text and ``_h``, a hash of the text: together they name a row up to exact repetition.

    Joining on both is right also where ids are null or name several texts.
    """
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), *extra,
                       F.xxhash64(F.col(text)).alias("_h"))


def same_row(left, right):
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["_h"] == right["_h"])


def packed(docs, *more):
    """All columns, whatever their names, as one struct ``_doc``, and ``more`` columns beside it."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *more)


def with_text(docs, keep, text):
    """The ``keep`` columns and, last, the text under a name that none of them has."""
    name = "_text"
    while name in keep:
        name = "_" + name
    return docs.select(*keep, F.col(text).alias(name))


def result_schema(docs, keep, more):
    """The types of the ``keep`` columns followed by ``more``, given as DDL."""
    return T.StructType([*docs.select(*keep).schema.fields, *T.StructType.fromDDL(more).fields])
