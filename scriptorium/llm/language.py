"""Language identification by compression: the dictionary that shortens a text most names it."""

from __future__ import annotations

import math
import random

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Window, functions as F

from scriptorium.llm.rows import result_schema, with_text

UNKNOWN = "und"
DOCUMENTS_PER_LANGUAGE = 400
# Bounds of the fit over all languages, which share them: documents that are sampled, bytes of all dictionaries.
SAMPLE_DOCUMENTS, ALL_DICTIONARIES = 200_000, 24 << 20
# Of more languages the most frequent are learned.
MAX_LANGUAGES = 20_000
SPARE = 4
DICTIONARY_BYTES = 48 << 10
PIECE_BYTES = 1500
RUN_CHARACTERS = 60
BLOCK_BYTES = 16 << 10
LEVEL = 6
MARGIN = 0.01
# Marks belong to the letters before them: without them Indic and Thai words fall apart.
_BREAK = regex.compile(r"[^\p{L}\p{M}]+")


def letters_only(text):
    """Lower-cased words with single spaces: case, digits and punctuation say little on a language."""
    return _BREAK.sub(" ", text.lower()).strip()


def sample_of(text, seed, size=PIECE_BYTES):
    """At most ``size`` bytes of the letters of a whole text: runs from all over it, in an order by chance."""
    letters = letters_only(text)
    starts = list(range(0, len(letters), RUN_CHARACTERS))
    random.Random(seed).shuffle(starts)
    runs, left = [], size
    for start in starts:
        runs.append(letters[start:start + RUN_CHARACTERS].strip().encode()[:left])
        left -= len(runs[-1]) + 1
        if left <= 0:
            break
    return b" ".join(runs)


def _samples(piece_bytes):
    def run(batches):
        for batch in batches:
            texts, seeds = batch.column(2), batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(
                [sample_of(value.as_py(), seed, piece_bytes) for value, seed in zip(texts, seeds)], pa.binary())], ["lang", "h", "piece"])
    return run


def shared_out(pieces, total):
    """The pieces, cut such that they fill ``total`` bytes: all have the same bytes but for shorter ones."""
    cut, left = list(pieces), total
    order = sorted(range(len(cut)), key=lambda i: len(cut[i]))
    for done, i in enumerate(order):
        cut[i] = cut[i][:max(0, left // (len(cut) - done) - 1)]
        left -= len(cut[i]) + 1
    return b" ".join(p for p in cut if p)


def learn_dictionaries(training, text="text", lang="lang", key="doc_id", per_language=DOCUMENTS_PER_LANGUAGE,
                       dictionary_bytes=DICTIONARY_BYTES, piece_bytes=PIECE_BYTES, max_languages=MAX_LANGUAGES):
    """{language: bytes}: raw-content dictionaries from a bounded sample of labelled rows.

    The sample is the ``per_language`` ids of each language with the smallest hash, one row for each,
    so reruns agree. Ids are chosen first; texts are read for chosen ids only. Of each, ``piece_bytes``
    from all over the text leave a task, and all of them share the dictionary. Many languages have fewer documents and
    smaller dictionaries each, so that together they stay within ``SAMPLE_DOCUMENTS`` and ``ALL_DICTIONARIES``;
    of more than ``max_languages`` the most frequent are learned. Rows without language, text or key teach nothing.
    """
    rows = training.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(lang).alias("lang"), F.xxhash64(F.col(key)).alias("h"), F.col(text).alias("text"))
    names = rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("key").alias("ids")).orderBy(
        F.desc("n"), "lang").limit(max_languages).select("lang", "ids").collect()
    each = max(1, min(per_language, SAMPLE_DOCUMENTS // max(1, len(names))))
    dictionary_bytes = min(dictionary_bytes, ALL_DICTIONARIES // max(1, len(names)))
    # So few rows of a language are ranked that one task can do it, however many it has: those whose hash is
    # below a share of all hashes that leaves about SPARE times as many ids as are wanted.
    shares = training.sparkSession.createDataFrame(
        [(r.lang, min(1.0, SPARE * each / max(1, r.ids))) for r in names], "lang string, share double")
    place = F.pmod("h", F.lit(1 << 31))
    few = rows.select("key", "lang", "h").join(F.broadcast(shares), "lang").where(place < F.col("share") * (1 << 31)).select(
        "key", "lang", place.alias("h")).distinct()
    chosen = few.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "key"))).where(F.col("n") <= each)
    table = training.sparkSession.createDataFrame(chosen.select("lang", "key").collect(), rows.select("lang", "key").schema)
    texts = rows.join(F.broadcast(table), ["lang", "key"]).select("lang", "h", "text")
    pieces = texts.mapInArrow(_samples(piece_bytes), "lang string, h bigint, piece binary").groupBy("lang", "h").agg(
        F.min("piece").alias("piece"))
    found = {}
    for r in sorted(pieces.collect(), key=lambda r: (r.lang, r.h, bytes(r.piece))):
        found.setdefault(r.lang, []).append(bytes(r.piece))
    return {name: shared_out(parts, dictionary_bytes) for name, parts in found.items() if any(parts)}


def _compressors(dictionaries):
    made = {}
    for name in sorted(dictionaries):
        content = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=LEVEL)
        made[name] = zstandard.ZstdCompressor(dict_data=content, level=LEVEL, write_content_size=False,
                                              write_checksum=False, write_dict_id=False)
    return made


def encoded_sizes(text, compressors):
    """Bytes of the whole text under each dictionary; a long text is encoded block by block."""
    data = letters_only(text).encode()
    blocks = [data[i:i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
    return {name: sum(len(c.compress(b)) for b in blocks) for name, c in compressors.items()}


def decide(sizes):
    """(language, score, rejected) from encoded sizes; equal sizes go to the first name in order."""
    order = sorted(sizes, key=lambda name: (sizes[name], name))
    best = sizes[order[0]]
    score = 1 / sum(math.exp(max(-50.0, (best - sizes[name]) / 4)) for name in order)
    narrow = len(order) > 1 and sizes[order[1]] - best < MARGIN * best
    return order[0], score, narrow


def identify_languages(docs, dictionaries, keep=("doc_id",), text="text"):
    """``keep`` columns with lang_pred, score (0 to 1) and rejected, one row per input row.

    The text is encoded whole with each dictionary and the smallest wins. ``rejected`` says that the
    runner-up is within ``MARGIN`` of the winner, or that there was nothing to decide: a null text or
    one without a letter is ``und`` with score 0. The dictionaries are bounded by their parameters.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(dictionaries)
    schema = result_schema(docs, keep, "lang_pred string, score double, rejected boolean")

    def run(batches):
        compressors = _compressors(shared.value)
        for batch in batches:
            found = []
            for value in batch.column(batch.num_columns - 1):
                value = value.as_py()
                if value is None or not compressors or not any(map(str.isalpha, value)):
                    found.append((UNKNOWN, 0.0, True))
                else:
                    found.append(decide(encoded_sizes(value, compressors)))
            columns = [batch.column(i) for i in range(len(keep))]
            for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_())):
                columns.append(pa.array([f[i] for f in found], kind))
            yield pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score", "rejected"])

    return with_text(docs, keep, text).mapInArrow(run, schema)
