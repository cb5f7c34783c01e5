"""Quality classifier: neighbour voting over labelled latent-semantic vectors.

Terms are pairs of neighbouring character kinds, words hashed to a fixed number of slots, and how
words repeat. Term weights are learned from a bounded sample of labelled rows, and the leading singular
vectors of its term-document matrix span the latent space. The labelled vectors are broadcast; each
document meets all of them in exact blocked cosine products.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from scriptorium.llm.rows import result_schema, with_text
from scriptorium.llm.words import CHUNK_BYTES, chunks, column_bytes

SAMPLE_ROWS = 4096
DIMENSIONS = 32
NEIGHBOURS = 25
SHARPNESS = 8
# Terms that vary less than this are not scaled up any further.
_COMMON = 0.1
WORD_SLOTS = 1024
# Kinds of bytes: lower case, upper case, digits, beyond ASCII, other controls, then each ASCII sign by itself.
_KIND = np.full(256, 4, np.int16)
_SIGNS = [b for b in range(256) if b in (9, 10) or 32 <= b < 127 and not chr(b).isalnum()]
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 3
_KIND[_SIGNS] = np.arange(5, 5 + len(_SIGNS))
_KINDS = 5 + len(_SIGNS)
_PAIRS = _KINDS * _KINDS
_REPEATS = 4
TERMS = _PAIRS + WORD_SLOTS + _REPEATS


def _rates(slots, texts, width, n_texts):
    """Square roots of the shares that the slots have in each text; a long text is counted in parts."""
    counts = np.zeros(n_texts * width, np.int64)
    for at in range(0, len(slots), CHUNK_BYTES):
        part = slice(at, at + CHUNK_BYTES)
        counts += np.bincount(texts[part].astype(np.int64) * width + slots[part], minlength=n_texts * width)
    counts = counts.reshape(n_texts, width).astype(np.float32)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def term_rows(chunk):
    """Term weights before learning, one row per text of a chunk of texts."""
    _, _, data, bounds, _, _, hashes, firsts = chunk
    n = len(bounds) - 1
    text = np.repeat(np.arange(n, dtype=np.int32), np.diff(bounds))
    kinds = _KIND[data]
    inside = text[:-1] == text[1:]
    pairs = _rates((kinds[:-1] * np.int16(_KINDS) + kinds[1:])[inside], text[1:][inside], _PAIRS, n)
    owner, counts = np.repeat(np.arange(n), np.diff(firsts)), np.maximum(np.diff(firsts), 1)
    words = _rates((hashes % np.uint64(WORD_SLOTS)).astype(np.int64), owner, WORD_SLOTS, n)
    repeats = np.zeros((n, _REPEATS), np.float32)
    for i, gap in enumerate((1, 2, 4)):
        again = (hashes[gap:] == hashes[:-gap]) & (owner[gap:] == owner[:-gap])
        repeats[:, i] = np.sqrt(np.bincount(owner[gap:][again], minlength=n) / counts)
    order = np.lexsort((hashes, owner))
    same = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    repeats[:, 3] = np.bincount(owner[order][1:][same], minlength=n) / counts
    return np.concatenate((pairs, words, repeats), axis=1)


@dataclass(frozen=True)
class Model:
    """Term means and weights, the axes of the latent space, the labelled vectors and their labels."""

    mean: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float


def _unit(rows):
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _leading_axes(matrix, n):
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    axes = np.random.default_rng(0).standard_normal((matrix.shape[1], n + 8)).astype(np.float32)
    for _ in range(8):
        axes, _ = np.linalg.qr(matrix.T @ (matrix @ axes))
    _, _, turn = np.linalg.svd(matrix @ axes, full_matrices=False)
    return (axes @ turn.T)[:, :n].astype(np.float32)


def _terms_of(batches):
    for batch in batches:
        parts = [term_rows(chunk) for chunk in chunks(batch.column(1))]
        places = [np.flatnonzero(row).astype(np.uint16) for part in parts for row in part]
        weights = [row[at].tobytes() for row, at in zip((row for part in parts for row in part), places)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([at.tobytes() for at in places], pa.binary()), pa.array(weights, pa.binary()),
             batch.column(2), batch.column(3)], ["label", "places", "weights", "key", "h"])


def fit_quality(docs, labels, key="doc_id", text="text", label="quality", sample_rows=SAMPLE_ROWS, dimensions=DIMENSIONS):
    """A :class:`Model` from at most ``sample_rows`` labelled rows, those with the smallest hash of their id.

    ``docs`` are the documents to learn from. Labels other than 0 and 1, rows without id and documents
    without a label teach nothing; of an id with two labels the smaller counts, and of an id with
    several rows the one whose text has the smallest hash.
    """
    marked = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("key")).agg(
        F.min(label).cast("double").alias("label"))
    chosen = docs.select(F.col(key).alias("key")).distinct().join(marked, "key").orderBy(
        F.xxhash64("key"), "key").limit(sample_rows).collect()
    known = {r.key: r.label for r in chosen}
    spark = docs.sparkSession
    if not known:
        return Model(np.zeros(TERMS, np.float32), np.zeros((TERMS, 1), np.float32),
                     np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
    kind = docs.schema[key].dataType.simpleString()
    table = spark.createDataFrame(list(known.items()), f"key {kind}, label double")
    sample = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(
        F.broadcast(table), "key").select("label", "text", "key", F.xxhash64("text").alias("h"))
    # Only the terms that occur come to the driver, of one row per id; there is one dense matrix, changed in place.
    rows = sample.mapInArrow(_terms_of, f"label double, places binary, weights binary, key {kind}, h bigint").groupBy(
        "key").agg(F.min(F.struct("h", "label", "places", "weights")).alias("row")).select("row.*").collect()
    rows.sort(key=lambda r: (r.label, bytes(r.places), bytes(r.weights)))
    y, terms = np.array([r.label for r in rows]), np.zeros((len(rows), TERMS), np.float32)
    for row, r in zip(terms, rows):
        row[np.frombuffer(r.places, np.uint16)] = np.frombuffer(r.weights, np.float32)
    del rows
    mean = terms.mean(axis=0)
    terms -= mean
    scale = (1 / (np.sqrt(np.einsum("ij,ij->j", terms, terms) / len(terms)) + _COMMON)).astype(np.float32)
    terms *= scale
    axes = _leading_axes(terms, dimensions)
    return Model(mean, scale[:, None] * axes, _unit(terms @ axes).astype(np.float32), y, float(y.mean()))


def vote(model, terms, neighbours=NEIGHBOURS):
    """Similarity-weighted mean label of the nearest labelled vectors, for every row of terms."""
    if len(model.labels) == 0:
        return np.full(len(terms), model.prior)
    cosines = _unit((terms - model.mean) @ model.axes).astype(np.float32) @ model.vectors.T
    k = min(neighbours, len(model.labels))
    near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64) ** SHARPNESS
    # A little of the prior, so that a text that is like nothing has a score too.
    return ((weight * model.labels[near]).sum(axis=1) + 1e-6 * model.prior) / (weight.sum(axis=1) + 1e-6)


def score_quality(docs, model, keep=("doc_id",), text="text"):
    """The ``keep`` columns with score (0 to 1, higher: label 1 likelier) and predicted (1 from 0.5 on).

    Texts are scored whole; a null or empty text gets the share of label 1 in the sample. Repeated rows
    stay repeated. What is broadcast is bounded by the parameters of the model.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = result_schema(docs, keep, "score double, predicted int")

    def run(batches):
        for batch in batches:
            scores = [vote(shared.value, term_rows(chunk)) for chunk in chunks(batch.column(len(keep)))]
            scores = np.concatenate(scores) if scores else np.zeros(0)
            empty = np.diff(column_bytes(batch.column(len(keep)))[0]) == 0
            scores = np.clip(np.where(empty, shared.value.prior, scores), 0, 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                [*keep, "score", "predicted"])

    return with_text(docs, keep, text).mapInArrow(run, schema)

