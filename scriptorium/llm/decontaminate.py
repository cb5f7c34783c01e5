"""Benchmark decontamination by winnowing.

Of every ``WINDOW`` consecutive words the smallest of the hashes of its ``GRAM``-word runs is a
fingerprint, on both sides alike, so a shared span of ``WINDOW`` words always shares a fingerprint.
Documents whose fingerprints meet one of the benchmark are read again, their hits are extended to
whole windows, and these are joined with the windows of the items by their words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from scriptorium.llm.rows import same_row, with_identity
from scriptorium.llm.words import chunks, ngram_hashes, signed, words_of
from scriptorium.session import cut_lineage

WINDOW, GRAM = 10, 5
# Bits of the filter that spares most joins; its size does not depend on the benchmark.
FILTER_BITS = 1 << 22
_BUCKET_BITS = 32768  # of Spark's bitmap functions


def winnow(hashes, firsts):
    """Word positions of the fingerprints, and their hashes; texts are cut at ``firsts``."""
    grams, width = ngram_hashes(hashes, GRAM), WINDOW - GRAM + 1
    count = len(hashes) - WINDOW + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least, at = grams[:count].copy(), np.zeros(count, np.int64)
    for j in range(1, width):
        lower = grams[j:j + count] < least
        at[lower] = j
        least[lower] = grams[j:j + count][lower]
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    whole = text[:count] == text[WINDOW - 1:]
    places = np.unique((at + np.arange(count))[whole])
    return places, grams[places]


def _item_rows(batches):
    """The windows and fingerprints of benchmark items."""
    for batch in batches:
        ids, out = batch.column(0), []
        for lo, hi, data, _, starts, ends, hashes, firsts in chunks(batch.column(1)):
            for row in range(lo, hi):
                a, b = firsts[row - lo], firsts[row - lo + 1]
                n, item = int(b - a), ids[row].as_py()
                if n == 0 or item is None:
                    continue
                words, own, size = words_of(data, starts[a:b], ends[a:b]), hashes[a:b], min(n, WINDOW)
                out += [(item, size, None, " ".join(words[i:i + size])) for i in range(n - size + 1)]
                marks = winnow(own, np.array([0, n]))[1] if n >= WINDOW else ngram_hashes(own, n)
                out += [(item, size, h, None) for h in signed(marks).tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int64(), pa.string()))],
            ["item_id", "size", "mark", "window"])


def _candidates(bits, short):
    def run(batches):
        for batch in batches:
            n_words, offsets, sizes, places, marks = [], [0], [], [], []
            for lo, hi, _, _, _, _, hashes, firsts in chunks(batch.column(2)):
                found = []
                for size in (WINDOW, *short):
                    if size == WINDOW:
                        at, h = winnow(hashes, firsts)
                    else:
                        h = ngram_hashes(hashes, size)
                        at = np.flatnonzero(np.searchsorted(firsts, np.arange(len(h)), "right")
                                            == np.searchsorted(firsts, np.arange(len(h)) + size - 1, "right"))
                        h = h[at]
                    bit = h % np.uint64(FILTER_BITS)
                    hit = (bits.value[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    found.append((np.full(int(hit.sum()), size, np.int32), at[hit], h[hit]))
                size, at, h = (np.concatenate(x) for x in zip(*found))
                text = np.searchsorted(firsts, at, "right") - 1
                order = np.argsort(text, kind="stable")
                n_words.append(np.diff(firsts))
                sizes.append(size[order])
                places.append((at - firsts[text])[order].astype(np.int32))
                marks.append(signed(h[order]))
                offsets += (offsets[-1] + np.cumsum(np.bincount(text, minlength=hi - lo))).tolist()
            join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
            fields = pa.StructArray.from_arrays(
                [join(sizes, pa.int32()), join(places, pa.int32()), join(marks, pa.int64())], ["size", "place", "mark"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), join(n_words, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), fields)],
                ["doc_id", "_h", "n_words", "candidates"])
    return run


def _windows(batches):
    """The windows around hits, as words."""
    for batch in batches:
        out = []
        hits = batch.column(3)
        for lo, hi, data, _, starts, ends, _, firsts in chunks(batch.column(2)):
            for row in range(lo, hi):
                a, n = int(firsts[row - lo]), int(firsts[row - lo + 1] - firsts[row - lo])
                wanted = set()
                for hit in hits[row].as_py():
                    size, place = hit["size"], hit["place"]
                    first = place if size < WINDOW else place - (WINDOW - GRAM)
                    wanted.update((i, size) for i in range(max(0, first), min(place, n - size) + 1))
                if not wanted:
                    continue
                words = words_of(data, starts[a:a + n], ends[a:a + n])
                doc, h = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                out += [(doc, h, i, size, " ".join(words[i:i + size])) for i, size in sorted(wanted)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], t) for i, t in enumerate(
                (batch.schema.field(0).type, pa.int64(), pa.int32(), pa.int32(), pa.string()))],
            ["doc_id", "_h", "place", "size", "window"])


def _covered(spans):
    """Words inside any of the (place, size) spans, in order of place."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(state, span):
        end = span["place"] + span["size"]
        begin = F.greatest(span["place"], state["end"])
        return F.struct(F.greatest(end, state["end"]).alias("end"),
                        (state["n"] + F.greatest(F.lit(0), end - begin)).alias("n"))
    return F.aggregate(F.array_sort(spans), start, add)["n"].cast("bigint")


def decontaminate(docs, benchmark, key="doc_id", text="text", item="item_id", item_text="text"):
    """One row per document: doc_id, _h (hash of the text), n_words, n_hit, n_items, items, contaminated.

    A window is ``WINDOW`` consecutive words of an item; an item with fewer words, but not none, is one
    window. A document word inside any occurrence of a window is hit. ``items`` are the ids, as sorted
    strings, of the items with occurring windows. Null and empty texts have no words; items with a null
    id are ignored; repeated rows stay repeated; other columns are ignored.

    The documents are scanned once with a filter of fixed size in each task; only marks that pass it
    are joined. A passage that many items share has one item list, which is joined once per document.
    """
    spark = docs.sparkSession
    items = cut_lineage(benchmark.select(F.col(item).cast("string").alias("item_id"),
                                         F.col(item_text).alias("text")).mapInArrow(
        _item_rows, "item_id string, size int, mark bigint, window string"), "items")
    marks = items.where("mark is not null").select("size", "mark").distinct()
    # Windows of one passage have one list of items: it is kept once, under its digest.
    listed = cut_lineage(items.where("window is not null").groupBy("window").agg(
        F.array_sort(F.collect_set("item_id")).alias("items")).withColumn(
        "held_by", F.sha2(F.to_json("items"), 256)), "windows")
    windows, lists = listed.select("window", "held_by"), listed.select("held_by", "items").dropDuplicates(["held_by"])
    short = [r["size"] for r in marks.select("size").where(F.col("size") < WINDOW).distinct().collect()]
    bit = F.pmod(F.col("mark"), F.lit(FILTER_BITS))
    bitmap = marks.groupBy(F.floor(bit / _BUCKET_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(F.pmod(bit, F.lit(_BUCKET_BITS))).alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in bitmap:
        part = np.frombuffer(r.bits, np.uint8)
        bits[r.bucket * _BUCKET_BITS // 8:][:len(part)] = part
    rows = with_identity(docs, key, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    scanned = cut_lineage(rows.select("doc_id", "_h", "text").mapInArrow(
        _candidates(spark.sparkContext.broadcast(bits), sorted(short)),
        f"doc_id {kind}, _h bigint, n_words bigint, candidates array<struct<size:int,place:int,mark:bigint>>"), "marks")
    hits = cut_lineage(
        scanned.select("doc_id", "_h", F.explode("candidates").alias("c")).select("doc_id", "_h", "c.*")
        .join(marks, ["size", "mark"], "left_semi").groupBy("doc_id", "_h")
        .agg(F.collect_set(F.struct("size", "place")).alias("hits")), "hits")
    again = rows.dropna(subset=["text"]).join(hits, same_row(rows, hits)).select(
        rows["doc_id"], rows["_h"], "text", "hits")
    met = again.mapInArrow(_windows, f"doc_id {kind}, _h bigint, place int, size int, window string").join(windows, "window")
    hit = met.groupBy("doc_id", "_h").agg(
        _covered(F.collect_set(F.struct("place", "size"))).alias("n_hit"), F.collect_set("held_by").alias("held_by"))
    found = hit.select("doc_id", "_h", "n_hit", F.explode("held_by").alias("held_by")).join(lists, "held_by").groupBy(
        "doc_id", "_h").agg(F.max("n_hit").alias("n_hit"),
                            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    none = F.array().cast("array<string>")
    return scanned.join(found, same_row(scanned, found), "left").select(
        scanned["doc_id"], scanned["_h"], "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", none).alias("items")).select(
        "*", F.size("items").cast("bigint").alias("n_items"), (F.col("n_hit") > 0).alias("contaminated"))
