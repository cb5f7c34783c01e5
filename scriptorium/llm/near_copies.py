"""Join of documents on the Jaccard similarity of their five-word shingles, by MinHash LSH.

1. Each text becomes a key of its word sequence and, per tree, a label of MinHash values. Texts with
   equal words are one text with a number of copies from here on.
2. Texts that share a label prefix stand under one node of that tree. All prefixes have one depth, which
   follows from the parameters before any data are read: the longest at which a pair at the threshold
   shares one in some tree with the target recall. This is banding, not a forest that is descended, so
   a text that found little is not tried again with shorter prefixes; one equi-join finds the nodes.
   Every text is linked to the least text of its node, never to all of them.
3. Connected texts are candidates for each other. They are verified on their exact shingle sets, block
   against block: a large group is many blocks, each pair is compared once, and only counts and the
   links of a spanning forest leave a task.
4. The connected components of verified links are the classes.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from scriptorium.llm.components import components
from scriptorium.llm.rows import same_row, with_identity
from scriptorium.llm.words import chunks, mix, ngram_hashes, powers, signed
from scriptorium.session import cut_lineage

SHINGLE = 5
THRESHOLD = 0.8
TREES, DEPTH = 16, 6
RECALL = 0.998
BLOCK_TEXTS = 1024
_COLUMNS = 4096  # of a block's shingle matrix that are multiplied at once
_KEY_BASE = 0xA0761D6478BD642F


def prefix_depth(threshold=THRESHOLD, trees=TREES, depth=DEPTH, recall=RECALL):
    """The longest prefix at which a pair at the threshold still meets with the target recall."""
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < recall:
        depth -= 1
    return depth


def shingles_of(hashes, firsts, size=SHINGLE):
    """Shingle hashes of consecutive texts and the first shingle of each text.

    A text of fewer words, but not none, has all of its words as its one shingle.
    """
    counts = np.diff(firsts)
    if len(hashes) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(firsts), np.int64)
    grams = ngram_hashes(hashes, size)
    text = np.repeat(np.arange(len(counts)), counts)
    whole = text[:len(grams)] == text[size - 1:] if len(grams) else np.zeros(0, bool)
    values, owner = [grams[whole]], [text[:len(grams)][whole]]
    for n in range(1, size):
        rows = np.flatnonzero(counts == n)
        if len(rows):
            values.append(ngram_hashes(hashes, n)[firsts[rows]])
            owner.append(rows)
    values, owner = np.concatenate(values), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return values[order], np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(counts)))))


def text_keys(hashes, firsts):
    """A 64-bit key of the word sequence of each text; 0 for a text without words."""
    counts = np.diff(firsts)
    keys, full = np.zeros(len(counts), np.uint64), np.flatnonzero(counts)
    if len(full):
        place = np.arange(len(hashes)) - np.repeat(firsts[:-1], counts)
        terms = hashes * powers(_KEY_BASE, int(counts.max()))[place]
        keys[full] = mix(np.add.reduceat(terms, firsts[full]) + counts[full].astype(np.uint64))
        keys[full] |= np.uint64(1)
    return keys


def _minima(values, firsts, n):
    """``n`` MinHash values of every text that has shingles; one array per text, in rows."""
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
    full = np.flatnonzero(np.diff(firsts))
    out = np.zeros((len(full), n), np.uint64)
    for i in range(n):
        out[:, i] = np.minimum.reduceat((values ^ seeds[2 * i]) * (seeds[2 * i + 1] | np.uint64(1)), firsts[full])
    return full, out


def _labels(trees, depth, used):
    """Key and trie node of every text: nodes are hashes of the tree and a label prefix."""
    def run(batches):
        for batch in batches:
            keys, nodes, lengths = [], [], []
            for _, _, _, _, _, _, hashes, firsts in chunks(batch.column(2)):
                values, first = shingles_of(hashes, firsts)
                keys.append(text_keys(hashes, firsts))
                full, minima = _minima(values, first, trees * depth) if len(values) else (np.zeros(0, int), None)
                lengths.append(np.where(np.diff(firsts) > 0, trees, 0))
                if len(full):
                    tries = minima.reshape(len(full), trees, depth)
                    node = mix(np.arange(trees, dtype=np.uint64) + np.uint64(_KEY_BASE)) + np.zeros((len(full), 1), np.uint64)
                    for d in range(used):
                        node = mix(node * np.uint64(0x9E3779B97F4A7C15) + tries[:, :, d])
                    nodes.append(node.reshape(-1))
            join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            keys, offsets = join(keys), np.concatenate(([0], np.cumsum(np.concatenate(lengths)) if lengths else []))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(signed(keys), pa.int64(), mask=keys == 0),
                 pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(signed(join(nodes)), pa.int64()))],
                ["doc_id", "_h", "text_key", "nodes"])
    return run


def linked(sets_a, sets_b, threshold=THRESHOLD):
    """Which texts of one list are linked with which of another, from their exact shingle sets.

    Whole numbers decide, so a similarity of exactly the threshold as it is written counts as linked.
    """
    ratio = Fraction(str(threshold))
    sizes_a, sizes_b = (np.array([len(s) for s in sets], np.int64) for sets in (sets_a, sets_b))
    values, column = np.unique(np.concatenate([*sets_a, *sets_b]), return_inverse=True)
    row = np.repeat(np.arange(len(sets_a) + len(sets_b)), np.concatenate((sizes_a, sizes_b)))
    shared = np.bincount(column, minlength=len(values)) > 1
    keep = shared[column]
    column, row = (np.cumsum(shared) - 1)[column[keep]], row[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    common = np.zeros((len(sets_a), len(sets_b)), np.int64)
    for start in range(0, int(shared.sum()), _COLUMNS):
        a, b = np.searchsorted(column, (start, start + _COLUMNS))
        matrix = np.zeros((len(sets_a) + len(sets_b), min(_COLUMNS, int(shared.sum()) - start)), np.float32)
        matrix[row[a:b], column[a:b] - start] = 1
        common += (matrix[:len(sets_a)] @ matrix[len(sets_a):].T).astype(np.int64)
    return ratio.denominator * common >= ratio.numerator * (sizes_a[:, None] + sizes_b[None, :] - common)


def _forest(links, keys_a, keys_b):
    """(text, other text) links of a spanning forest: each text with the least text it reaches here."""
    none = np.iinfo(np.int64).max
    a, b = keys_a.copy(), keys_b.copy()
    while True:
        to_a = np.minimum(a, np.where(links, b[None, :], none).min(axis=1, initial=none))
        to_b = np.minimum(b, np.where(links, to_a[:, None], none).min(axis=0, initial=none))
        if (to_a == a).all() and (to_b == b).all():
            return [(int(k), int(r)) for k, r in zip([*keys_a, *keys_b], [*a, *b]) if k != r]
        a, b = to_a, to_b


def _compare(unit, threshold):
    """Counts and forest links of one unit: a block with itself, or two blocks."""
    blocks = {}
    for key, copies, block, shingles in unit:
        blocks.setdefault(block, {})[key] = (copies, shingles)
    lists = [(np.array(list(b), np.int64), np.array([c for c, _ in b.values()], np.int64), [s for _, s in b.values()])
             for _, b in sorted(blocks.items())]
    i, j = unit.pair
    if i != j and len(lists) < 2:
        return []
    keys_a, copies_a, sets_a = lists[0]
    keys_b, copies_b, sets_b = lists[-1]
    links = linked(sets_a, sets_b, threshold)
    if i == j:
        np.fill_diagonal(links, False)
    out = [(int(k), None, int(n)) for k, n in zip(keys_a, links @ copies_b) if n]
    if i != j:
        out += [(int(k), None, int(n)) for k, n in zip(keys_b, links.T @ copies_a) if n]
    return out + [(k, r, 0) for k, r in dict.fromkeys(_forest(links, keys_a, keys_b))]


class _Unit(list):
    pair = None


def _verify(threshold):
    """Rows sorted by unit, one unit at a time: (component, i, j, block, text_key, copies, text)."""
    def run(batches):
        current, unit, out = None, _Unit(), []

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)],
                                              ["text_key", "other", "links"])
        for batch in batches:
            fields = [batch.column(i).to_pylist() for i in range(6)]
            for lo, hi, _, _, _, _, hashes, firsts in chunks(batch.column(6)):
                values, first = shingles_of(hashes, firsts)
                keys = signed(text_keys(hashes, firsts))
                for row in range(lo, hi):
                    name = tuple(f[row] for f in fields[:3])
                    if name != current:
                        if len(unit) > 1:
                            out += _compare(unit, threshold)
                        current, unit = name, _Unit()
                        unit.pair = name[1:]
                    if keys[row - lo] == fields[4][row]:
                        unit.append((fields[4][row], fields[5][row], fields[3][row],
                                     np.unique(values[first[row - lo]:first[row - lo + 1]])))
            if len(out) > 10_000:
                yield table(out)
                out = []
        if len(unit) > 1:
            out += _compare(unit, threshold)
        yield table(out)
    return run


def near_copies(docs, key="doc_id", text="text", threshold=THRESHOLD, trees=TREES, depth=DEPTH, recall=RECALL,
                block_texts=BLOCK_TEXTS):
    """One row per document: doc_id, _h (hash of the text), class_id, n_links, n_copies, stays, has_words.

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles is at least
    ``threshold``; words are compared without case and punctuation. ``class_id`` is the least doc_id of
    the documents that links connect, ``n_links`` the number of documents linked with this one,
    ``n_copies`` the number of those, itself included, with the same words, and ``stays`` is true for
    one document of each class, the one with the least doc_id (null last). A null text, or one
    without a word, is linked with nothing and stays; a text of fewer than five words has one shingle;
    repeated rows are copies of each other; other columns are ignored. A null doc_id is a document.
    """
    rows = with_identity(docs, key, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    used = prefix_depth(threshold, trees, depth, recall)
    labelled = cut_lineage(rows.select("doc_id", "_h", "text").mapInArrow(
        _labels(trees, depth, used), f"doc_id {kind}, _h bigint, text_key bigint, nodes array<bigint>"), "labels")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_h")
    texts = cut_lineage(labelled.where("text_key is not null").groupBy("text_key").agg(
        F.min(order).alias("first"), F.count("*").alias("copies"), F.min("nodes").alias("nodes")), "texts")
    under = texts.select("text_key", F.explode("nodes").alias("node"))
    hubs = under.groupBy("node").agg(F.min("text_key").alias("hub"), F.count("*").alias("n")).where("n > 1")
    near = components(under.join(hubs, "node").select("text_key", "hub"), "text_key", "hub")
    near = cut_lineage(near.select(F.col("node").alias("text_key"), "component"), "candidates")
    blocks = near.groupBy("component").agg(F.ceil(F.count("*") / block_texts).cast("int").alias("blocks"))
    wanted = texts.join(near, "text_key").join(blocks, "component").select(
        "component", "text_key", "copies", F.col("first.doc_id").alias("doc_id"), F.col("first._h").alias("_h"),
        F.pmod(F.xxhash64("text_key"), "blocks").cast("int").alias("block"), "blocks")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    units = rows.join(wanted, same_row(rows, wanted)).select(
        "component", "text_key", "copies", "block", "text", other).select(
        "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "text_key", "copies", "text")
    verified = cut_lineage(units.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j").mapInArrow(
        _verify(threshold), "text_key bigint, other bigint, links bigint"), "links")
    links = verified.groupBy("text_key").agg(F.sum("links").alias("links"))
    classes = components(verified.where("other is not null"), "text_key", "other").select(
        F.col("node").alias("text_key"), F.col("component").alias("class"))
    named = texts.select("text_key", "first", "copies").join(links, "text_key", "left").join(classes, "text_key", "left").select(
        "text_key", "first", "copies", "links", F.coalesce("class", "text_key").alias("class"))
    named = cut_lineage(named, "classes")
    heads = named.groupBy("class").agg(F.min("first").alias("head"))
    named = named.join(heads, "class").drop("first", "class")
    none = F.lit(0).cast("bigint")
    return labelled.select("doc_id", "_h", "text_key").join(named, "text_key", "left").select(
        "doc_id", "_h",
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.col("copies") - 1, none).alias("n_links"),
        F.coalesce("copies", F.lit(1).cast("bigint")).alias("n_copies"), F.col("text_key").isNotNull().alias("has_words"),
        F.when(F.col("head").isNull(), True).otherwise(
            F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("_h") == F.col("head._h"))).alias("stays"))
