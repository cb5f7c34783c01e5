"""Hard negatives by inner product: cover trees over norm-augmented vectors, searched best first.

A vector x becomes (x, sqrt(M^2 - |x|^2)), M the largest norm, so that all candidates lie on one sphere
and the inner product with an anchor is a matter of the angle to (anchor, 0) alone. A node of the tree has
a centre and a covering radius, so the inner products of all vectors below it lie in an interval. The
search takes the node with the largest upper end next, skips nodes whose interval meets no window that
still can change, and works out the whole-number inner products of the leaves it reaches.

1. Rows with equal vector and label are one class with its smallest ids, all that any answer can show.
2. Centres that are far apart are picked from a bounded sample: the upper level. Every class goes to its
   nearest centre; the covering radius of a centre is measured over all of them.
3. Classes are dealt out in blocks of bounded size, of one label (for positives) or of one centre (for
   negatives). Each block is a cover tree in a task, and the anchors stream past it.
4. An anchor visits a first block, which bounds its windows, and then the blocks whose interval meets them.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

from scriptorium.session import cut_lineage

BLOCK_ROWS = 4096
# Centres of the upper level come from so many classes; a leaf is not divided further from so many on.
SAMPLE_ROWS = 4096
MAX_LEAVES = 1024
LEAF_ROWS = 32
MAX_TASKS = 20_000
BASE = 1.5
# A level that needs a centre for every so many rows, or more than so many, divides nothing: its rows are verified together.
ROWS_PER_CENTRE, MOST_CENTRES = 4, 256
SALTS = 64
_SLACK = 1e-9
# Distances are worked out from products, which costs half of their digits.
_ROUND = 1e-7


def exact_products(matrix, vector, peak):
    """Inner products of whole numbers of at most ``peak``, exactly; beyond 64 bits they stay at the end of the range."""
    if peak * float(np.abs(vector).max(initial=0)) * len(vector) < 2 ** 53:
        return (matrix @ vector).astype(np.int64)
    whole = [sum(int(a) * int(b) for a, b in zip(row, vector)) for row in matrix]
    return np.array([min(max(x, -2 ** 63), 2 ** 63 - 1) for x in whole], np.int64)


def augmented(matrix, largest):
    """The vectors with one more component, which gives all of them the norm ``largest``."""
    rest = np.sqrt(np.maximum(largest ** 2 - np.einsum("ij,ij->i", matrix, matrix), 0))
    return np.column_stack((matrix, rest))


def far_apart(points, most, radius=0.0):
    """Rows of a sphere that cover all others within ``radius``, each the farthest from those before, at most ``most``.

    Returns the rows, the number of the nearest one for every point and the distance to it, rounded up.
    """
    square = float(points[0] @ points[0])
    chosen, nearest, close = [0], np.zeros(len(points), np.int64), points @ points[0]
    away = lambda product: math.sqrt(max(0.0, 2 * (square - product))) + _ROUND * math.sqrt(square)
    while len(chosen) < most and away(float(close.min())) > radius:
        chosen.append(int(close.argmin()))
        new = points @ points[chosen[-1]]
        nearest[new > close] = len(chosen) - 1
        close = np.maximum(close, new)
    return np.array(chosen), nearest, np.sqrt(np.maximum(2 * (square - close), 0)) + _ROUND * math.sqrt(square)


def interval(products, norm, radius, largest):
    """Least and largest inner product with the points of a sphere within ``radius`` of centres."""
    size = max(norm * largest, 1e-300)
    at = np.arccos(np.clip(products / size, -1, 1))
    turn = 2 * np.arcsin(np.clip(np.asarray(radius) / (2 * max(largest, 1e-300)), 0, 1))
    slack = _SLACK * size + 1e-6
    return size * np.cos(np.minimum(at + turn, math.pi)) - slack, size * np.cos(np.maximum(at - turn, 0)) + slack


class CoverTree:
    """A block of vectors: nested centres with covering radii that shrink from level to level.

    ``rows`` are the vectors in the order of the leaves, so that a leaf is a slice of ``matrix``.
    """

    def __init__(self, matrix, largest, leaf_rows=LEAF_ROWS):
        self.largest, self.leaf_rows, self.verified = largest, leaf_rows, 0
        self.points, self.leaves, self.filled = augmented(matrix, largest), [], 0
        self.root = self._node(np.arange(len(matrix)), 2 * largest)
        self.rows = np.concatenate(self.leaves)
        self.matrix, self.peak = np.ascontiguousarray(matrix[self.rows]), float(np.abs(matrix).max(initial=0))
        del self.points, self.leaves

    def _leaf(self, rows):
        self.leaves.append(rows)
        self.filled += len(rows)
        return slice(self.filled - len(rows), self.filled)

    def _node(self, rows, reach):
        """A slice of rows, or (centres, radii, children)."""
        if len(rows) <= self.leaf_rows:
            return self._leaf(rows)
        points = self.points[rows]
        # Levels at which the node would have a single child are passed over.
        reach = min(reach, float(far_apart(points, 1)[2].max()))
        if reach <= 4 * _ROUND * self.largest:
            return self._leaf(rows)
        chosen, nearest, away = far_apart(points, max(2, min(MOST_CENTRES, len(rows) // ROWS_PER_CENTRE)), reach / BASE)
        if away.max() > reach / BASE:
            return self._leaf(rows)
        groups = [nearest == i for i in range(len(chosen))]
        return (points[chosen], np.array([away[g].max() for g in groups]),
                [self._node(rows[g], reach / BASE) for g in groups])

    def search(self, query, norm, windows, allowed, order, k):
        """Per window (low, high) the first ``k`` allowed rows, by product, then by ``order``.

        Returns arrays (places in ``rows``, products) per window. ``windows`` bound the products from both
        sides; ``allowed`` and ``order`` follow ``rows``.
        """
        low, high = (np.array([w[i] for w in windows], float) for i in (0, 1))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows]
        flat = np.append(query, 0.0)
        heap, count = [(-math.inf, 0, self.root, -math.inf, math.inf)], 1
        while heap:
            _, _, node, least, most = heapq.heappop(heap)
            if not ((most >= low) & (least <= high)).any():
                continue
            if isinstance(node, tuple):
                centres, radii, children = node
                ends = interval(centres @ flat, norm, radii, self.largest)
                meets = ((ends[1][:, None] >= low) & (ends[0][:, None] <= high)).any(axis=1)
                for i in np.flatnonzero(meets):
                    heapq.heappush(heap, (-ends[1][i], count, children[i], ends[0][i], ends[1][i]))
                    count += 1
                continue
            self.verified += node.stop - node.start
            products = exact_products(self.matrix[node], query, self.peak)
            # What no window can take is left out at once, then each window looks at the rest.
            some = np.flatnonzero(allowed[node] & (products >= low.min()) & (products <= high.max()))
            products, some = products[some], some + node.start
            for w in range(len(windows)):
                hit = np.flatnonzero((products >= low[w]) & (products <= high[w]))
                if len(hit) == 0:
                    continue
                if len(hit) > 4 * k:
                    # Those below the k-th product cannot stand among the first k.
                    kth = np.partition(products[hit], len(hit) - k)[len(hit) - k]
                    hit = hit[products[hit] >= kth]
                rows = np.concatenate((found[w][0], some[hit]))
                values = np.concatenate((found[w][1], products[hit]))
                first = np.lexsort((order[rows], -values))[:k]
                found[w] = rows[first], values[first]
                if len(first) == k:
                    low[w] = max(low[w], values[first[-1]])
        return found


def _numbers(column, dimension):
    return np.asarray(column.flatten(), np.float64).reshape(-1, dimension)


def _assign(centres, largest, dimension):
    """The nearest centre of every vector, and the distance to it."""
    def run(batches):
        for batch in batches:
            points = augmented(_numbers(batch.column(batch.schema.get_field_index("vector")), dimension), largest)
            leaf, away = np.zeros(len(points), np.int32), np.zeros(len(points))
            for start in range(0, len(points), 1024):
                part = points[start:start + 1024]
                leaf[start:start + 1024] = (part @ centres.T).argmax(axis=1)
                away[start:start + 1024] = np.linalg.norm(part - centres[leaf[start:start + 1024]], axis=1) + _ROUND * largest
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf), pa.array(away)],
                                             [*batch.schema.names, "leaf", "away"])
    return run


_CELL = ("cell", "leaf", "block")
_FOUND = "anchor_id bigint, anchor_hash bigint, slot int, class_id bigint, class_hash bigint, score bigint"


def _search(dimension, largest, same_label, k):
    """Rows sorted by cell, vectors before anchors: each cell becomes a tree and its anchors stream past it."""
    def run(batches):
        cell, stock, tree = None, [], None

        def built(stock):
            block = CoverTree(np.concatenate([s[3] for s in stock]), largest)
            return block, *(np.concatenate([s[i] for s in stock])[block.rows] for i in (0, 1, 2))

        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            names = list(zip(*(column[c].to_pylist() for c in _CELL)))
            kinds = column["kind"].to_numpy(zero_copy_only=False)
            ids, hashes = column["id"].to_numpy(zero_copy_only=False), column["hash"].to_numpy(zero_copy_only=False)
            labels = np.array(column["label"].to_pylist(), object)
            vectors, windows = _numbers(column["vector"], dimension), column["windows"].to_pylist()
            out = [[] for _ in range(6)]
            start = 0
            while start < len(names):
                end = start
                while end < len(names) and names[end] == names[start] and kinds[end] == kinds[start]:
                    end += 1
                if names[start] != cell:
                    cell, stock, tree = names[start], [], None
                if kinds[start] == 0:
                    stock.append((ids[start:end], hashes[start:end], labels[start:end], vectors[start:end]))
                elif stock:
                    if tree is None:
                        tree = built(stock)
                        stock = [tree[1:2]]
                    blocks, class_ids, class_hashes, class_labels = tree
                    allowed = {}
                    for q in range(start, end):
                        if labels[q] not in allowed:
                            allowed = {labels[q]: (class_labels == labels[q]) == same_label}
                        found = blocks.search(vectors[q], float(np.linalg.norm(vectors[q])),
                                              [(w["low"], w["high"]) for w in windows[q]], allowed[labels[q]], class_ids, k)
                        for w, (rows, products) in zip(windows[q], found):
                            for target, value in zip(out, (ids[q], hashes[q], w["slot"], class_ids[rows], class_hashes[rows], products)):
                                target.append(value if isinstance(value, np.ndarray) else np.full(len(rows), value, np.int64))
                start = end
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int32() if i == 2 else pa.int64()) for i, x in enumerate(flat)],
                ["anchor_id", "anchor_hash", "slot", "class_id", "class_hash", "score"])
    return run


def _visits(leaves, largest, dimension):
    """The leaves whose interval meets a window of the anchor."""
    def run(batches):
        leaf, centres, radii = leaves.value
        for batch in batches:
            vectors = _numbers(batch.column(batch.schema.get_field_index("vector")), dimension)
            windows = batch.column(batch.schema.get_field_index("windows")).to_pylist()
            met = []
            for vector, wanted in zip(vectors, windows):
                least, most = interval(centres @ np.append(vector, 0.0), float(np.linalg.norm(vector)), radii, largest)
                meets = np.zeros(len(leaf), bool)
                for w in wanted:
                    meets |= (most >= w["low"]) & (least <= w["high"])
                met.append(leaf[meets].tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(met, pa.list_(pa.int32()))],
                                             [*batch.schema.names, "leaves"])
    return run


_WINDOWS = "array<struct<slot:int,low:double,high:double>>"


def _first(found, k, *by):
    """The first ``k`` of every anchor and slot."""
    order = Window.partitionBy("anchor_id", "anchor_hash", *by).orderBy(F.desc("score"), "class_id", "class_hash")
    return found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k)


class _Rounds:
    """Searches over classes that are dealt out in cells (cell, leaf, block)."""

    def __init__(self, dimension, largest, leaves, tasks):
        self.dimension, self.largest, self.leaves, self.tasks = dimension, largest, leaves, tasks

    def once(self, stock, asked, same_label, k):
        none = F.lit(None).cast(_WINDOWS).alias("windows")
        rows = stock.select(*_CELL, F.lit(0).alias("kind"), "id", "hash", "label", "vector", none).unionAll(
            asked.select(*_CELL, F.lit(1).alias("kind"), "id", "hash", "label", "vector", "windows"))
        # The number is given, for searching takes far longer than the size of the rows tells.
        return rows.repartition(self.tasks, *_CELL).sortWithinPartitions(*_CELL, "kind", "label").mapInArrow(
            _search(self.dimension, self.largest, same_label, k), _FOUND)

    def all(self, stock, cells, anchors, same_label, k, label):
        """Answers of all cells: those of a first cell of every anchor narrow its windows for the others.

        ``cells(cell, leaf, blocks)`` has the number of blocks; ``leaf`` is -1 where all of a cell's
        classes are in one block. ``anchors`` have cell, home (a leaf) and windows.
        """
        where = F.when(F.col("blocks") > 0, F.pmod(F.xxhash64("id", "hash"), F.greatest("blocks", F.lit(1)))).otherwise(0)
        here = anchors.withColumn("leaf", F.explode(F.array("home", F.lit(-1)))).join(cells, ["cell", "leaf"]).select(
            "cell", "leaf", where.cast("int").alias("block"), "id", "hash", "label", "vector", "windows")
        first = cut_lineage(_first(self.once(stock, here, same_label, k), k, "slot"), "first")
        least = first.groupBy("anchor_id", "anchor_hash", "slot").agg(
            F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") >= k).groupBy(
            F.col("anchor_id").alias("id"), F.col("anchor_hash").alias("hash")).agg(
            F.map_from_entries(F.collect_list(F.struct("slot", "least"))).alias("least"))
        narrowed = F.transform("windows", lambda w: F.struct(
            w["slot"].alias("slot"), F.greatest(w["low"], F.try_element_at("least", w["slot"]).cast("double")).alias("low"),
            w["high"].alias("high")))
        rest = anchors.join(least, ["id", "hash"], "left").withColumn("windows", narrowed).drop("least")
        rest = rest.mapInArrow(_visits(self.leaves, self.largest, self.dimension),
                               f"id bigint, hash bigint, label string, vector array<bigint>, windows {_WINDOWS}, "
                               f"cell {label}, home int, leaves array<int>")
        others = rest.select("*", F.explode("leaves").alias("_leaf")).join(
            cells.withColumnsRenamed({"cell": "_cell", "leaf": "_at"}),
            (F.col("cell") == F.col("_cell")) & (F.col("_leaf") == F.col("_at"))).select(
            "cell", F.col("_at").alias("leaf"), "home", "id", "hash", "label", "vector", "windows", where.cast("int").alias("_own"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).where(
            (F.col("leaf") != F.col("home")) | (F.col("block") != F.col("_own")))
        return _first(first.drop("_r").unionByName(self.once(stock, others, same_label, k)), k, "slot").drop("_r")


def classes_of(vectors, is_anchor, key, label, vector, scale, keep):
    """(rows, classes): the rows that take part, and one row per vector and label with its smallest ids."""
    values = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("bigint").alias("vec_id"), F.col(label).cast("string").alias("label"),
                          values.alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)))
    rows = rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x * F.lit(float(scale))).cast("bigint")))
    rows = cut_lineage(rows.withColumn("hash", F.xxhash64("vector", "label")), "vectors")
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = rows.where(F.size("vector") == (sizes.n if sizes else 1))
    # A vector that very many rows share is cut to its smallest ids in two steps.
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).alias("_salt")
    some = rows.select("vec_id", "label", "vector", "hash").distinct().select("*", salt)
    for group in (("label", "vector", "_salt"), ("label", "vector")):
        some = some.withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy("vec_id"))).where(
            F.col("_r") <= keep).drop("_r")
    classes = some.groupBy("label", "vector", "hash").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("id"), "hash", "label", "vector", "ids")
    return rows, cut_lineage(classes, "classes"), sizes.n if sizes else 1


def hard_negatives(vectors, is_anchor, positives=5, negatives=3, window=(50, 95), scale=256, key="vec_id", label="label",
                   vector="embedding", block_rows=BLOCK_ROWS, sample_rows=SAMPLE_ROWS):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components count as floor(scale * x), and a score is the inner product of these whole numbers. The
    positives of an anchor (a row for which ``is_anchor`` holds) are the ``positives`` rows of its label,
    other than its own id, with the highest scores. For each of them the ``negatives`` highest rows of
    another label count whose score is between ``window`` per cent of the positive's; ties go to the
    smaller id. The answer is exact.

    Rows with a null id, label or vector, with an empty vector, a null or non-finite component, or of another
    length than the most frequent one take no part. A repeated row counts once; ids that name several
    vectors are rows of their own. Other columns are ignored. Where all scores of a label are negative its window is empty.
    """
    spark = vectors.sparkSession
    rows, classes, dimension = classes_of(vectors, is_anchor, key, label, vector, scale, max(positives + 1, negatives))
    largest = classes.agg(F.count("*").alias("n"), F.sqrt(F.max(F.aggregate(
        "vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))).alias("norm")).first()
    norm = (largest.norm or 0.0) * (1 + 1e-12) + 1e-6
    # The upper level: centres of a bounded sample, and the covering radius of each over all classes.
    sample = classes.orderBy(F.xxhash64("id", "hash"), "id", "hash").limit(sample_rows).select("vector").collect()
    points = augmented(np.array([r.vector for r in sample], float).reshape(-1, dimension), norm)
    wanted = min(MAX_LEAVES, len(points), -(-largest.n // block_rows))
    centres = points[far_apart(points, wanted)[0]] if len(points) else np.zeros((1, dimension + 1))
    kind = classes.schema["vector"].dataType.simpleString()
    placed = cut_lineage(classes.select("id", "hash", "label", "vector").mapInArrow(
        _assign(centres, norm, dimension), f"id bigint, hash bigint, label string, vector {kind}, leaf int, away double"), "placed")
    blocks = F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")
    leaves = cut_lineage(placed.groupBy("leaf").agg(F.max("away").alias("away"), blocks), "leaves")
    # One row per centre: at most MAX_LEAVES.
    at = {r.leaf: r.away for r in leaves.collect()}
    balls = spark.sparkContext.broadcast((np.array(sorted(at), np.int32), centres[sorted(at)],
                                          np.array([at[leaf] for leaf in sorted(at)])))
    rounds = _Rounds(dimension, norm, balls, min(MAX_TASKS, max(8, 4 * (largest.n // block_rows + 1))))
    of_block = F.pmod(F.xxhash64("id", "hash"), "blocks").cast("int").alias("block")
    asked = rows.where("is_anchor").select(F.col("vec_id").alias("anchor_id"), F.col("hash"), "label", "vector").distinct()
    # The class of an anchor says at which centre it stands; its row id names the anchor.
    home = placed.select(F.col("hash"), "label", "vector", F.col("leaf").alias("home"))
    asked = cut_lineage(asked.join(home, ["hash", "label", "vector"]).select(
        F.col("anchor_id").alias("id"), "hash", "label", "vector", "home"), "anchors")
    # Positives: cells of one label, by centre only where a label has more than one block.
    by_label = placed.groupBy("label").agg(F.count("*").alias("n"))
    small = by_label.where(F.col("n") <= block_rows).select("label", F.lit(True).alias("small"))
    mine = cut_lineage(placed.join(small, "label", "left").select(
        "id", "hash", "label", "vector", F.when(F.col("small"), -1).otherwise(F.col("leaf")).alias("leaf")), "by_label")
    cells = cut_lineage(mine.groupBy(F.col("label").alias("cell"), "leaf").agg(blocks), "cells")
    stock = mine.withColumn("cell", F.col("label")).join(cells, ["cell", "leaf"]).select(
        "cell", "leaf", of_block, "id", "hash", "label", "vector")
    everything = F.array(F.struct(F.lit(0).alias("slot"), F.lit(-math.inf).alias("low"), F.lit(math.inf).alias("high")))
    anchors = asked.select("id", "hash", "label", "vector", everything.alias("windows"), F.col("label").alias("cell"), "home")
    near = rounds.all(stock, cells, anchors, True, positives + 1, "string")
    named = classes.select(F.col("id").alias("class_id"), F.col("hash").alias("class_hash"), "ids")
    listed = near.join(named, ["class_id", "class_hash"]).select(
        "anchor_id", "anchor_hash", "score", F.explode("ids").alias("vec_id")).where("vec_id <> anchor_id")
    best = Window.partitionBy("anchor_id", "anchor_hash").orderBy(F.desc("score"), "vec_id")
    positive = cut_lineage(listed.withColumn("slot", F.row_number().over(best)).where(F.col("slot") <= positives).select(
        "anchor_id", "anchor_hash", "slot", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # Negatives: cells of one centre, and one window for each positive.
    cells = leaves.select(F.lit(0).alias("cell"), "leaf", "blocks")
    stock = placed.join(F.broadcast(leaves.select("leaf", "blocks")), "leaf").select(
        F.lit(0).alias("cell"), "leaf", of_block, "id", "hash", "label", "vector")
    share = F.col("positive_score").cast("decimal(20,0)")
    low, high = F.ceil(share * window[0] / 100), F.floor(share * window[1] / 100)
    windows = positive.where("positive_score >= 0").groupBy(F.col("anchor_id").alias("id"), F.col("anchor_hash").alias("hash")).agg(
        F.array_sort(F.collect_list(F.struct("slot", low.cast("double").alias("low"), high.cast("double").alias("high")))).alias("windows"))
    anchors = asked.join(windows, ["id", "hash"]).select("id", "hash", "label", "vector", "windows", F.lit(0).alias("cell"), "home")
    far = rounds.all(stock, cells, anchors, False, negatives, "int")
    listed = far.join(named, ["class_id", "class_hash"]).select(
        "anchor_id", "anchor_hash", "slot", F.col("score").alias("negative_score"), F.explode("ids").alias("negative_id"))
    last = Window.partitionBy("anchor_id", "anchor_hash", "slot").orderBy(F.desc("negative_score"), "negative_id")
    return listed.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= negatives).join(
        positive, ["anchor_id", "anchor_hash", "slot"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
