"""Approximate nearest neighbours by cosine: stable projections, a kd-tree and a chi-square test.

Vectors of unit length are projected on a few Gaussian directions. The squared distance of two
projections, over that of the vectors, follows a chi-square law with as many degrees of freedom. So
when the neighbours of a query are verified in the order of projected distance, the search may stop as
soon as a vector nearer than the k-th best found would be that far away with small probability only.
The projections are indexed by a kd-tree: its upper part deals the vectors out over tasks, each task
builds the lower part of its share.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window, functions as F

from scriptorium.session import cut_lineage

PROJECTIONS = 8
# Chance, for each true neighbour, that it stands within the radius at which the search stops.
CONFIDENCE = 0.99
# The upper tree is fitted to this many vectors; a block of a leaf and a small leaf of the lower tree hold so many.
SAMPLE_ROWS = 16_384
BLOCK_ROWS, SMALL_ROWS = 4096, 32
QUERY_ROWS = 4096
MAX_LEAVES = 4096


def chi_square_cdf(x, degrees):
    """Distribution function for an even number of degrees."""
    half = np.asarray(x, float) / 2
    total = term = np.ones_like(half)
    for j in range(1, degrees // 2):
        term = term * half / j
        total = total + term
    return 1 - np.exp(-half) * total


def stop_ratio(confidence=CONFIDENCE, degrees=PROJECTIONS):
    """Projected over true distance that is not exceeded with this confidence: where the test holds."""
    low, high = 0.0, 1e4
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, degrees) < confidence else (low, middle)
    return math.sqrt(high)


def directions(dimension, n=PROJECTIONS, seed=7):
    return np.random.default_rng(seed).standard_normal((dimension, n))


def split_tree(points, leaves):
    """Nested (axis, value, left, right) by medians of the widest axis; leaves are numbered."""
    count = 0

    def build(rows, parts):
        nonlocal count
        axis = int(np.ptp(rows, axis=0).argmax()) if len(rows) else 0
        middle = float(np.median(rows[:, axis])) if len(rows) else 0.0
        left = rows[:, axis] < middle if len(rows) else np.zeros(0, bool)
        if parts <= 1 or len(rows) < 2 or not left.any():
            count += 1
            return count - 1
        return axis, middle, build(rows[left], parts // 2), build(rows[~left], parts - parts // 2)
    return build(points, leaves), count


def leaf_of(tree, points):
    out = np.zeros(len(points), np.int32)

    def place(node, rows):
        if isinstance(node, int):
            out[rows] = node
            return
        axis, value, left, right = node
        low = points[rows, axis] < value
        place(left, rows[low])
        place(right, rows[~low])
    place(tree, np.arange(len(points)))
    return out


def _matrix(column, dimension):
    """An Arrow column of arrays of one length as a matrix of doubles."""
    return np.asarray(column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten(),
                      dtype=np.float64).reshape(-1, dimension)


def _unit(rows):
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


class Block:
    """The lower kd-tree over the vectors of a block: small leaves, their boxes, their rows."""

    def __init__(self, vectors, gaussian):
        self.unit = _unit(vectors)
        points = self.unit @ gaussian
        order, groups = np.arange(len(points)), []

        def build(rows):
            part = points[rows]
            axis = int(np.ptp(part, axis=0).argmax())
            if len(rows) <= SMALL_ROWS:
                groups.append(rows)
                return
            rows = rows[np.argpartition(part[:, axis], len(rows) // 2)]
            build(rows[:len(rows) // 2])
            build(rows[len(rows) // 2:])
        build(order)
        self.points, self.groups = points, groups
        self.low = np.array([points[g].min(axis=0) for g in groups])
        self.high = np.array([points[g].max(axis=0) for g in groups])

    def search(self, unit, point, k, bound, ratio):
        """(rows, cosines) of the k nearest found, verified in the order of projected distance.

        ``bound`` is a distance within which k vectors are known to be elsewhere.
        """
        away = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        away = np.sqrt((away * away).sum(axis=1))
        order = np.argsort(away, kind="stable")
        rows, cosines, done = np.zeros(0, np.int64), np.zeros(0), 0
        while done < len(order) and away[order[done]] <= ratio * bound:
            # The boxes nearest to the projection, a few at a time; the test holds before each step.
            step = order[done:done + 8]
            step = step[away[step] <= ratio * bound]
            done += len(step)
            new = np.concatenate([self.groups[g] for g in step])
            rows = np.concatenate((rows, new))
            cosines = np.concatenate((cosines, self.unit[new] @ unit))
            if len(rows) > k:
                best = np.argpartition(-cosines, k - 1)[:k]
                # Equal cosines at the end of the list stay, for ties are decided later by id.
                keep = cosines >= cosines[best].min()
                rows, cosines = rows[keep], cosines[keep]
            if len(rows) >= k:
                kth = np.partition(cosines, len(cosines) - k)[len(cosines) - k]
                bound = min(bound, math.sqrt(max(0.0, 2 - 2 * kth)) + 1e-9)
        return rows, cosines


def _place(tree, gaussian, dimension):
    def run(batches):
        for batch in batches:
            points = _unit(_matrix(batch.column(1), dimension)) @ gaussian
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf_of(tree, points)), pa.array(list(points), pa.list_(pa.float64()))],
                [*batch.schema.names, "leaf", "point"])
    return run


def _boxes(rows):
    """Leaves, their corners and their numbers of blocks, from one row per leaf."""
    corner = lambda name: np.array([[r[f"{name}{i}"] for i in range(PROJECTIONS)] for r in rows]).reshape(-1, PROJECTIONS)
    whole = lambda name: np.array([r[name] for r in rows], np.int32)
    return whole("leaf"), corner("low"), corner("high"), whole("blocks")


def _visits(boxes, ratio):
    """The blocks, but its own, that each query has to look into: those of the leaves whose box comes
    within the radius at which the test would stop the search."""
    def run(batches):
        leaf, low, high, blocks = boxes.value
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch, places = whole.slice(start, 256), []
                points = _matrix(batch.column(6), PROJECTIONS)
                for point, bound, home, own in zip(points, *(batch.column(i).to_pylist() for i in (3, 4, 5))):
                    away = np.maximum(np.maximum(low - point, point - high), 0)
                    reached = np.flatnonzero(np.sqrt((away * away).sum(axis=1)) <= ratio * bound)
                    places.append([{"leaf": int(leaf[i]), "block": b} for i in reached for b in range(int(blocks[i]))
                                   if (int(leaf[i]), b) != (home, own)])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:4], pa.array(places, pa.list_(pa.struct([("leaf", pa.int32()), ("block", pa.int32())])))],
                    ["class_id", "vector", "share", "bound", "places"])
    return run


def _search(gaussian, dimension, k, ratio):
    """Cogrouped: the vectors of a block, and the queries that have to look there."""
    def run(vectors, queries):
        out = ([], [], [])
        if vectors.num_rows and queries.num_rows:
            matrix = _matrix(vectors["vector"], dimension)
            block, ids = Block(matrix, gaussian), vectors["class_id"].to_numpy()
            rows = _matrix(queries["vector"], dimension)
            units, bounds = _unit(rows), queries["bound"].to_numpy()
            for q, unit, bound, own in zip(queries["class_id"].to_numpy(), units, bounds, rows):
                found, _ = block.search(unit, unit @ gaussian, k, bound, ratio)
                # The score itself is the cosine of the vectors as they are given.
                with np.errstate(over="ignore", under="ignore", invalid="ignore", divide="ignore"):
                    size = np.linalg.norm(matrix[found], axis=1) * np.linalg.norm(own)
                    scores = matrix[found] @ own / size
                # Squares of very large or small components leave the range of doubles; scaled vectors do not.
                lost = np.flatnonzero(~((size > 1e-280) & (size < 1e280)))
                scores[lost] = block.unit[found[lost]] @ unit
                out[0].append(np.full(len(found), q))
                out[1].append(ids[found])
                out[2].append(scores)
        parts = [np.concatenate(x) if x else np.zeros(0) for x in out]
        return pa.table([pa.array(parts[0].astype(np.int64)), pa.array(parts[1].astype(np.int64)),
                         pa.array(parts[2].astype(np.float64))], ["query_class", "class_id", "score"])
    return run


def nearest_neighbours(vectors, is_query, k=5, key="vec_id", vector="embedding", block_rows=BLOCK_ROWS,
                       sample_rows=SAMPLE_ROWS, confidence=CONFIDENCE):
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row for which ``is_query`` holds.

    Nearness is the cosine in double precision, ties go to the smaller id; candidates are all rows but
    those with the query's own id. Null or zero vectors, vectors with null or non-finite components,
    vectors of another length than the most frequent one, and rows without id take no part. With ``k``
    candidates or fewer, all are returned. Repeated rows count once; other columns are ignored.

    Rows with equal vectors are one class that keeps its ``k + 1`` smallest ids, which is all that any
    list can show, so a vector that a third of all rows share costs no more than another. A leaf that
    holds more than ``block_rows`` classes is several blocks. Each query is searched in one block of its
    own leaf first; the distance found says which other leaves it has to visit.
    """
    spark = vectors.sparkSession
    values = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("bigint").alias("vec_id"), values.alias("vector"), is_query.alias("is_query")).where(
        F.col("vec_id").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
        & F.exists("vector", lambda x: x != 0))
    rows = cut_lineage(rows, "vectors")
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    dimension = sizes.n if sizes else 1
    rows = rows.where(F.size("vector") == dimension)
    order = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.select("vector", "vec_id").withColumn("r", F.dense_rank().over(order)).where(F.col("r") <= k + 1)
    classes = few.groupBy("vector").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("class_id"), "vector", "ids")
    classes = cut_lineage(classes, "classes")
    asked = rows.where("is_query").select(F.col("vec_id").alias("query_id"), "vector").distinct()
    asked = cut_lineage(asked.join(classes.select("class_id", "vector"), "vector").select("query_id", "class_id"), "asked")
    # The upper tree.
    n_classes = classes.count()
    gaussian = directions(dimension)
    placed_schema = "class_id bigint, vector array<double>, leaf int, point array<double>"
    sample = classes.orderBy(F.xxhash64("class_id"), "class_id").limit(sample_rows).select("class_id", "vector")
    points = np.array([r.point for r in sample.mapInArrow(_place(0, gaussian, dimension), placed_schema).select("point").collect()],
                      float).reshape(-1, PROJECTIONS)
    wanted = min(MAX_LEAVES, max(1, len(points) // 8), -(-n_classes // block_rows))
    tree, _ = split_tree(points, wanted)
    placed = cut_lineage(classes.select("class_id", "vector").mapInArrow(
        _place(tree, gaussian, dimension), placed_schema), "placed")
    corners = [f(F.col("point")[i]).alias(f"{name}{i}") for i in range(PROJECTIONS) for name, f in (("low", F.min), ("high", F.max))]
    # One row per leaf: at most MAX_LEAVES.
    leaves = placed.groupBy("leaf").agg(F.count("*").alias("n"), *corners).withColumn(
        "blocks", F.ceil(F.col("n") / block_rows).cast("int"))
    leaves = cut_lineage(leaves, "leaves")
    n_asked = asked.select("class_id").distinct().count()
    shares = max(1, -(-n_asked // QUERY_ROWS))
    share = F.pmod(F.xxhash64("class_id", F.lit(1)), F.lit(shares)).cast("int").alias("share")
    stock = placed.join(F.broadcast(leaves.select("leaf", "blocks")), "leaf").select(
        "leaf", F.pmod(F.xxhash64("class_id"), "blocks").cast("int").alias("block"), "class_id", "vector")
    dealt = stock.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    queries = cut_lineage(placed.join(asked.select("class_id").distinct(), "class_id").join(
        F.broadcast(leaves.select("leaf", "blocks")), "leaf").select("*", share), "queries")
    ratio, schema = stop_ratio(confidence), "query_class bigint, class_id bigint, score double"
    place = ("leaf", "block", "share")

    def searched(who):
        return dealt.groupBy(*place).cogroup(who.groupBy(*place)).applyInArrow(
            _search(gaussian, dimension, k + 1, ratio), schema)

    own = F.pmod(F.xxhash64("class_id"), "blocks").cast("int")
    first = cut_lineage(searched(queries.select("class_id", "vector", "leaf", own.alias("block"), "share",
                                                F.lit(math.inf).alias("bound"))), "first")
    best = Window.partitionBy("query_class").orderBy(F.desc("score"), "class_id")
    ranked = lambda found: found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    bounds = ranked(first).groupBy(F.col("query_class").alias("class_id")).agg(
        F.when(F.count("*") > k, F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.min("score"))) + 1e-9)
        .otherwise(F.lit(math.inf)).alias("bound"))
    boxes = spark.sparkContext.broadcast(_boxes(leaves.orderBy("leaf").collect()))
    near = queries.join(bounds, "class_id").select(
        "class_id", "vector", "share", "bound", "leaf", own.alias("block"), "point")
    visits = near.mapInArrow(_visits(boxes, ratio), "class_id bigint, vector array<double>, share int, bound double, "
                             "places array<struct<leaf:int,block:int>>").select(
        "class_id", "vector", "share", "bound", F.explode("places").alias("place")).select(
        "class_id", "vector", "share", "bound", "place.*")
    rest = searched(visits.select("class_id", "vector", "leaf", "block", "share", "bound"))
    lists = ranked(first.unionByName(rest)).join(classes.select("class_id", "ids"), "class_id").select(
        F.col("query_class").alias("class_id"), "score", "ids")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return asked.join(lists, "class_id").select("query_id", "score", F.explode("ids").alias("vec_id")).where(
        "vec_id <> query_id").withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
