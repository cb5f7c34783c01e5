"""Mixing sources to target weights by balanced sampling (cube method).

Every document starts with the probability that its source's target asks for. Inside a source the
probabilities are moved along directions that keep two totals, documents and tokens, until all but
two documents of a block are decided (flight phase). Those that are left over from the blocks of a
source meet again in fewer blocks, until one block is left; its last two documents are the landing
problem. A source is dealt out over blocks, so that a source with a third of all documents is many
groups, and only ids, sizes and probabilities are shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from scriptorium.session import cut_lineage

# What a word is, the weights of the sources in turn, how often a source repeats at most.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
BLOCK_ROWS = 2048
MAX_SOURCES = 100_000
_NEAR = 1e-9


def word_count(text):
    """Number of words as a long; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(totals, weights=WEIGHTS, max_repeats=MAX_REPEATS):
    """Target tokens by source, from {source: tokens}.

    Sources by code point, null last, take the ``weights`` in turn and share all tokens. A target
    stops at ``max_repeats`` times its source's tokens; what is above is shared anew by weight.
    """
    names = sorted((s for s in totals if s is not None)) + [s for s in totals if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, result = float(sum(totals.values())), list(names), dict.fromkeys(names, 0.0)
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if share * weight[s] > max_repeats * totals[s]]
        if not full:
            result.update((s, share * weight[s]) for s in open_)
            break
        for s in full:
            result[s] = float(max_repeats * totals[s])
            left -= result[s]
        open_ = [s for s in open_ if s not in set(full)]
    return result


def _direction(size, rest):
    """Moves of the ``rest`` that make up for a move of 1 by a document of this size.

    They are the smallest ones that keep both totals; where all of the rest have one size, and it is
    another size, only the tokens can be kept.
    """
    centred = rest - rest.mean()
    spread = centred @ centred
    if spread > 0:
        return -1 / len(rest) - (size - rest.mean()) * centred / spread
    return np.full(len(rest), -1 / len(rest) if size == rest[0] else -size / (rest[0] * len(rest)))


def fly(sizes, probabilities, rng):
    """Probabilities after the flight phase: all but at most two are 0 or 1, both totals are kept.

    The largest undecided document moves and the others make up for it, until one of them meets 0 or
    1; which way is by chance such that every expectation stays. So the smallest ones land.
    """
    sizes, p = np.asarray(sizes, float), np.asarray(probabilities, float).copy()
    settled = (p <= _NEAR) | (p >= 1 - _NEAR)
    p[settled] = np.round(p[settled])
    open_ = np.flatnonzero(~settled)
    open_ = open_[np.argsort(-sizes[open_], kind="stable")]
    while len(open_) > 2:
        u = np.concatenate(([1.0], _direction(sizes[open_[0]], sizes[open_[1:]])))
        now = p[open_]
        with np.errstate(divide="ignore"):
            to_one, to_zero = (1 - now) / np.abs(u), now / np.abs(u)
        up, down = np.where(u > 0, to_one, to_zero).min(), np.where(u > 0, to_zero, to_one).min()
        now = now + (up if rng.random() * (up + down) < down else -down) * u
        settled = (now <= _NEAR) | (now >= 1 - _NEAR)
        p[open_] = np.where(settled, np.round(now), now)
        open_ = open_[~settled]
    return p


def land(sizes, p):
    """Decide the last documents: the outcome nearest to the tokens, then to the documents, expected."""
    left = [i for i in range(len(p)) if 0 < p[i] < 1]
    outcomes = [[(n >> k) & 1 for k in range(len(left))] for n in range(1 << len(left))]
    best = min(outcomes, key=lambda o: (
        abs(sum((x - p[i]) * sizes[i] for x, i in zip(o, left))), abs(sum(x - p[i] for x, i in zip(o, left)))))
    for x, i in zip(best, left):
        p[i] = x
    return p


def _flight(level, last, seed):
    def run(frame):
        frame = frame.sort_values(["size", "doc_id"], ascending=[False, True], kind="stable", na_position="last")
        name = repr((seed, level, frame["source"].iloc[0], int(frame["block"].iloc[0]))).encode()
        rng = np.random.default_rng(int.from_bytes(hashlib.blake2b(name, digest_size=8).digest(), "big"))
        sizes = frame["size"].to_numpy(float)
        p = fly(sizes, frame["p"].to_numpy(), rng)
        if last[frame["source"].iloc[0] if pd.notna(frame["source"].iloc[0]) else None]:
            p = land(sizes, p)
        return frame.assign(p=p)
    return run


def mix_sources(docs, size, id_column="doc_id", source="source", weights=WEIGHTS, max_repeats=MAX_REPEATS,
                block_rows=BLOCK_ROWS, max_sources=MAX_SOURCES, seed=0, keep=()):
    """One row per document: doc_id, source, size, source_size, target, copies (0 to ``max_repeats``)
    and the ``keep`` columns, whose names begin with an underscore.

    ``size`` is a column expression over ``docs``. A document is taken as often as its source's ratio
    of target to size says, the whole part for certain and the rest by the cube method. Reruns agree,
    for chance comes from ``seed``, the source and the block. A null source is a source of its own; a
    document without tokens gets the whole part; repeated rows are decided one by one. The landing
    takes the outcome nearest to the target. Sources are a stated small set: their totals, one row
    per source, are the only thing the driver sees, and more than ``max_sources`` are an error.
    """
    sized = cut_lineage(docs.select(F.col(id_column).alias("doc_id"), F.col(source).alias("source"),
                                    size.cast("bigint").alias("size"), *keep), "sizes")
    spark = sized.sparkSession
    rows = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    total, count = {r.source: r["size"] for r in rows}, {r.source: r.n for r in rows}
    goal = targets(total, weights, max_repeats)
    ratio = {s: goal[s] / total[s] if total[s] else 0.0 for s in goal}
    blocks = {s: -(-count[s] // block_rows) for s in count}
    plan = spark.createDataFrame(
        [(s, total[s], goal[s], int(ratio[s] + _NEAR), max(0.0, ratio[s] - int(ratio[s] + _NEAR))) for s in goal],
        "s string, source_size bigint, target double, copies bigint, p double")
    units = sized.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn(
        "p", F.when(F.col("size") > 0, F.col("p")).otherwise(0.0))
    done, level = [], 0
    while True:
        table = spark.createDataFrame([(s, n) for s, n in blocks.items()], "s string, blocks bigint")
        dealt = units.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("s"))).withColumn(
            "block", F.pmod(F.xxhash64("doc_id", "size", F.lit(level)), F.col("blocks"))).drop("s", "blocks")
        last = {s: n <= 1 for s, n in blocks.items()}
        moved = dealt.groupBy("source", "block").applyInPandas(_flight(level, last, seed), dealt.schema).drop("block")
        if all(last.values()):
            done.append(moved)
            break
        moved = cut_lineage(moved, "flight")
        decided = (F.col("p") <= 0) | (F.col("p") >= 1)
        done.append(moved.where(decided))
        units, level = moved.where(~decided), level + 1
        # A block leaves two documents at most.
        blocks = {s: -(-2 * n // block_rows) if n > 1 else n for s, n in blocks.items()}
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result.select("doc_id", "source", "size", "source_size", "target",
                         (F.col("copies") + F.round("p").cast("bigint")).alias("copies"), *keep)
