"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.session import cut_lineage


def components(edges, left="a", right="b"):
    """(node, component) for every node of the edges; a component is named by one of its nodes.

    Nodes are bigints. In each round a node points to its smallest neighbour if that is smaller, and
    the edges between the nodes pointed to are the next round's. Minima are aggregated before they
    are shuffled, so a node with very many edges is no single task; lookups are joins with one row
    per node on the right, which Spark splits where a key is frequent. Every round is written to the
    shared folder, and only the question whether edges are left comes to the driver.
    """
    pair = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    current = cut_lineage(edges.where(F.col(left) != F.col(right)).select(
        *pair(F.col(left), F.col(right))).distinct(), "edges")
    rounds = []
    while True:
        ends = current.select("a", "b").unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = cut_lineage(ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
            "node", F.least("node", "least").alias("parent")), "parents")
        rounds.append(parents)
        of_a = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        of_b = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        current = cut_lineage(current.join(of_a, "a").join(of_b, "b").where("pa <> pb").select(
            *pair(F.col("pa"), F.col("pb"))).distinct(), "edges")
        if current.isEmpty():
            break
    found = rounds[0].select("node", F.col("parent").alias("component"))
    for parents in rounds[1:]:
        step = parents.select(F.col("node").alias("component"), "parent")
        found = found.join(step, "component", "left").select(
            "node", F.coalesce("parent", "component").alias("component"))
    return found
