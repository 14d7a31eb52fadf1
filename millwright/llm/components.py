"""Connected components of a table of links: hook every node to the smallest node around, then follow the hooks.

A few thousand links are closed in one task instead.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millwright.llm.stored import written

MOST_ROUNDS = 60
#: Links up to which one task closes them all; more are closed by rounds of joins.
SMALL = 16_384


def hooked(edges: DataFrame) -> DataFrame:
    """A forest ``u, v`` with the components of ``edges(u, v)``, ``v < u``: one smaller node for every node but the roots.

    In each round a node keeps its smallest neighbour, and its other smaller neighbours are tied to that one
    instead. Ends only get smaller, and copies of an edge fall together, until every node has one edge.
    """
    for _ in range(MOST_ROUNDS):
        least = written(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "hooks")
        # A node of one edge is done for this round; only the others are looked up again.
        several = least.filter("n > 1").select("u", "m")
        if several.isEmpty():
            return least.select("u", F.col("m").alias("v"))
        moved = edges.join(several, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(least.select("u", F.col("m").alias("v")).unionAll(moved).distinct(), "links")
    raise RuntimeError(f"components not settled after {MOST_ROUNDS} rounds")


def rooted(forest: DataFrame) -> DataFrame:
    """``u, v`` with the root of every node's tree, by doubling the way in each round."""
    for _ in range(MOST_ROUNDS):
        ahead = forest.select(F.col("u").alias("v"), F.col("v").alias("next"))
        forest = written(
            forest.select("u", "v").join(ahead, "v", "left").select("u", F.coalesce("next", "v").alias("v"), F.col("next").isNotNull().alias("more")),
            "ways",
        )
        if forest.filter("more").isEmpty():
            return forest.select("u", "v")
    raise RuntimeError(f"roots not found after {MOST_ROUNDS} rounds")


def closed_at_once(edges: DataFrame) -> DataFrame:
    """``u, v`` with the root of every node but the roots, for at most ``SMALL`` edges ``u, v``."""
    def run(batches):
        head: dict = {}

        def root(x):
            while head.setdefault(x, x) != x:
                head[x] = head[head[x]]
                x = head[x]
            return x

        schema = None
        for batch in batches:
            schema = batch.schema
            for u, v in zip(*(c.to_pylist() for c in batch.columns)):
                low, high = sorted((root(u), root(v)))
                head[high] = low
        if schema is not None:
            found = [(x, root(x)) for x in list(head) if root(x) != x]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], schema.field(i).type) for i in (0, 1)], ["u", "v"])

    return edges.coalesce(1).mapInArrow(run, edges.schema)


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``; the component is its smallest node.

    The groups are only ever reduced to a minimum, so a node with very many links needs no room. Links with a null
    or from a node to itself change nothing; without links the result is empty.
    """
    edges = written(
        links.filter("a is not null and b is not null and a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    found = written(closed_at_once(edges), "roots") if edges.count() <= SMALL else rooted(hooked(edges))
    roots = found.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return found.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
