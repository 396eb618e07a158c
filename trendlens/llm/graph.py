"""Connected components over an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import forget, written


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; ``root`` is the
    smallest node of its component.

    Each round runs a large-star step (every larger neighbour of a node is
    hung under the node's smallest neighbour) and a small-star step (the same
    for the smaller ones); the number of rounds grows with the logarithm of
    the graph, not with its longest path.  Rounds are Spark joins over
    written tables: minima come from partial aggregation, and because both
    join inputs are plain scans, adaptive execution can split the rows of a
    hub.  Self links and NULL ends are ignored; repeated links count once;
    no links give no rows.
    """
    edges = written(
        links.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct(), "cc")
    seen = _signature(edges)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        sides = edges.select(F.col("lo").alias("u"), F.col("lo").alias("v")).unionAll(
            edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        # Smallest neighbour of each node that is the lower end of an edge.
        least = written(sides.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
        large = written(edges.join(least, edges.lo == least.u).select("hi", F.col("m").alias("lo")).distinct(),
                        "cc-large")
        low = written(large.groupBy("hi").agg(F.min("lo").alias("m")), "cc-low")
        moved = large.join(low, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        after = written(low.select("hi", F.col("m").alias("lo")).unionAll(moved).distinct(), "cc")
        now = _signature(after)
        for table in (edges, least, large, low):
            forget(table)
        edges = after
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(roots)
