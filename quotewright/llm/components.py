"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.llm.common import save


def _least_neighbour(pairs: DataFrame, tag: str, rows: int) -> DataFrame:
    """(u, m, n): each node's least neighbour and how many it has. Saved, so that the join with it is between two plain
    exchanges, which Spark can split at a hub."""
    return save(pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), tag, rows)


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``edges`` (u long, v long) -> (node long, root long), root being the component's smallest node.

    Nodes without an edge are absent; loops, repeated edges and null ends are ignored; an empty table
    gives an empty result. Each round joins the edges with one row per node and writes a table; the
    edges never gather in one place. The rounds grow with the logarithm of the components' size.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = save(edges.distinct(), "edges")
    rows = 2 * edges.count()  # about as many as a round makes
    for _ in range(max_rounds):
        # large star: every larger neighbour of u is linked to the least one of u and its neighbours
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least_neighbour(both, "large", rows)
        if least.where("m < u AND n > 1").isEmpty():  # every node is the least of its component or linked to that alone
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = (
            both.join(least.drop("n"), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        edges = save(edges, "edges", rows)
        # small star: u and its smaller neighbours are linked to the least one
        least = _least_neighbour(edges, "small", rows).drop("n")
        edges = save(
            edges.join(least, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct(),
            "edges",
            rows,
        )
    raise RuntimeError("components did not settle")
