"""Exact top-k by inner product: a dual-tree search over one cover tree of queries and data.

The tree is built on a bounded sample; every vector, query or not, then goes to its nearest leaf, and the
leaves' covering radii are taken over all of them. A first pass compares each query group with its most promising
leaf, which gives each query a k-th score. A traversal of node pairs, on the tree alone, prunes those whose bound

    q.p <= cq.cp + |cq| Rp + |cp| Rq + Rq Rp

is below the group's worst k-th score. The pairs of leaves that are left are compared in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotewright.llm.common import save


@dataclass
class Node:
    center: np.ndarray
    children: list[Node] = field(default_factory=list)
    leaf: int = -1
    radius: float = -np.inf  # over the data
    query_radius: float = -np.inf
    worst: float = np.inf


def build_tree(points: np.ndarray, leaf_size: int = 48, fan_out: int = 8) -> tuple[Node, np.ndarray]:
    """A cover tree over float points, and the centers of its leaves.

    A node's children cover its points within half its radius, each center over that far from those before it. Where
    that takes more than ``fan_out`` centers, as in many dimensions, the farthest points serve and each point goes
    to the nearest. Distances are computed once, for all pairs of the bounded sample.
    """
    squares = (points**2).sum(1)
    far = np.sqrt(np.maximum(squares[:, None] + squares[None, :] - 2 * points @ points.T, 0))
    leaves: list[int] = []

    def cover(own: np.ndarray, radius: float) -> np.ndarray:
        chosen = [own[0]]
        near = far[own, own[0]]
        while len(chosen) <= fan_out and near.max() > radius:
            chosen.append(own[int(near.argmax())])
            near = np.minimum(near, far[own, chosen[-1]])
        return np.array(chosen[:fan_out])

    def grow(own: np.ndarray, center: int) -> Node:
        node = Node(points[center])
        radius = float(far[own, center].max())
        if len(own) <= leaf_size or not radius:
            node.leaf = len(leaves)
            leaves.append(center)
            return node
        centers = cover(np.concatenate(([center], own[own != center])), radius / 2)
        nearest = far[np.ix_(own, centers)].argmin(1)
        node.children = [grow(own[nearest == i], int(c)) for i, c in enumerate(centers)]
        return node

    root = grow(np.arange(len(points)), int(((points - points.mean(0)) ** 2).sum(1).argmin()))
    return root, points[leaves]


def _rows(column: pa.Array, dim: int, kind: type = np.int64) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dim)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: as doubles where they fit, else as Python's integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _assign(centers: np.ndarray, dim: int):
    squares = (centers**2).sum(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _rows(b.column(1), dim, np.float64)
            leaf = np.concatenate([(squares - 2 * x[i : i + 4096] @ centers.T).argmin(1) for i in range(0, len(x), 4096)] or [np.zeros(0, int)])
            far = np.sqrt(((x - centers[leaf]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(leaf, pa.int32()), pa.array(far)], ["id", "v", "is_query", "leaf", "far"])

    return run


def _compare(k: int, dim: int):
    def run(key: tuple, data: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not data.num_rows or not queries.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names)
        ids, query_ids = data.column("id").to_numpy(), queries.column("query_id").to_numpy()
        found = ([], [], [])
        vectors, least = _rows(data.column("v"), dim), queries.column("least").to_numpy()
        for at in range(0, len(query_ids), 1024):
            own = query_ids[at : at + 1024]
            score = _products(_rows(queries.column("query").slice(at, 1024), dim), vectors)
            mine = ids[None, :] == own[:, None]
            kth = np.full(len(own), np.iinfo(np.int64).min)
            if len(ids) > k + 1:
                kth = np.partition(np.where(mine, np.iinfo(np.int64).min, score), len(ids) - k, axis=1)[:, len(ids) - k]
            row, col = np.nonzero((score >= np.maximum(kth, least[at : at + 1024])[:, None]) & ~mine)
            order = np.lexsort((ids[col], -score[row, col].astype(np.float64), row))
            order = order[np.lexsort((ids[col[order]], -score[row[order], col[order]], row[order]))]
            row, col = row[order], col[order]
            first = np.searchsorted(row, row)
            top = np.arange(len(row)) - first < k
            for to, x in zip(found, (own[row[top]], ids[col[top]], score[row[top], col[top]])):
                to.append(x)
        return pa.table([pa.array(np.concatenate(x).astype(np.int64)) for x in found], names)

    return run


def _bound(q: Node, p: Node) -> float:
    nq, np_ = float(np.sqrt(q.center @ q.center)), float(np.sqrt(p.center @ p.center))
    best = float(q.center @ p.center) + nq * p.radius + np_ * q.query_radius + p.radius * q.query_radius
    return best + 1e-6 * (1 + abs(best))


def surviving_pairs(root: Node) -> list[tuple[int, int]]:
    """(query leaf, data leaf) whose bound reaches the query group's worst k-th score."""
    found, stack = [], [(root, root)]
    while stack:
        q, p = stack.pop()
        if q.query_radius < 0 or p.radius < 0 or _bound(q, p) < q.worst:
            continue
        if q.leaf >= 0 and p.leaf >= 0:
            found.append((q.leaf, p.leaf))
        elif p.leaf >= 0 or (q.leaf < 0 and q.query_radius >= p.radius):
            stack += [(c, p) for c in q.children]
        else:
            stack += [(q, c) for c in p.children]
    return found


def _fill(node: Node, leaves: dict[int, tuple[float, float, float]]) -> None:
    """Radii and worst scores of a node from those of its leaves; -inf where it holds nothing."""
    if node.leaf >= 0:
        node.radius, node.query_radius, node.worst = leaves.get(node.leaf, (-np.inf, -np.inf, np.inf))
        return
    for c in node.children:
        _fill(c, leaves)
        step = float(np.sqrt(((c.center - node.center) ** 2).sum()))
        node.radius = max(node.radius, c.radius + step)
        node.query_radius = max(node.query_radius, c.query_radius + step)
        node.worst = min(node.worst, c.worst)


def exact_top_k(
    vectors: DataFrame, is_query: str, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, sample: int = 2048, chunk: int | None = None, query_block: int = 8192
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``k`` rows, but its own id, of the highest inner product.

    Components become floor(``scale`` * x). ``is_query`` is a SQL condition on the row. Ties go to the smaller id. Vectors
    that are null or hold a null or non-finite component take no part; shorter vectors count as filled up with
    zeros; rows that repeat an id are rows of their own, but never answer that id's queries, which share one list. Empty tables give an
    empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    own = vectors.where(f"`{id_col}` IS NOT NULL AND `{vector_col}` IS NOT NULL").select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.expr(f"coalesce({is_query}, false)").alias("is_query")
    )
    own = own.where("forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    dim = max(1, own.agg(F.max(F.size("v"))).first()[0] or 1)
    own = own.withColumn("v", F.expr(f"concat(transform(v, x -> cast(floor({scale} * x) AS bigint)), array_repeat(0L, {dim} - size(v)))"))
    taken = own.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toArrow()  # at most `sample` rows
    schema = "query_id long, vec_id long, score long"
    if not taken.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    root, centers = build_tree(_rows(taken.column(0), dim, np.float64))
    placed = save(own.mapInArrow(_assign(centers, dim), "id long, v array<bigint>, is_query boolean, leaf int, far double"), "placed")
    # one row per leaf, of which there are fewer than rows in the sample
    query_far = F.max(F.when(F.col("is_query"), F.col("far")))
    stats = {r.leaf: r for r in placed.groupBy("leaf").agg(F.count("*").alias("n"), F.max("far").alias("far"), query_far.alias("qfar"), F.count_if("is_query").alias("nq")).collect()}
    n, nq = sum(r.n for r in stats.values()), sum(r.nq for r in stats.values())
    if chunk is None:
        chunk = min(65_536, max(64, n // (2 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    blocks = max(1, -(-nq // query_block))
    chunks = spark.createDataFrame([(leaf, -(-r.n // chunk)) for leaf, r in stats.items()], "leaf int, chunks int")
    data = placed.join(F.broadcast(chunks), "leaf").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    queries = placed.where("is_query").withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))

    def compare(pairs: list[tuple[int, int]], least: DataFrame | None) -> DataFrame:
        wanted = spark.createDataFrame([(q, p, -(-stats[p].n // chunk)) for q, p in pairs], "leaf int, to int, chunks int")
        asked = queries.join(F.broadcast(wanted), "leaf")
        if least is None:
            asked = asked.withColumn("least", F.lit(np.iinfo(np.int64).min).cast("long"))
        else:
            asked = asked.join(least, "id", "left").withColumn("least", F.coalesce("least", F.lit(np.iinfo(np.int64).min).cast("long")))
        asked = asked.withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)")))
        right = asked.select(F.col("to").alias("leaf"), "chunk", "block", F.col("id").alias("query_id"), F.col("v").alias("query"), "least")
        into = F.broadcast(spark.createDataFrame([(p,) for p in {p for _, p in pairs}], "leaf int"))
        left = data.join(into, "leaf", "left_semi").select("leaf", "chunk", F.explode(F.expr(f"sequence(0, {blocks - 1})")).alias("block"), "id", "v")
        keys = ["leaf", "chunk", "block"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_compare(k, dim), schema)

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    top = lambda df: df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    filled = [leaf for leaf, r in stats.items()]
    asking = [leaf for leaf, r in stats.items() if r.nq]
    if not asking:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    closeness = centers[asking] @ centers[filled].T
    seeds = [(q, filled[i]) for q, row in zip(asking, closeness) for i in np.argsort(-row)[:2].tolist()]
    first = save(top(compare(seeds, None)), "first")
    kth = first.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
    kth = save(kth.where("least IS NOT NULL"), "kth")
    worst = queries.join(kth, "id", "left").groupBy("leaf").agg(F.when(F.count("least") == F.count("*"), F.min("least")).alias("w")).collect()
    worst = {r.leaf: -np.inf if r.w is None else float(r.w) for r in worst}
    grown = 1 + 1e-9
    _fill(root, {leaf: (r.far * grown, -np.inf if r.qfar is None else r.qfar * grown, worst.get(leaf, np.inf)) for leaf, r in stats.items()})
    rest = sorted(set(surviving_pairs(root)) - set(seeds))
    found = first.drop("rank")
    if rest:
        found = found.unionByName(compare(rest, kth))
    return top(found).select("query_id", "rank", "vec_id", "score")
