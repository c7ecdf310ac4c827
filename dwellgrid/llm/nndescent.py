"""Approximate nearest neighbours: an NN-descent graph and greedy search in it.

**Vectors.** Rows that are null, zero, of another length than most, or hold null or non-finite components
take no part. Equal vectors are one node; a node keeps its ``k + 1`` smallest identifiers, which is all
that a result of ``k`` can show of it. So a vector repeated in a third of all rows is one node.

**Graph.** For largest inner product the vectors get one more component that makes all norms equal, and
one byte per component. Nodes sorted by random hyperplane signs and cut into chunks give first
neighbour lists; then each iteration is a join of neighbours of neighbours: every node gathers its
neighbours and those it is a neighbour of, compares them with each other, and offers each the best
it has found; each node keeps its ``degree`` best. Offers are made only above the present worst
neighbour. Of the nodes that a hub is a neighbour of, ``degree`` (by hash) take part per iteration;
the others are reached through their own lists.

**Search.** Each query starts at its own node's neighbours and in each round expands its best unexpanded
nodes along the graph in both directions. Pairs of query and node are scored shard by shard: nodes
are dealt into shards, and each shard gets the vectors of the queries that reach it once, so
vectors aren't copied per pair. Scores are double-precision inner products of the original vectors.

Recall is measured against brute force in the tests (at least 0.9). Empty tables give empty results,
fewer than ``k`` candidates give all that are found, ties go to the smaller identifier. Repeated
rows of one identifier count once. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellgrid.sources.storage import written


@dataclass(frozen=True)
class Graph:
    """Parameters of the graph and of the search."""

    degree: int = 40
    orders: int = 4
    chunk: int = 256
    iterations: int = 5
    offers: int = 8
    bucket: int = 256
    beam: int = 200
    expand: int = 64
    rounds: int = 4
    shard: int = 1000


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) with v as double array, for the vectors that take part."""
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).filter(
        "vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0 AND exists(v, x -> x != 0)"
        " AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))"
    )
    usual = v.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return v.filter(F.size("v") == (usual["n"] if usual else 0)).dropDuplicates(["vec_id"])


def _top(rows: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    number = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("number", number).filter(F.col("number") <= k)


def _best(sim: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest entries of each row."""
    if sim.shape[1] <= k:
        return np.argsort(-sim, axis=1)
    return np.argpartition(-sim, k - 1, axis=1)[:, :k]


EDGES = "node long, near long, sim float"


def _codes(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.int8).reshape(len(column), -1).astype(np.float32)


def _coded(nodes: DataFrame) -> DataFrame:
    """(node, code): the vectors with equal norms, one byte per component."""
    norms = nodes.select(F.expr("aggregate(v, 0D, (s, x) -> s + x * x)").alias("q"), "v")
    top = norms.agg(F.max("q"), F.max(F.expr("array_max(transform(v, x -> abs(x)))"))).first()
    square = top[0] or 1.0
    rest_scale = square**0.5

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            x = np.stack(batch["v"].to_numpy())
            rest = np.sqrt(np.maximum(square - (x * x).sum(axis=1), 0.0))
            # Components are far below the norm: their own scale keeps resolution.
            scale = min(rest_scale, float(top[1]) or 1.0)
            parts = max(1, int(np.ceil((rest.max() / scale) ** 2)) if rest.max() > 0 else 1)
            parts = min(parts, 64)
            extra = np.repeat((rest / np.sqrt(64.0))[:, None], 64, axis=1) if rest_scale > scale else rest[:, None]
            full = np.hstack([x, extra]) / scale
            q = np.clip(np.rint(full * 127), -127, 127).astype(np.int8)
            yield pd.DataFrame({"node": batch["node"], "code": [r.tobytes() for r in q]})

    return nodes.select("node", "v").mapInPandas(code, "node long, code binary")


def _first_edges(coded: DataFrame, n: int, p: Graph) -> DataFrame:
    """Neighbours within chunks of several random orders."""

    def signs(seed: int):
        @F.pandas_udf("long")
        def sign(code: pd.Series) -> pd.Series:
            x = _codes(code)
            planes = np.random.default_rng(seed).normal(size=(x.shape[1], 40)).astype(np.float32)
            bits = (x @ planes > 0).astype(np.int64)
            return pd.Series(bits @ (1 << np.arange(39, -1, -1, dtype=np.int64)))

        return sign

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame()
        for batch in batches:
            held = pd.concat([held, batch]) if len(held) else batch
            while len(held) >= 2 * p.chunk:
                yield edges(held.iloc[: p.chunk])
                held = held.iloc[p.chunk :]
        if len(held):
            yield edges(held)

    def edges(rows: pd.DataFrame) -> pd.DataFrame:
        ids, x = rows["node"].to_numpy(), _codes(rows["code"])
        sim = x @ x.T
        np.fill_diagonal(sim, -np.inf)
        cols = _best(sim, min(p.degree, len(ids) - 1)) if len(ids) > 1 else np.empty((1, 0), int)
        near = ids[cols]
        return pd.DataFrame(
            {
                "node": np.repeat(ids, cols.shape[1]),
                "near": near.ravel(),
                "sim": np.take_along_axis(sim, cols, axis=1).ravel().astype(np.float32),
            }
        )

    out = None
    tasks = max(1, n // (16 * p.chunk))
    for seed in range(p.orders):
        sorted_rows = (
            coded.withColumn("sign", signs(seed)("code"))
            .repartitionByRange(tasks, "sign", "node")
            .sortWithinPartitions("sign", "node")
            .select("node", "code")
        )
        found = sorted_rows.mapInPandas(chunks, EDGES)
        out = found if out is None else out.union(found)
    return out


def _kept(edges: DataFrame, p: Graph, n: int) -> DataFrame:
    """The best ``degree`` distinct neighbours of each node."""

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["node", "near"]).sort_values(
            ["node", "sim", "near"], ascending=[True, False, True]
        )
        return rows[rows.groupby("node").cumcount() < p.degree][["node", "near", "sim"]]

    buckets = max(1, n // p.bucket)
    return (
        edges.withColumn("bucket", F.pmod(F.xxhash64("node"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandas(best, EDGES)
    )


def _offers(edges: DataFrame, coded: DataFrame, p: Graph, n: int, turn: int) -> DataFrame:
    """Edges found by comparing the neighbours of each node with each other."""
    worst = edges.groupBy("node").agg(F.min("sim").alias("worst"), F.count(F.lit(1)).alias("n"))
    worst = worst.selectExpr("node AS member", f"IF(n < {p.degree}, float('-inf'), worst) AS worst")
    reverse = _top(
        edges.selectExpr("near AS centre", "node AS member"),
        ["centre"],
        [F.xxhash64("member", F.lit(turn))],
        p.degree,
    ).select("centre", "member")
    members = edges.selectExpr("node AS centre", "near AS member").union(reverse).distinct()
    buckets = max(1, n // p.bucket)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["centre", "member"])
        centre, ids = rows["centre"].to_numpy(), rows["member"].to_numpy()
        x, limit = _codes(rows["code"]), rows["worst"].to_numpy()
        edge = np.flatnonzero(np.diff(centre, prepend=centre[0] - 1, append=centre[-1] + 1))
        out = []
        for a, b in zip(edge, edge[1:]):
            if b - a < 2:
                continue
            sim = x[a:b] @ x[a:b].T
            np.fill_diagonal(sim, -np.inf)
            cols = _best(sim, p.offers)
            value = np.take_along_axis(sim, cols, axis=1)
            i, j = np.nonzero(value > limit[a:b, None])
            out.append((ids[a + i], ids[a + cols[i, j]], value[i, j]))
        if not out:
            return pd.DataFrame({"node": [], "near": [], "sim": []})
        return pd.DataFrame(dict(zip(["node", "near", "sim"], map(np.concatenate, zip(*out)))))

    return (
        members.join(worst, "member")
        .join(coded.withColumnRenamed("node", "member"), "member")
        .withColumn("bucket", F.pmod(F.xxhash64("centre"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandas(compare, EDGES)
    )


def neighbour_graph(nodes: DataFrame, n: int, p: Graph = Graph()) -> DataFrame:
    """(node, near, sim): the neighbour lists after the last iteration."""
    coded = written(_coded(nodes), "codes")
    edges = written(_kept(_first_edges(coded, n, p), p, n), "edges")
    for turn in range(p.iterations):
        offered = _offers(edges, coded, p, n, turn)
        edges = written(_kept(edges.union(offered), p, n), "edges")
    return edges


SCORED = "query long, node long, score double"


def _scored(pairs: DataFrame, nodes: DataFrame, n: int, p: Graph) -> DataFrame:
    """Pairs (query, node) with the inner product of their vectors, shard by shard."""
    shards = max(1, n // p.shard)
    shard = F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")
    dealt = pairs.withColumn("shard", shard)
    own = nodes.select(shard.alias("shard"), F.lit(False).alias("asked"), F.col("node").alias("id"), "v")
    asked = (
        dealt.selectExpr("shard", "query AS node")
        .distinct()
        .join(nodes, "node")
        .selectExpr("shard", "true AS asked", "node AS id", "v")
    )

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty:
            return pd.DataFrame({"query": [], "node": [], "score": []})
        side = {}
        for flag, part in right.groupby("asked"):
            order = part["id"].to_numpy().argsort()
            side[flag] = part["id"].to_numpy()[order], np.stack(part["v"].to_numpy())[order]
        out = np.empty(len(left))
        q, c = left["query"].to_numpy(), left["node"].to_numpy()
        for at in range(0, len(left), 20_000):
            x = side[True][1][np.searchsorted(side[True][0], q[at : at + 20_000])]
            y = side[False][1][np.searchsorted(side[False][0], c[at : at + 20_000])]
            out[at : at + 20_000] = np.einsum("ij,ij->i", x, y)
        return pd.DataFrame({"query": q, "node": c, "score": out})

    return dealt.groupBy("shard").cogroup(own.union(asked).groupBy("shard")).applyInPandas(score, SCORED)


def search(vectors: DataFrame, is_query: Column, k: int = 20, p: Graph = Graph()) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every query row."""
    usable = written(_usable(vectors), "vectors")
    ids = _top(usable, ["v"], [F.col("vec_id")], k + 1)
    nodes = usable.groupBy("v").agg(F.min("vec_id").alias("node"))
    nodes = written(nodes.select("node", "v"), "nodes")
    copies = written(ids.join(nodes, "v").select("node", "vec_id"), "copies")
    n = nodes.count()
    edges = neighbour_graph(nodes, n, p)
    queries = usable.filter(is_query).join(nodes, "v").select("vec_id", "node")
    asked = queries.selectExpr("node AS query").distinct()
    links = written(
        edges.select("node", "near").union(edges.select("near", "node")).distinct(), "graph"
    )
    # The node itself is the first to be expanded.
    state = asked.selectExpr("query", "query AS node", "double('Infinity') AS score", "false AS expanded")
    order = [F.desc("score"), F.col("node")]
    for turn in range(p.rounds):
        width = p.expand if turn else 1
        frontier = _top(state.filter("NOT expanded"), ["query"], order, width).select("query", "node")
        reached = (
            frontier.join(links, "node")
            .select("query", F.col("near").alias("node"))
            .distinct()
            .join(state.select("query", "node"), ["query", "node"], "left_anti")
        )
        new = _scored(reached, nodes, n, p).withColumn("expanded", F.lit(False))
        marked = state.join(frontier.withColumn("now", F.lit(True)), ["query", "node"], "left").select(
            "query", "node", "score", (F.col("expanded") | F.coalesce("now", F.lit(False))).alias("expanded")
        )
        state = written(_top(marked.union(new), ["query"], order, p.beam).drop("number"), "beam")
    # The node's own copies are candidates too: give it its true score.
    own = _scored(asked.selectExpr("query", "query AS node"), nodes, n, p)
    best = _top(
        state.filter("query != node").select("query", "node", "score").union(own), ["query"], order, k + 1
    ).drop("number")
    found = (
        queries.withColumnRenamed("vec_id", "query_id").withColumnRenamed("node", "query")
        .join(best, "query")
        .join(copies, "node")
        .filter("vec_id != query_id")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        found.withColumn("rank", rank)
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
