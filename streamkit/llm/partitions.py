"""Approximate nearest neighbours in learned partitions.

Fitted on a bounded sample of distinct vectors (``SAMPLE``, by the order of a
hash): the sample's nearest-neighbour graph is partitioned into ``PARTS`` parts
of equal size that cut few edges, by recursive bisection at the median of the
graph's second eigenvector and exchanges between the parts.  A small network
with one hidden layer learns, from the vector alone, in which parts a vector's
neighbours lie.

Every row of the table goes to its most probable part; a query is routed to
its most probable parts, as many as hold ``TARGET`` of the neighbours within
the sample, and all their rows are scored exactly.  Parts are divided into
blocks of fixed size, so a vector that a third of all rows share fills several
blocks and no task.  Defined results: see ``vectors``; ties go to the smaller
id; with fewer than k candidates in the probed parts those are returned, and
all parts are probed where they hold too few; an empty table gives an empty
result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamkit.llm.common import map_texts, read_table, stage_table
from streamkit.llm.vectors import ROWS, every, matrix, packed, ranked, search

#: Vectors that the partition is fitted on, parts, neighbours in the graph.
SAMPLE, PARTS, EDGES = 8192, 16, 10
HIDDEN, EPOCHS, BATCH = 128, 30, 256
#: Share of the sample's neighbours that the probed parts hold.
TARGET = 0.98
K, EVERY, TOGETHER = 10, 100, 256


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest others of each row."""
    n = len(x)
    k = min(k, n - 1)
    square, out = (x ** 2).sum(axis=1), np.empty((n, k), int)
    for at in range(0, n, 1024):
        d = square - 2 * x[at:at + 1024] @ x.T
        d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        out[at:at + 1024] = np.argpartition(d, k - 1, axis=1)[:, :k] if k else 0
    return out


def bisect(graph: np.ndarray, nodes: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of ``nodes``: the second eigenvector of the walk on their
    graph by power iteration, cut at the median, then exchanges of the pairs
    that gain most."""
    place = np.full(len(graph), -1)
    place[nodes] = np.arange(len(nodes))
    a, b = np.repeat(np.arange(len(nodes)), graph.shape[1]), place[graph[nodes].ravel()]
    a, b = a[b >= 0], b[b >= 0]
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    degree = np.bincount(a, minlength=len(nodes)) + 1.0
    v = rng.normal(size=len(nodes))
    for _ in range(120):
        v = v - (v * degree).sum() / degree.sum()
        v = (v + np.bincount(a, v[b], len(nodes))) / degree * 0.5 + v * 0.5
        v /= np.linalg.norm(v) + 1e-30
    side = np.empty(len(nodes), bool)
    side[np.argsort(v, kind="stable")] = np.arange(len(nodes)) >= len(nodes) // 2
    for _ in range(10):
        across = np.bincount(a, side[a] != side[b], len(nodes)) * 2 - np.bincount(a, minlength=len(nodes))
        left, right = np.flatnonzero(~side & (across > 0)), np.flatnonzero(side & (across > 0))
        m = min(len(left), len(right)) // 2
        if m == 0:
            break
        side[left[np.argsort(-across[left], kind="stable")[:m]]] = True
        side[right[np.argsort(-across[right], kind="stable")[:m]]] = False
    return nodes[~side], nodes[side]


def balanced_parts(graph: np.ndarray, parts: int) -> np.ndarray:
    """The part of each node; ``parts`` is a power of two."""
    rng, groups = np.random.default_rng(7), [np.arange(len(graph))]
    while len(groups) < parts:
        groups = [half for g in groups for half in bisect(graph, g, rng)]
    out = np.empty(len(graph), int)
    for i, g in enumerate(groups):
        out[g] = i
    return out


@dataclass
class Router:
    """A network with one hidden layer; ``probes`` parts per query."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    probes: int

    def order(self, x: np.ndarray) -> np.ndarray:
        """The parts of each row, most probable first."""
        w1, b1, w2, b2 = self.weights
        return np.argsort(-(np.maximum((x - self.mean) / self.scale @ w1 + b1, 0) @ w2 + b2), axis=1, kind="stable")


def fit(x: np.ndarray) -> Router:
    """The router of a sample of distinct vectors."""
    dims = x.shape[1] if x.ndim == 2 else 1
    parts = PARTS
    while parts > 1 and len(x) < 8 * parts:
        parts //= 2
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-12) if len(x) else (np.zeros(dims), np.ones(dims))
    rng = np.random.default_rng(11)
    weights = [rng.normal(size=(dims, HIDDEN)) * np.sqrt(2 / dims), np.zeros(HIDDEN), rng.normal(size=(HIDDEN, parts)) * np.sqrt(1 / HIDDEN), np.zeros(parts)]
    if parts == 1:
        return Router(mean, scale, weights, 1)
    with np.errstate(over="ignore", invalid="ignore"):
        graph = neighbour_graph(x, EDGES)
    part = balanced_parts(graph, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.arange(len(x)), part), 1.0)
    for j in range(graph.shape[1]):
        np.add.at(target, (np.arange(len(x)), part[graph[:, j]]), 1.0)
    target /= target.sum(axis=1, keepdims=True)
    z, moments, t = (x - mean) / scale, [(np.zeros_like(w), np.zeros_like(w)) for w in weights], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(z))
        for at in range(0, len(z), BATCH):
            rows = order[at:at + BATCH]
            a, y = z[rows], target[rows]
            h = np.maximum(a @ weights[0] + weights[1], 0)
            s = h @ weights[2] + weights[3]
            p = np.exp(s - s.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            g = (p - y) / len(rows)
            back = (g @ weights[2].T) * (h > 0)
            t += 1
            for i, d in enumerate([a.T @ back, back.sum(axis=0), h.T @ g, g.sum(axis=0)]):
                m, v = moments[i]
                m, v = 0.9 * m + 0.1 * d, 0.999 * v + 0.001 * d * d
                moments[i] = m, v
                weights[i] = weights[i] - 0.002 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    router = Router(mean, scale, weights, parts)
    order = router.order(x)
    home, place = order[:, 0], np.argsort(order, axis=1)  # place[i, p]: when query i probes part p
    when = np.sort(place[np.arange(len(x))[:, None], home[graph]].ravel())
    router.probes = int(when[min(len(when) - 1, int(np.ceil(TARGET * len(when))))]) + 1
    return router


def find(block: pd.DataFrame, queries: pd.DataFrame, k: int = K) -> pd.DataFrame:
    x, ids = matrix(block["x"], "<f8"), block["vec_id"].to_numpy()
    q, names, out = matrix(queries["q"], "<f8"), queries["query_id"].to_numpy(), []
    shift = x.mean(axis=0)
    y, square = x - shift, ((x - shift) ** 2).sum(axis=1)
    for at in range(0, len(q), TOGETHER):
        part, who = q[at:at + TOGETHER], names[at:at + TOGETHER]
        near = square - 2 * (part - shift) @ y.T
        error = 1e-9 * (square.max() + ((part - shift) ** 2).sum(axis=1))
        near[who[:, None] == ids] = np.inf
        bar = np.partition(near, k - 1, axis=1)[:, k - 1] if len(x) > k else np.full(len(part), np.inf)
        for i in range(len(part)):
            rows = np.flatnonzero((near[i] <= bar[i] + error[i]) & (ids != who[i]))
            score = np.sqrt(((x[rows] - part[i]) ** 2).sum(axis=1))
            best = np.lexsort((ids[rows], score))[:k]
            out.append(pd.DataFrame({"query_id": who[i], "vec_id": ids[rows][best], "score": score[best]}))
    return pd.concat(out, ignore_index=True)


def nearest(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of packed double vectors."""
    sample = rows.select("x").distinct().orderBy(F.xxhash64("x"), "x").limit(SAMPLE).collect()
    router = fit(matrix(pd.Series([bytes(r["x"]) for r in sample]), "<f8") if sample else np.zeros((0, 1)))

    def make():
        return lambda cols: {n: cols[n] for n in ("row", "vec_id", "x")} | {"home": router.order(matrix(pd.Series(cols["x"]), "<f8"))[:, 0].tolist()}

    homes = stage_table(map_texts(rows, make, "row long, vec_id long, x binary, home int"), "homes")
    sizes = {r["home"]: r["n"] for r in homes.groupBy("home").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = len(router.weights[3])
    cells = {p: max(1, -(-sizes.get(p, 0) // ROWS)) for p in range(parts)}
    count = F.create_map(*[F.lit(v) for p in range(parts) for v in (p, cells[p])])
    number = lambda part, cell: (part.cast("long") * F.lit(1 << 32) + cell.cast("long")).alias("block")
    dealt = homes.select(number(F.col("home"), F.pmod(F.xxhash64("row"), count[F.col("home")])), "vec_id", "x")

    def route():
        def one(cols: dict) -> dict:
            orders = router.order(matrix(pd.Series(cols["q"]), "<f8")).tolist()
            probed = []
            for order in orders:  # on, while the probed parts hold too few rows
                n = next((i for i in range(router.probes, parts) if sum(sizes.get(p, 0) for p in order[:i]) > 2 * k), parts)
                probed.append(order[:n])
            return {"query_id": cols["query_id"], "q": cols["q"], "parts": probed}

        return one

    routed = map_texts(queries, route, "query_id long, q binary, parts array<int>").withColumn("home", F.explode("parts"))
    asked = routed.withColumn("cell", F.explode(F.sequence(F.lit(0), count[F.col("home")] - 1))).select(number(F.col("home"), F.col("cell")), "query_id", "q")
    return ranked(search(dealt, asked, lambda a, b: find(a, b, k), "query_id long, vec_id long, score double"), F.col("score"), k)


def op3_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packed(read_table(spark, sf_dir, "embeddings"), lambda v: v, "<f8", zero=False)
    return nearest(rows, every(EVERY, rows))
