"""Exact top-k by inner product over an impact-ordered index.

Each block of vectors becomes postings (dimension, vector, component), cut
into segments by quantised impact, the size of the component in ``LEVELS``
steps.  A query processes segments score at a time, from the highest impact
down, adding to one accumulator per vector.  After every level a vector's
score is known up to the inner product of what is left, which the norms of the
rest bound; the k-th largest lower bound is a threshold that every member of
the top k reaches with its upper bound.  Processing stops only when this proof
leaves few possible members, and those are scored exactly; ties therefore
come out as they are.

Blocks and query groups have fixed sizes, every block is searched for every
query (the stated query set against all rows, in blocks), and each block
returns k rows per query.  Defined results: see ``vectors``; with fewer than k
candidates all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamkit.llm.common import read_table
from streamkit.llm.vectors import ROWS, every, matrix, packed, ranked, search

LEVELS, K, EVERY, SCALE = 16, 10, 100, 1024
#: Queries whose accumulators are held at once; possible members per query at which processing stops.
TOGETHER, FEW = 128, 64


class ImpactIndex:
    """Postings of one block of integer vectors, by impact level."""

    def __init__(self, x: np.ndarray):
        self.x = x
        size = np.abs(x)
        step = max(1, int(size.max(initial=0)) // LEVELS + 1)
        level = size // step
        square = x.astype(np.float64) ** 2
        left = square.sum(axis=1)
        self.levels = []
        for at in range(int(level.max(initial=0)), -1, -1):
            segments = []
            for d in range(x.shape[1]):
                rows = np.flatnonzero((level[:, d] == at) & (size[:, d] > 0))
                if len(rows):
                    segments.append((d, rows, x[rows, d].astype(np.float64)))
            left = left - np.where(level == at, square, 0).sum(axis=1)
            self.levels.append((segments, np.sqrt(np.maximum(left, 0)) * (1 + 1e-9) + 1e-6 * (at > 0)))

    def top(self, q: np.ndarray, own: np.ndarray, k: int) -> list[np.ndarray]:
        """For each query (a row of ``q``) the vectors that may be among its
        ``k`` best; ``own`` (vectors x queries) marks those that are not
        candidates."""
        n = len(self.x)
        norm = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)
        total = np.zeros((n, len(q)))
        total[own] = -np.inf
        weights = q.astype(np.float64).T.copy()
        for segments, left in self.levels:
            for d, rows, values in segments:
                total[rows] += values[:, None] * weights[d]
            slack = left[:, None] * norm
            low = total - slack
            bar = np.partition(low, n - k, axis=0)[n - k] if n > k else np.full(len(q), -np.inf)
            possible = (total + slack >= bar) & ~own
            if possible.sum(axis=0).max(initial=0) <= FEW:
                break
        return [np.flatnonzero(possible[:, i]) for i in range(len(q))]


def find(block: pd.DataFrame, queries: pd.DataFrame, k: int = K) -> pd.DataFrame:
    x, ids = matrix(block["x"], "<i8"), block["vec_id"].to_numpy()
    index, out = ImpactIndex(x), []
    q, names = matrix(queries["q"], "<i8"), queries["query_id"].to_numpy()
    for at in range(0, len(q), TOGETHER):
        part, who = q[at:at + TOGETHER], names[at:at + TOGETHER]
        for i, rows in enumerate(index.top(part, ids[:, None] == who, k)):
            score = (x[rows] * part[i]).sum(axis=1)
            best = np.lexsort((ids[rows], -score))[:k]
            out.append(pd.DataFrame({"query_id": who[i], "vec_id": ids[rows][best], "score": score[best]}))
    return pd.concat(out, ignore_index=True)


def top_k(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of packed integer vectors."""
    blocks = max(1, -(-rows.count() // ROWS))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))).select("block", "vec_id", "x")
    asked = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("block", F.col("block").cast("long"))
    found = search(dealt, asked, lambda a, b: find(a, b, k), "query_id long, vec_id long, score long")
    return ranked(found, F.desc("score"), k)


def op7_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packed(read_table(spark, sf_dir, "embeddings"), lambda v: np.floor(SCALE * v), "<i8", zero=True)
    return top_k(rows, every(EVERY, rows))
