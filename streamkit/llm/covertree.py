"""Hard negatives from cover trees over norm-augmented candidates.

An anchor's positives are its best rows of the same label, by integer inner
product; the hard negatives of a positive are the best rows of other labels
whose score lies in a window below the positive's.

1. Candidates are dealt by hash into blocks of bounded size, whatever their
   values.  Each block becomes a cover tree, written once as a table.  Every
   vector gets one more component, ``sqrt(M^2 - |x|^2)`` with ``M`` the largest
   norm of the block, so that all lie on one sphere: then the largest inner product
   with an anchor (whose own added component is 0) is the smallest angle.
2. Level by level a node's rows are covered by balls of a radius that shrinks by
   ``BASE``, around centres further apart than that radius, down to ``LEAF`` rows
   or equal vectors.  A node keeps its centre and the measured covering radius; the
   angle that the radius spans on the sphere bounds the inner products of all
   rows below it from above and from below.
3. A search is a best-first descent by the upper bound.  A node is skipped when its
   bounds lie outside all windows asked for, or cannot reach the ``k`` rows that
   each already has.  The leaves of a node are taken in order of their bounds, some
   rows at a time, and those still open are scored exactly, in integers.
4. Every tree is searched for every anchor (the stated query set against all rows,
   in blocks): first for positives, whose overall scores then fix the windows of
   the second search.  A block returns k rows per anchor or window.

Components are ``floor(SCALE * x)`` and scores exact 64-bit integers; a vector
whose squared norm passes 2^62 could overflow them and is refused with an error.

Defined results.  Rows with null id, label or vector, or with null or non-finite
components take no part; zero vectors do.  Vectors of different lengths are never
compared: each length has its own blocks.  An id stored several times asks once, with its
smallest (label, vector); as candidates its rows count one by one, and none
of them is a candidate for the id itself.  Ties go to the smaller id.  An anchor without
other rows of its label, and a window without rows, give no rows.  An empty table
gives an empty result; further columns play no part, whatever their names.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamkit.llm.common import map_texts, read_table, stage_table

#: Positives of an anchor, negatives of a positive, ids that are anchors, scale of components.
POSITIVES, NEGATIVES, EVERY, SCALE = 5, 5, 100, 256
#: A negative's score in hundredths of the positive's: from LOW to HIGH.
LOW, HIGH = 80, 100
#: Components and rows of a block at most, on average, and anchors that are sent to a block together.
COMPONENTS, ROWS, TOGETHER = 1 << 20, 8192, 2048
#: Ratio of a level's radius to the next one's, and rows of a leaf.
BASE, LEAF = 1.25, 48
#: Rows of leaves that are scored together, at first and at most.
STEP, STEPS = 64, 1024
#: Largest squared norm: products of two such vectors fit in 64 bits.
SQUARE = 1 << 62


def usable(table: DataFrame, label: Column | None = None, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, label, size, x): the rows that take part, x as little-endian 64-bit integers."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"), vector.alias("v"))
    bad = F.exists("v", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad)
    if label is not None:
        rows = rows.withColumn("label", label)
    square = F.aggregate("v", F.lit(0.0), lambda a, v: a + F.floor(v * SCALE).cast("double") * F.floor(v * SCALE).cast("double"))
    far = F.exists("v", lambda v: F.abs(v) >= 2.0 ** 31 / SCALE)
    checked = F.when(far, F.lit(True)).otherwise(square >= float(SQUARE))
    refuse = F.raise_error(F.concat(F.lit("inner products of vector "), F.col("vec_id").cast("string"), F.lit(" may not fit in 64 bits")))
    rows = rows.withColumn("v", F.when(checked, refuse.cast("array<double>")).otherwise(F.col("v")))

    def make():
        def pack(rows: dict) -> dict:
            x = [np.floor(SCALE * np.array(v, np.float64)).astype("<i8").tobytes() for v in rows["v"]]
            return {"vec_id": rows["vec_id"], "label": rows["label"], "size": [len(v) for v in rows["v"]], "x": x}

        return pack

    return map_texts(rows, make, "vec_id long, label long, size int, x binary")


# -- one block ---------------------------------------------------------------


def ints(data: bytes, size: int, rows: int) -> np.ndarray:
    return np.frombuffer(data, "<i8").reshape(rows, size)


def exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products; in floating point where all partial sums are
    integers that it holds exactly."""
    if x.shape[1] * float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) < 2.0 ** 53:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return (x * q).sum(axis=1)


def build(x: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(order, nodes) of the cover tree over the rows of ``x``: a node covers
    the rows ``order[lo:hi]`` within ``radius`` of row ``centre``; its children
    are the nodes from ``first``, ``many`` of them (0: a leaf)."""
    square = (x.astype(np.float64) ** 2).sum(axis=1)
    points = np.hstack([x.astype(np.float64), np.sqrt(np.maximum(square.max(initial=0) - square, 0))[:, None]])

    def distances(rows: np.ndarray, centre: int) -> np.ndarray:
        return np.sqrt(((points[rows] - points[centre]) ** 2).sum(axis=1))

    order = np.arange(len(x))
    centre, lo, hi, first, many, radius = [0], [0], [len(x)], [0], [0], [float(distances(order, 0).max(initial=0))]
    # radii are tried from the node's own measured one, as levels in between would have one child
    todo = [0]
    while todo:
        node = todo.pop()
        a, b = lo[node], hi[node]
        if b - a <= LEAF or radius[node] == 0:
            continue
        rows, reach = order[a:b], radius[node] / BASE
        far, parts, c = distances(rows, centre[node]), [], centre[node]
        while True:
            near = far <= reach
            parts.append((c, rows[near], float(far[near].max(initial=0))))
            rows = rows[~near]
            if not len(rows):
                break
            c = int(rows[0])
            far = distances(rows, c)
        first[node], many[node] = len(lo), len(parts)
        for c, mine, r in parts:
            order[a:a + len(mine)] = mine
            for column, value in ((centre, c), (lo, a), (hi, a + len(mine)), (first, 0), (many, 0), (radius, r)):
                column.append(value)
            todo.append(len(lo) - 1)
            a += len(mine)
    nodes = {"centre": centre, "lo": lo, "hi": hi, "first": first, "many": many}
    return order, {k: np.array(v, np.int64) for k, v in nodes.items()} | {"radius": np.array(radius)}


class CoverTree:
    """The tree of one block, its rows in tree order."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, nodes: dict[str, np.ndarray]):
        self.ids, self.labels, self.x, self.nodes = ids, labels, x, nodes
        first, many, leaves = nodes["first"], nodes["many"], np.flatnonzero(nodes["many"] == 0)
        parent = np.zeros(len(many), np.int64)
        inner = np.flatnonzero(many)
        for n in inner:
            parent[first[n]:first[n] + many[n]] = n
        leaves = leaves[np.argsort(nodes["lo"][leaves])]
        #: the leaf of each row, the inner children of each node, and the rows of its leaves
        self.leaf = np.repeat(leaves, (nodes["hi"] - nodes["lo"])[leaves])
        self.inner = {int(n): (c := np.arange(first[n], first[n] + many[n]))[many[c] > 0] for n in inner}
        above = parent[self.leaf]
        by = np.argsort(above, kind="stable")
        owners, starts = np.unique(above[by], return_index=True)
        self.rows = dict(zip(owners.tolist(), np.split(by, starts[1:])))
        self.norm = float(np.sqrt((x.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))
        self.spread = 2 * np.arcsin(np.minimum(1.0, nodes["radius"] / (2 * self.norm))) if self.norm else np.zeros(len(nodes["radius"]))
        self.centres = x[nodes["centre"]].astype(np.float64)

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product with ``q`` below each node."""
        size = float(np.sqrt((q.astype(np.float64) ** 2).sum())) * self.norm
        if size == 0:
            return np.zeros(len(self.spread)), np.zeros(len(self.spread))
        angle = np.arccos(np.clip(self.centres @ q.astype(np.float64) / size, -1, 1))
        slack = 1e-6 * size + 1e-6
        return size * np.cos(np.minimum(np.pi, angle + self.spread)) - slack, size * np.cos(np.maximum(0, angle - self.spread)) + slack

    def search(self, q: np.ndarray, may: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
        """For each window (low, high) the ``k`` best rows that ``may`` marks,
        as (scores, ids), and the number of rows that were scored."""
        least, most = self.bounds(q)
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in low]
        bar = low.copy()  # what a row must score to be among the k of a window

        def open_(nodes: np.ndarray) -> np.ndarray:
            """Whether some window may still gain a row below each node."""
            return ((np.minimum(most[nodes][:, None], high) >= bar) & (least[nodes][:, None] <= high)).any(axis=1)

        def take(score: np.ndarray, ids: np.ndarray) -> None:
            near = score >= bar.min()
            score, ids = score[near], ids[near]
            for i in range(len(low)) if len(score) else ():
                good = (score >= bar[i]) & (score >= low[i]) & (score <= high[i])
                if good.any():
                    s, names = np.concatenate([best[i][0], score[good]]), np.concatenate([best[i][1], ids[good]])
                    order = np.lexsort((names, -s))[:k]
                    best[i] = (s[order], names[order])
                    if len(order) == k:
                        bar[i] = s[order[-1]]

        heap, scored = [(-most[0], 0)] if len(self.ids) else [], 0
        while heap:
            _, node = heapq.heappop(heap)
            if not open_(np.array([node]))[0]:
                continue
            inner = self.inner.get(node, np.zeros(0, np.int64))
            for n in inner[open_(inner)].tolist():
                heapq.heappush(heap, (-most[n], n))
            rows = self.rows.get(node, np.zeros(0, np.int64))
            rows = rows[may[rows]]
            rows, step = rows[np.argsort(-most[self.leaf[rows]], kind="stable")], STEP
            while len(rows):
                now = rows[:step]
                now = now[open_(self.leaf[now])]
                take(exact(self.x[now], q), self.ids[now])
                scored += len(now)
                rows, step = rows[step:], min(2 * step, STEPS)
        return best, scored


# -- all blocks ---------------------------------------------------------------


def plant(rows: DataFrame) -> DataFrame:
    """``rows`` have a stored number ``row``.  One row per block: (size, block, parts, ids, labels, x, and the nodes'
    columns), all in tree order; ``parts`` is the number of anchor groups."""
    sizes = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("vec_id") % EVERY == 0, 1)).alias("asked"))
    most = F.greatest(F.least(F.lit(ROWS), F.floor(F.lit(COMPONENTS) / F.greatest("size", F.lit(1)))), F.lit(64))
    sizes = sizes.select("size", F.ceil(F.col("n") / most).cast("int").alias("blocks"), F.greatest(F.ceil(F.col("asked") / TOGETHER), F.lit(1)).cast("int").alias("parts"))
    dealt = rows.join(sizes, "size").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))

    def grow(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["vec_id", "label"], kind="stable")
        size = int(block["size"].iloc[0])
        x = ints(b"".join(block["x"]), size, len(block))
        order, nodes = build(x)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        nodes["centre"] = place[nodes["centre"]]
        columns = {"ids": block["vec_id"].to_numpy(np.int64)[order], "labels": block["label"].to_numpy(np.int64)[order], "x": x[order]} | nodes
        fixed = {n: [int(block[n].iloc[0])] for n in ("size", "block", "blocks", "parts")}
        return pd.DataFrame(fixed | {k: pd.Series([np.ascontiguousarray(v).tobytes()], dtype=object) for k, v in columns.items()})

    columns = "ids binary, labels binary, x binary, centre binary, lo binary, hi binary, first binary, many binary, radius binary"
    return stage_table(dealt.groupBy("size", "block").applyInPandas(grow, f"size int, block int, blocks int, parts int, {columns}"), "trees")


def tree(row: pd.Series) -> CoverTree:
    ids = np.frombuffer(row["ids"], "<i8")
    nodes = {k: np.frombuffer(row[k], "<i8") for k in ("centre", "lo", "hi", "first", "many")} | {"radius": np.frombuffer(row["radius"], "<f8")}
    return CoverTree(ids, np.frombuffer(row["labels"], "<i8"), ints(row["x"], int(row["size"]), len(ids)), nodes)


def ask(trees: DataFrame, asked: DataFrame, same: bool, k: int) -> DataFrame:
    """(anchor_id, nth, vec_id, score): per window ``nth`` of an anchor the ``k`` best rows of its own label, or of
    others.  ``asked``: (anchor_id, label, size, q, windows: array of (nth, low, high))."""
    cells = trees.select("size", "blocks", "parts").distinct()
    part = F.pmod(F.xxhash64("anchor_id"), F.col("parts")).cast("int").alias("part")
    sent = asked.join(cells, "size").select(asked["size"], F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), part, "anchor_id", "label", "q", "windows")
    copies = trees.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def find(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        columns = {"anchor_id": [], "nth": [], "vec_id": [], "score": []}
        if len(block) and len(asked):
            grown = tree(block.iloc[0])
            for anchor, label, q, windows in zip(asked["anchor_id"], asked["label"], asked["q"], asked["windows"]):
                may = (grown.labels == label) == same
                may &= grown.ids != anchor
                low, high = (np.array([w[n] for w in windows], np.int64) for n in ("low", "high"))
                found, _ = grown.search(np.frombuffer(q, "<i8"), may, low, high, k)
                for w, (scores, ids) in zip(windows, found):
                    columns["anchor_id"].append(np.full(len(ids), anchor))
                    columns["nth"].append(np.full(len(ids), w["nth"]))
                    columns["vec_id"].append(ids)
                    columns["score"].append(scores)
        return pd.DataFrame({n: np.concatenate([np.zeros(0, np.int64), *c]) for n, c in columns.items()})

    found = copies.groupBy("size", "block", "part").cogroup(sent.groupBy("size", "block", "part")).applyInPandas(find, "anchor_id long, nth long, vec_id long, score long")
    order = Window.partitionBy("anchor_id", "nth").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) of the ``usable`` rows."""
    rows = stage_table(rows.withColumn("row", F.monotonically_increasing_id()), "candidates")
    trees = plant(rows)
    first = F.min(F.struct("label", "size", "x")).alias("one")
    anchors = rows.where(F.col("vec_id") % EVERY == 0).groupBy(F.col("vec_id").alias("anchor_id")).agg(first)
    anchors = anchors.select("anchor_id", "one.label", "one.size", F.col("one.x").alias("q"))

    def window(nth: Column, low: Column, high: Column) -> Column:
        return F.struct(nth.cast("long").alias("nth"), low.cast("long").alias("low"), high.cast("long").alias("high"))

    whole = F.array(window(F.lit(0), F.lit(-SQUARE), F.lit(SQUARE)))
    best = stage_table(ask(trees, anchors.withColumn("windows", whole), True, positives).select(
        "anchor_id", F.col("rank").cast("long").alias("nth"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # 100 * negative <= 100 * positive, and 100 * negative >= 80 * positive rounded up, in decimals
    score = F.col("positive_score").cast("decimal(20,0)")
    low, high = F.ceil(score * LOW / HIGH).cast("long"), F.col("positive_score")
    asked = best.where(low <= high).groupBy("anchor_id").agg(F.array_sort(F.collect_list(window(F.col("nth"), low, high))).alias("windows"))
    found = ask(trees, asked.join(anchors, "anchor_id"), False, negatives)
    return found.join(best, ["anchor_id", "nth"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(usable(read_table(spark, sf_dir, "embeddings"), moved))


ORACLE_SQL = """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.x, c.x) AS BIGINT) AS score
        FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
    ), positive AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score
        FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
    FROM positive p JOIN scored s USING (anchor_id)
    WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
    QUALIFY row_number() OVER w <= 5
"""
