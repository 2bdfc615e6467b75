"""Vectors as packed rows, and searches of query groups in row blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamkit.llm.common import map_texts, stage_table

#: Rows in a block, queries in a group; a task holds one of each.
ROWS, QUERIES = 8192, 2048


def packed(table: DataFrame, change: Callable[[np.ndarray], np.ndarray], dtype: str, zero: bool, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(row, vec_id, x): the usable vectors as bytes of ``dtype`` after
    ``change``.  Vectors that are null or empty, or hold null or non-finite
    components (or zeros only, unless ``zero``), and rows without id take no
    part; of several lengths the most frequent one (the larger, if tied) does."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = table.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.alias("v"))
    vector = F.col("v")
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size(vector) > 0) & ~bad)
    if not zero:
        rows = rows.where(F.exists(vector, lambda v: v != 0))

    def make():
        def pack(rows: dict) -> dict:
            return {"row": rows["row"], "vec_id": rows["vec_id"], "size": [len(v) for v in rows["v"]],
                    "x": [change(np.array(v, np.float64)).astype(dtype).tobytes() for v in rows["v"]]}

        return pack

    out = stage_table(map_texts(rows, make, "row long, vec_id long, size int, x binary"), "vectors")
    sizes = out.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    return out.where(F.col("size") == (sizes[0]["size"] if sizes else 0)).select("row", "vec_id", "x")


def every(divisor: int, rows: DataFrame) -> DataFrame:
    """The queries (query_id, q): ids divisible by ``divisor``.  An id that
    is stored several times asks once, with its smallest vector."""
    return rows.where(F.col("vec_id") % divisor == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("x").alias("q"))


def matrix(column: pd.Series, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype).reshape(len(column), -1)


def search(rows: DataFrame, queries: DataFrame, find: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``find`` on each block of ``rows`` (block, ...) with each group of the
    ``queries`` (block, query_id, ...) that are sent to that block.  Blocks are
    read once per group of ``QUERIES`` queries; both sides of a call are
    bounded whatever the tables' sizes."""
    most = queries.groupBy("block").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    groups = max(1, -(-most // QUERIES))
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    queries = queries.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int"))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if len(left) == 0 or len(right) == 0:
            return pd.DataFrame()
        return find(left, right)

    return rows.groupBy("block", "part").cogroup(queries.groupBy("block", "part")).applyInPandas(run, schema)


def ranked(found: DataFrame, best, k: int) -> DataFrame:
    """The ``k`` first rows (vec_id, score) of each query, with ``rank`` from 1."""
    order = Window.partitionBy("query_id").orderBy(best, "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
