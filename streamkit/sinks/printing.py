"""Printing sinks (O1, O2).

Batch: every task prints its own rows, prefixed by ``<task>>`` when more
than one task prints (as a parallel print does), to its stdout / stderr —
executor logs on a cluster; nothing is funnelled through the driver.
Streaming: the console sink.
"""

from __future__ import annotations

import sys

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _printer(stream_name: str, prefix: bool):
    def emit(rows):
        out = getattr(sys, stream_name)
        ctx = TaskContext.get()
        tag = f"{ctx.partitionId() + 1}> " if prefix and ctx is not None else ""
        for row in rows:
            out.write(f"{tag}{row.value}\n")
        out.flush()

    return emit


def rendered(df: DataFrame) -> DataFrame:
    """Each row as the text that is printed: a value as Spark casts it to a
    string (``true``, ``null``), several as ``(a,b)``; column ``value``."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("null")) for c in df.columns]
    return df.select((parts[0] if len(parts) == 1 else F.concat(F.lit("("), F.concat_ws(",", *parts), F.lit(")"))).alias("value"))


def print_rows(df: DataFrame, parallelism: int | None = None, stream: str = "stdout"):
    """Print every row (``parallelism=1``: one printing task, no prefix)."""
    if df.isStreaming:
        return df.writeStream.format("console").option("truncate", "false")
    out = df.coalesce(parallelism) if parallelism else df
    prefix = (parallelism or out.rdd.getNumPartitions()) > 1
    rendered(out).foreachPartition(_printer(stream, prefix))
    return None


def print_to_err(df: DataFrame, parallelism: int | None = None):
    """Print every row to standard error."""
    if df.isStreaming:
        def each_batch(batch, _batch_id):
            rendered(batch).foreachPartition(_printer("stderr", True))

        return df.writeStream.foreachBatch(each_batch)
    return print_rows(df, parallelism, "stderr")
