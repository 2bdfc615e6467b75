"""Starting and draining streaming queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Row

from streamkit.session import streaming_checkpoint


def start_query(
    df: DataFrame,
    name: str,
    output_mode: str = "append",
    sink: str = "console",
    trigger: dict | None = None,
    options: dict[str, str] | None = None,
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
    checkpoint_name: str | None = None,
):
    """Start ``df`` with a checkpoint under the shared checkpoint folder.
    A restarted query with the same name resumes from its checkpoint."""
    writer = df.writeStream.queryName(name).outputMode(output_mode)
    writer = writer.option("checkpointLocation", streaming_checkpoint(df.sparkSession, checkpoint_name or name))
    if foreach_batch is not None:
        writer = writer.foreachBatch(foreach_batch)
    else:
        writer = writer.format(sink)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()


def run_available(df: DataFrame, name: str, output_mode: str = "append", progress: list | None = None
                  ) -> list[tuple[int, list[Row]]]:
    """Process everything available now and return ``(batch_id, rows)`` per
    micro-batch.  For tests and small replays only: rows come to the driver.
    ``progress`` (a list) receives the query's progress reports."""
    batches: list[tuple[int, list[Row]]] = []

    def capture(batch: DataFrame, batch_id: int):
        batches.append((batch_id, batch.collect()))

    # a fresh checkpoint per run: a replay always starts from the beginning
    query = start_query(df, name, output_mode, foreach_batch=capture, checkpoint_name=f"{name}-{uuid.uuid4().hex[:12]}")
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    if progress is not None:
        progress.extend(query.recentProgress)
    return batches


def rows_dropped_by_watermark(progress: list) -> int:
    """Late rows dropped by the stateful operators over all reported batches."""
    total = 0
    for report in progress:
        for op in report.get("stateOperators", []) if isinstance(report, dict) else report.stateOperators:
            value = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark
            total += value or 0
    return total
