"""Per-record operators on streams with their state in tables.

``applyInPandasWithState`` gives a key to one task, which gathers the key's rows
of the micro-batch.  Here every micro-batch is a bounded frame: the batch
operator runs on it, with its order cut into blocks, so a key that holds most
rows fills all tasks and no row passes through Python.  What later micro-batches
need of a key (the scans' totals, the last rows of count windows) is one summary
row, kept in a ``KeyTable`` under the shared folder.

    counts = KeyedStream(folder, lambda batch, state: rolling_sum(batch, "user", "id", "cents", state=state))
    counts.run(stream)          # a foreachBatch query
    counts.result(spark)        # the rows of all batches

Exactly once: a micro-batch writes its result and its state to folders of its
own, named by the batch's number, and reads only state of lower numbers.  A batch
that runs again, after a lost driver, overwrites both with the same rows.

Tables are versioned by batch: a batch writes the keys it changes, and every
``SNAPSHOT`` batches all keys; a read takes the newest row of each key since the
last snapshot.  Versions before it are never read again and may be removed.
Across micro-batches the order is arrival order, as for every stream.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamkit.operators.scan import KEY

#: Batches from one write of all keys to the next.
SNAPSHOT = 16
_VERSION = "_version"


class KeyTable:
    """One row (KEY, values) per key, as of the batches before ``batch_id``."""

    def __init__(self, spark: SparkSession, folder: str, batch_id: int):
        self.spark, self.folder, self.batch_id = spark, folder, batch_id

    def _path(self, batch_id: int) -> str:
        return f"{self.folder}/batch={batch_id}"

    def newest(self) -> DataFrame | None:
        """The newest row of each key, None before the first batch."""
        if self.batch_id == 0:
            return None
        last = self.batch_id - 1
        base = last - last % SNAPSHOT
        versions = self.spark.read.schema(self.spark.read.parquet(self._path(last)).schema).parquet(*[self._path(b) for b in range(base, self.batch_id)])
        values = [c for c in versions.columns if c not in (KEY, _VERSION)]
        newest = versions.groupBy(KEY).agg(F.max_by(F.struct(*values), _VERSION).alias("_row"))
        return newest.select(KEY, *[F.col("_row")[c].alias(c) for c in values])

    def put(self, rows: DataFrame) -> None:
        """The keys that this batch changes; a snapshot adds all others."""
        held = self.newest() if self.batch_id % SNAPSHOT == 0 else None
        if held is not None:
            rows = rows.unionByName(held.join(rows.select(KEY), KEY, "left_anti"))
        rows.withColumn(_VERSION, F.lit(self.batch_id).cast("long")).write.mode("overwrite").parquet(self._path(self.batch_id))


class StreamState:
    """The key tables that an operator keeps, by name."""

    def __init__(self, spark: SparkSession, folder: str, batch_id: int):
        self.spark, self.folder, self.batch_id = spark, folder, batch_id

    def table(self, name: str) -> KeyTable:
        return KeyTable(self.spark, os.path.join(self.folder, "state", name), self.batch_id)


class KeyedStream:
    """``operator(batch, state)`` on every micro-batch of a stream.

    ``folder`` is one that driver and executors share; it holds the results,
    the state and the query's checkpoint, and a query that is started on it
    again goes on where it ended."""

    def __init__(self, folder: str, operator: Callable[[DataFrame, StreamState], DataFrame]):
        self.folder, self.operator = folder, operator

    def process(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # cut points, totals and rows read it; a lost part is read from the source again
        try:
            out = self.operator(batch, StreamState(batch.sparkSession, self.folder, batch_id))
            out.write.mode("overwrite").parquet(f"{self.folder}/results/batch={batch_id}")
        finally:
            batch.unpersist()

    def start(self, stream: DataFrame, trigger: dict | None = None):
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", os.path.join(self.folder, "checkpoint"))
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def run(self, stream: DataFrame) -> None:
        """Everything available now."""
        query = self.start(stream)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()

    def result(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/results").drop("batch")
