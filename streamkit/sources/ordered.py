"""A bounded table as a stream in the order of its event time.

The file source admits files by their modification time, which says nothing
about the times inside, so a replay of shuffled part files needs a watermark
that lags by the whole table and a state that holds every window.
``time_ordered_stream`` instead

1. writes the table once as part files that are disjoint ranges of the event
   time (``repartitionByRange``; rows of one time may fill several parts, so a
   hot instant is no hot part, and rows without a time are in the first), and
2. reads them through ``TimeOrderedSource``, a Python data source whose
   micro-batches are the next parts in that order up to a number of bytes, each
   part read by a task of its own as Arrow batches.

No row of a later batch is earlier than one of a batch before, so nothing is
late under any watermark, and the state holds the windows of about one batch
and the watermark's delay.  After the last part comes one closing row, whose
time is after all others and whose other columns are null: the watermark passes
every real window, and the closing row's own window stays open.

Offsets are numbers of parts.  A restarted query goes on after the last part
that its checkpoint names, and a batch that runs again reads the same parts.
The folder must outlive the query.  An empty table gives the closing row only.
Parts are opened by ``pyarrow.fs``, for local, hdfs, s3 and gs folders.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: The closing row's event time, 9999-01-01 00:00:00 UTC, in seconds.
END_SECONDS = 253_370_764_800
#: Rows of a part; a table of fewer parts than its batches have tasks gets more.
PART_ROWS = 2_000_000
#: Bytes of a micro-batch for each task that can run at a time.
TASK_BYTES = 128 << 20
#: The weight of a micro-batch's rows, where they have one, for each such task.
TASK_WEIGHT = 16 << 20
#: Rows of an Arrow batch handed to Spark.
ROWS = 2_048
#: Whether a query's shuffle files are removed at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ROW = "_to_row"


def _open(folder: str):
    """(file system, path) of a Hadoop-style folder name."""
    from pyarrow import fs  # noqa: PLC0415

    if folder.startswith("file:"):
        folder = "/" + folder[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


class TimeOrderedReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.folder, self.time_col, self.schema = options["folder"], options["timecol"], schema
        self.batches, self.batch_bytes = int(options["batches"]), int(options["batchbytes"])
        self.at = 0

    @cached_property
    def files(self) -> list[tuple[str, int]]:
        """(part file, its bytes) by name, which is their order of time (driver only)."""
        from pyarrow.fs import FileSelector  # noqa: PLC0415

        files, path = _open(self.folder)
        found = [(info.path, info.size or 0) for info in files.get_file_info(FileSelector(path))]
        return sorted(f for f in found if posixpath.basename(f[0]).startswith("part-") and f[0].endswith(".parquet"))

    def initialOffset(self) -> dict:
        return {"part": 0}

    def latestOffset(self) -> dict:
        limit, size = min(self.batch_bytes, -(-sum(n for _, n in self.files) // self.batches)), 0
        most = self.at + -(-len(self.files) // self.batches)  # parts that compress well are not taken for small ones
        while self.at < min(most, len(self.files)) and (size == 0 or size < limit):
            size += max(1, self.files[self.at][1])
            self.at += 1
        if self.at == len(self.files):
            self.at += 1  # the closing row, with the last parts
        return {"part": self.at}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.at = max(self.at, end["part"])  # a restarted query names its last offset here
        closing = [InputPartition(None)] if start["part"] <= len(self.files) < end["part"] else []
        return [InputPartition(path) for path, _ in self.files[start["part"]:end["part"]]] + closing

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow as pa  # noqa: PLC0415
        import pyarrow.parquet as pq  # noqa: PLC0415
        from pyspark.sql.pandas.types import to_arrow_schema  # noqa: PLC0415

        arrow = to_arrow_schema(self.schema)
        if partition.value is None:
            columns = []
            for field, kind in zip(self.schema.fields, arrow):
                scale = 1 if isinstance(field.dataType, T.NumericType) else 1_000_000
                columns.append(pa.array([END_SECONDS * scale]).cast(kind.type) if field.name == self.time_col else pa.nulls(1, kind.type))
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)
            return
        files, _ = _open(self.folder)
        with files.open_input_file(partition.value) as source:
            table = pq.ParquetFile(source, coerce_int96_timestamp_unit="us")
            for batch in table.iter_batches(batch_size=ROWS):
                yield pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) for f in arrow], schema=arrow)


class TimeOrderedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "time_ordered"

    def streamReader(self, schema: T.StructType) -> TimeOrderedReader:
        return TimeOrderedReader({k.lower(): v for k, v in self.options.items()}, schema)


def _register(spark: SparkSession) -> str:
    """The name that the source has in this session.  Every stream takes a name
    of its own: the sessions that Spark clones for running streams keep the
    names of theirs, and a name they keep cannot be registered again."""
    own = f"{TimeOrderedSource.name()}_{uuid.uuid4().hex[:12]}"
    spark.dataSource.register(type("OwnTimeOrderedSource", (TimeOrderedSource,), {"name": classmethod(lambda cls: own)}))
    return own


def time_ordered_stream(table: DataFrame, time_col: str, folder: str, batches: int = 1, batch_bytes: int | None = None, weight: Column | None = None) -> DataFrame:
    """``table`` (a bounded frame) as a stream in the order of ``time_col`` (a
    time, or seconds as a number), in about ``batches`` micro-batches, and more
    where one would pass ``batch_bytes`` (default: 128 MB of Parquet for each task
    that can run at a time).  Where the state holds rows and not sums of them,
    ``weight`` is the bytes that it holds of a row: the rows of a micro-batch weigh
    about 16 MB for each task at most, whatever their Parquet takes.  The parts are
    written to ``folder``, which must be new and shared with the executors.  Run it
    with ``drain_ordered`` or any trigger but ``availableNow``, which would end
    after the first micro-batch."""
    spark = table.sparkSession
    tasks = spark.sparkContext.defaultParallelism
    count, weighs = table.agg(F.count(F.lit(1)), F.sum(F.lit(0) if weight is None else weight)).first()
    batches = max(batches, -(-(weighs or 0) // (tasks * TASK_WEIGHT)))
    parts = max(tasks * batches, -(-count // PART_ROWS))
    rows = table.withColumn(_ROW, F.monotonically_increasing_id())
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")  # a copy of the table, else held while the stream runs
    try:
        rows.repartitionByRange(parts, time_col, _ROW).drop(_ROW).write.option("compression", "zstd").parquet(folder)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    options = {"folder": folder, "timeCol": time_col, "batches": str(batches), "batchBytes": str(batch_bytes or tasks * TASK_BYTES)}
    return spark.readStream.format(_register(spark)).schema(table.schema).options(**options).load()
