"""Output formats with commit and abort (O5, O6 on batches and streams).

``write_using_output_format`` hands records on as a task goes, so a task that
fails half way and runs again has written some of them twice.  Here a task writes
its records into a part of its own that nobody reads yet, and only the commit of
the whole job, or of a micro-batch, names the parts that count:

* a task's part is ``parts/<task>-<unique>``; a task that fails removes it, and
  what a lost executor leaves is named by no commit;
* a commit writes ``epochs/<epoch>.json``, the list of the epoch's parts, under a
  temporary name, and moves it to its place in one step;
* an epoch is committed once: a micro-batch that runs again after a failure
  between its commit and Spark's own record of it finds its epoch and drops its
  new parts, and so does a batch job repeated under the same epoch;
* an abort removes the parts of the tasks that had ended.

So each record is read back once, whatever fails.  The driver handles names of
parts, never records.  The folder is shared and opened by ``pyarrow.fs`` (local,
hdfs, s3, gs); parts without a commit may be removed when no job runs.  An
empty frame commits an epoch of empty parts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

from streamkit.session import ship_package
from streamkit.sinks.custom import OutputFormat
from streamkit.sources.ordered import _open


class StagedFormat(OutputFormat):
    """An ``OutputFormat`` whose records go to ``self.out``, the task's part (a
    binary file, there from ``configure`` to ``close``).  The number of tasks
    given to ``open`` is 0, as it is not known before the job ends."""

    out = None


class LineFormat(StagedFormat):
    """The first column's text, one line each; null is an empty line."""

    def write_record(self, record) -> None:
        self.out.write((("" if record[0] is None else str(record[0])) + "\n").encode())


@dataclass
class Staged(WriterCommitMessage):
    part: str
    records: int


class _Transaction:
    """What a batch and a stream have in common."""

    def __init__(self, folder: str, make: Callable[[], StagedFormat], conf: dict):
        self.folder, self.make, self.conf = folder, make, conf

    def write(self, rows: Iterator[Row]) -> Staged:
        files, root = _open(self.folder)
        task = TaskContext.get().partitionId()
        part, n = f"{task:06d}-{uuid.uuid4().hex}", 0
        path = f"{root}/parts/{part}"
        try:
            with files.open_output_stream(path) as out:
                fmt = self.make()
                fmt.out = out
                fmt.configure(self.conf)
                fmt.open(task, 0)
                try:
                    for row in rows:
                        fmt.write_record(row)
                        n += 1
                finally:
                    fmt.close()
        except BaseException:
            files.delete_file(path)
            raise
        return Staged(part, n)

    def publish(self, messages, epoch: str) -> None:
        files, root = _open(self.folder)
        target = f"{root}/epochs/{epoch}.json"
        if files.get_file_info(target).is_file:
            self.discard(messages)
            return
        new = f"{root}/epochs/.{epoch}-{uuid.uuid4().hex}"
        with files.open_output_stream(new) as out:
            out.write(json.dumps({"parts": [[m.part, m.records] for m in messages if m is not None]}).encode())
        files.move(new, target)

    def discard(self, messages) -> None:
        files, root = _open(self.folder)
        for message in messages:
            if message is not None:
                files.delete_file(f"{root}/parts/{message.part}")


class _BatchWriter(DataSourceWriter):
    def __init__(self, transaction: _Transaction, epoch: str):
        self.transaction, self.epoch = transaction, epoch

    def write(self, iterator: Iterator[Row]) -> Staged:
        return self.transaction.write(iterator)

    def commit(self, messages) -> None:
        self.transaction.publish(messages, self.epoch)

    def abort(self, messages) -> None:
        self.transaction.discard(messages)


class _StreamWriter(DataSourceStreamWriter):
    def __init__(self, transaction: _Transaction, epoch: str):
        self.transaction, self.epoch = transaction, epoch

    def write(self, iterator: Iterator[Row]) -> Staged:
        return self.transaction.write(iterator)

    def commit(self, messages, batchId: int) -> None:
        self.transaction.publish(messages, f"{self.epoch}-{batchId:012d}")

    def abort(self, messages, batchId: int) -> None:
        self.transaction.discard(messages)


def _sink(spark: SparkSession, transaction: _Transaction, epoch: str) -> str:
    """Register a data source of this transaction; its name in the session."""
    own = f"transactional_{uuid.uuid4().hex[:12]}"

    class TransactionalSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return own

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return _BatchWriter(transaction, epoch)

        def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
            return _StreamWriter(transaction, epoch)

    spark.dataSource.register(TransactionalSink)
    return own


def write_transactional(df: DataFrame, folder: str, make: Callable[[], StagedFormat] = LineFormat, epoch: str = "batch", conf: dict | None = None):
    """Write every row through a fresh ``StagedFormat`` per task, all or nothing.
    A stream gives its ``DataStreamWriter``, each micro-batch an epoch of its own;
    a batch is written at once.  ``epoch`` names the batch, or the stream."""
    spark = df.sparkSession
    ship_package(spark)
    files, root = _open(folder)
    for name in ("parts", "epochs"):
        files.create_dir(f"{root}/{name}", recursive=True)
    name = _sink(spark, _Transaction(folder, make, dict(conf or {})), epoch)
    if df.isStreaming:
        return df.writeStream.format(name)
    df.write.format(name).mode("append").save()
    return None


def committed_parts(folder: str) -> dict[str, list[tuple[str, int]]]:
    """(part, records) of each committed epoch."""
    from pyarrow.fs import FileSelector  # noqa: PLC0415

    files, root = _open(folder)
    out = {}
    for info in files.get_file_info(FileSelector(f"{root}/epochs")):
        if info.extension == "json" and not info.base_name.startswith("."):
            with files.open_input_stream(info.path) as source:
                out[info.base_name.removesuffix(".json")] = [tuple(p) for p in json.loads(source.read())["parts"]]
    return out


def read_committed(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of all committed parts, column ``value``."""
    paths = [f"{folder}/parts/{part}" for parts in committed_parts(folder).values() for part, n in parts if n]
    return spark.read.text(paths) if paths else spark.createDataFrame([], "value string")
