"""User output formats and the socket sink.

``OutputFormat`` is the lifecycle a custom sink implements: ``configure``
once, then per task ``open(task_number, num_tasks)``, ``write_record`` per
row and ``close``.  It runs inside the tasks (``foreachPartition`` in batch,
the same for each micro-batch in streaming), so it scales with the data.
"""

from __future__ import annotations

import socket
from collections.abc import Callable

from pyspark import TaskContext
from pyspark.sql import DataFrame


class OutputFormat:
    def configure(self, conf: dict) -> None:  # pragma: no cover - default no-op
        pass

    def open(self, task_number: int, num_tasks: int) -> None:  # pragma: no cover
        pass

    def write_record(self, record) -> None:
        raise NotImplementedError

    def close(self) -> None:  # pragma: no cover
        pass


def write_using_output_format(df: DataFrame, fmt_factory: Callable[[], OutputFormat], conf: dict | None = None):
    """Write every row through a fresh ``OutputFormat`` per task; on a stream
    per task of each micro-batch, with that batch's number of tasks."""
    conf = dict(conf or {})
    if df.isStreaming:
        return df.writeStream.foreachBatch(lambda batch, _id: write_using_output_format(batch, fmt_factory, conf))
    num_tasks = df.rdd.getNumPartitions()

    def run(rows):
        ctx = TaskContext.get()
        fmt = fmt_factory()
        fmt.configure(conf)
        fmt.open(ctx.partitionId() if ctx else 0, num_tasks)
        try:
            for row in rows:
                fmt.write_record(row)
        finally:
            fmt.close()

    df.foreachPartition(run)
    return None


def socket_connection(host: str, port: int):
    """Factory for a TCP connection with ``sendall`` / ``close``."""
    def connect():
        return socket.create_connection((host, port))

    return connect


class _SocketFormat(OutputFormat):
    def __init__(self, connect, serialize):
        self.connect, self.serialize, self.conn = connect, serialize, None

    def open(self, task_number, num_tasks):
        self.conn = self.connect()

    def write_record(self, record):
        self.conn.sendall(self.serialize(record))

    def close(self):
        if self.conn is not None:
            self.conn.close()


def _utf8_value(row) -> bytes:
    return ("" if row[0] is None else str(row[0])).encode("utf-8")


def write_to_socket(df: DataFrame, connect: Callable, serialize: Callable = _utf8_value):
    """Send each row's serialised bytes (no separator added) over one
    connection per task; ``connect`` is a zero-argument connection factory
    (``socket_connection(host, port)`` for TCP)."""
    return write_using_output_format(df, lambda: _SocketFormat(connect, serialize))
