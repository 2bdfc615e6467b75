import os

import pytest
from pyspark.sql import functions as F

from streamkit.sinks import OutputFormat, print_rows, write_delimited, write_text, write_to_socket, write_using_output_format
from streamkit.sinks.files import delimited_lines
from tests.conftest import LINES


def _read_all(path):
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    return "".join(open(os.path.join(path, p), encoding="utf-8").read() for p in parts)


def test_text_sink_refuses_existing(lines_df, tmp_path):
    out = str(tmp_path / "text")
    write_text(lines_df.select("value"), out, single_file=True)
    assert _read_all(out).splitlines() == LINES
    with pytest.raises(Exception):
        write_text(lines_df.select("value"), out)


def test_delimited_sink(lines_df, tmp_path):
    out = str(tmp_path / "csv")
    cols = [F.lower("value"), F.upper("value")]
    write_delimited(lines_df.orderBy("seq"), out, cols, row_delim="\n\n", field_delim="----", single_file=True)
    text = _read_all(out)
    assert text.split("\n\n")[0] == "java mysql----JAVA MYSQL"
    assert text.count("\n\n") == 24
    assert delimited_lines(lines_df, ["seq", "value"], "|").first().value == "0|Java MySQL"


class _Recorder(OutputFormat):
    """Appends what happens to a file per task (tasks run in other processes)."""

    def __init__(self, directory):
        self.directory = directory

    def open(self, task_number, num_tasks):
        self.fh = open(os.path.join(self.directory, f"task-{task_number}.log"), "w", encoding="utf-8")
        self.fh.write(f"open {task_number} {num_tasks}\n")

    def write_record(self, record):
        self.fh.write(record.value.upper() + "\n")

    def close(self):
        self.fh.write("close\n")
        self.fh.close()


def test_output_format_lifecycle(lines_df, tmp_path):
    d = str(tmp_path)
    write_using_output_format(lines_df.select("value").repartition(2), lambda: _Recorder(d))
    logs = [open(os.path.join(d, f), encoding="utf-8").read().splitlines() for f in sorted(os.listdir(d))]
    assert len(logs) == 2
    assert all(log[0].startswith("open") and log[0].endswith(" 2") and log[-1] == "close" for log in logs)
    assert sorted(x for log in logs for x in log[1:-1]) == sorted(v.upper() for v in LINES)


class _FakeConnection:
    def __init__(self, path):
        self.fh = open(path, "ab")

    def sendall(self, data):
        self.fh.write(data)

    def close(self):
        self.fh.close()


def test_socket_sink_with_fake_connection(lines_df, tmp_path):
    path = str(tmp_path / "sent.bin")
    write_to_socket(lines_df.select("value").coalesce(1).orderBy("value"), lambda: _FakeConnection(path))
    assert open(path, "rb").read() == "".join(sorted(LINES)).encode()  # no separator added


def test_print_rows(lines_df):
    print_rows(lines_df.select("value"), parallelism=1)


def test_print_sinks_on_streams(spark, tmp_path):
    from streamkit.sinks import print_to_err
    from streamkit.session import streaming_checkpoint
    from streamkit.streaming import line_stream, replay_lines

    src = line_stream(spark, replay_lines(["a", "b"], str(tmp_path / "in")), per_batch=2)
    for name, writer in (("print_out", print_rows(src)), ("print_err", print_to_err(src))):
        q = writer.option("checkpointLocation", streaming_checkpoint(spark, f"{name}-{tmp_path.name}")) \
            .trigger(availableNow=True).start()
        q.awaitTermination()
        assert q.exception() is None


def test_socket_source_newline_only(spark):
    from streamkit.sources import socket_text_stream

    with pytest.raises(ValueError):
        socket_text_stream(spark, "localhost", 9, delimiter=";")
