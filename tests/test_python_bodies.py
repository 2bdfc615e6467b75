"""Python behind Spark's interfaces: table functions, iterators in tasks, and
output formats with commit and abort."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamkit.operators import flat_map_python
from streamkit.sinks import LineFormat, committed_parts, read_committed, write_transactional
from streamkit.sources import from_iterators


def test_flat_map_python_fixed_schema(spark):
    df = spark.createDataFrame([(1, "a b"), (2, ""), (3, None), (1, "a b")], "token long, text string")

    def make():
        return lambda row: ((w, len(w)) for w in (row.text or "").split())

    out = flat_map_python(df, make, "word string, n int", keep=("token", "text"))
    assert out.columns == ["token", "text", "word", "n"]
    assert sorted(map(tuple, out.collect())) == sorted([(1, "a b", "a", 1), (1, "a b", "b", 1)] * 2)
    assert flat_map_python(df.limit(0), make, "word string, n int").count() == 0


def test_flat_map_python_analysed_schema(spark):
    """The result's type follows the row's; reads names what the body gets."""
    df = spark.range(3).select("id", F.struct(F.col("id").cast("double").alias("x"), F.lit("s").alias("s")).alias("pair"))

    def flattened(row: T.StructType) -> T.StructType:
        return row["pair"].dataType

    out = flat_map_python(df, lambda: lambda row: [tuple(row.pair)] * int(row.pair.x), flattened, reads=("pair",))
    assert out.dtypes == [("x", "double"), ("s", "string")]
    assert sorted(map(tuple, out.collect())) == [(1.0, "s"), (2.0, "s"), (2.0, "s")]


def test_iterators_run_in_tasks(spark):
    driver = os.getpid()
    out = from_iterators(spark, lambda i, n: ((i, n, os.getpid()) for _ in range(i * 10_000)), 4, "i int, n int, pid long")
    assert out.rdd.getNumPartitions() == 4
    got = {(r.i, r.n): r["count"] for r in out.groupBy("i", "n").count().collect()}
    assert got == {(1, 4): 10_000, (2, 4): 20_000, (3, 4): 30_000}
    assert out.where(F.col("pid") == driver).count() == 0


def test_iterators_of_scalars_and_of_nothing(spark):
    assert [r.value for r in from_iterators(spark, lambda i, n: ["a", None], 1, element_type=str).collect()] == ["a", None]
    assert from_iterators(spark, lambda i, n: [], 3, element_type=float).dtypes == [("value", "double")]
    assert from_iterators(spark, lambda i, n: [], 3, element_type=float).count() == 0


def _fails_at(flag: str):
    """A format that fails at record 7 as long as the file ``flag`` is there."""
    class Failing(LineFormat):
        def write_record(self, record):
            super().write_record(record)
            if record[0] == "7" and os.path.exists(flag):
                raise RuntimeError("broken record")

    return Failing


def test_failed_job_leaves_nothing_and_a_repeat_writes_each_record_once(spark, tmp_path):
    folder, flag = str(tmp_path / "out"), tmp_path / "flag"
    df = spark.range(0, 20, 1, 4).select(F.col("id").cast("string"))
    flag.touch()
    with pytest.raises(Exception, match="broken record"):
        write_transactional(df, folder, _fails_at(str(flag)))
    assert committed_parts(folder) == {} and read_committed(spark, folder).count() == 0
    flag.unlink()
    for _ in range(2):  # the second is the same epoch: its parts are dropped
        write_transactional(df, folder, _fails_at(str(flag)))
        assert sorted(int(r.value) for r in read_committed(spark, folder).collect()) == list(range(20))
    write_transactional(df, folder, epoch="another")
    assert read_committed(spark, folder).count() == 40
    assert {len(p) for p in committed_parts(folder).values()} == {4}


def test_stream_epochs_are_committed_once(spark, tmp_path):
    """A micro-batch fails, and one runs again after its commit: each record once."""
    source, folder, flag, state = (str(tmp_path / n) for n in ("in", "out", "flag", "state"))
    for i in range(3):
        spark.range(i * 5, i * 5 + 5, 1, 1).select(F.col("id").cast("string").alias("value")).write.mode("append").text(source)
    lines = spark.readStream.option("maxFilesPerTrigger", 1).schema("value string").text(source)

    def run():
        writer = write_transactional(lines, folder, _fails_at(flag), epoch="lines")
        writer.option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()

    open(flag, "w").close()
    with pytest.raises(Exception, match="broken record"):
        run()
    os.unlink(flag)
    done = set(committed_parts(folder))
    run()
    values = sorted(int(r.value) for r in read_committed(spark, folder).collect())
    assert values == list(range(15)) and len(done) < 3 == len(committed_parts(folder))
    # Spark forgets the last commit: the batch runs again, the epoch does not
    commits = os.path.join(state, "commits")
    last = max((n for n in os.listdir(commits) if n.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.unlink(os.path.join(commits, name))
    run()
    assert sorted(int(r.value) for r in read_committed(spark, folder).collect()) == values


def test_lifecycle_and_settings_of_a_staged_format(spark, tmp_path):
    class Framed(LineFormat):
        def configure(self, conf):
            self.mark = conf["mark"]

        def open(self, task_number, num_tasks):
            self.out.write(f"open {task_number} {num_tasks}\n".encode())

        def close(self):
            self.out.write(self.mark.encode() + b"\n")

    folder = str(tmp_path / "out")
    write_transactional(spark.createDataFrame([("a",), (None,)], "v string").coalesce(1), folder, Framed, conf={"mark": "end"})
    ((part, n),) = committed_parts(folder)["batch"]
    assert n == 2 and open(f"{folder}/parts/{part}").read() == "open 0 0\na\n\nend\n"
    assert json.load(open(f"{folder}/epochs/batch.json")) == {"parts": [[part, 2]]}
