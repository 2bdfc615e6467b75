"""Property: for associative window aggregates, the streaming result after
every window has closed equals the batch result (SURVEY §5 (d)).  A far-future
sentinel row closes all windows; rows arrive in several files/micro-batches
in time order, so none is late."""

import datetime as dt
import os
import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from streamkit.operators import Agg, session_window, time_window
from streamkit.streaming import assign_event_time, run_available

T0 = dt.datetime(2024, 1, 1)
SENTINEL_KEY = -1


def _write_batches(spark, rows, directory, n_files):
    rows = sorted(rows, key=lambda r: r[1])
    chunk = max(1, len(rows) // n_files)
    base = 1_600_000_000
    for i in range(0, len(rows), chunk):
        path = os.path.join(directory, f"part-{i:06d}")
        spark.createDataFrame(rows[i:i + chunk], "key long, ts timestamp, v long").coalesce(1).write.parquet(path)
        for root, _dirs, files in os.walk(path):
            for f in files:
                os.utime(os.path.join(root, f), (base + i, base + i))
    return directory


def _stream(spark, directory):
    return (spark.readStream.schema("key long, ts timestamp, v long").option("maxFilesPerTrigger", "1")
            .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(directory))


@settings(max_examples=3, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from(["tumbling", "sliding", "session"]))
def test_stream_equals_batch(spark, tmp_path_factory, seed, shape):
    rng = random.Random(seed)
    rows = [(rng.randrange(3), T0 + dt.timedelta(seconds=rng.randrange(0, 600)), rng.randrange(100))
            for _ in range(150)]
    sentinel = (SENTINEL_KEY, T0 + dt.timedelta(days=1), 0)
    directory = _write_batches(spark, rows + [sentinel], str(tmp_path_factory.mktemp("bes")), 4)
    aggs = [Agg("sum", F.col("v"), "s"), Agg("count", None, "n"), Agg("max", F.col("v"), "m")]

    def build(df):
        if shape == "tumbling":
            return time_window(df, "key", "ts", "1 minute", aggs)
        if shape == "sliding":
            return time_window(df, "key", "ts", "2 minutes", aggs, slide="30 seconds")
        return session_window(df, "key", "ts", "20 seconds", aggs, blocks=10)

    streamed = build(assign_event_time(_stream(spark, directory), "ts", "5 seconds"))
    got = sorted(tuple(r) for _, rs in run_available(streamed, f"bes_{shape}_{seed}") for r in rs if r.key != SENTINEL_KEY)
    batch = build(spark.createDataFrame(rows, "key long, ts timestamp, v long"))
    assert got == sorted(tuple(r) for r in batch.collect())
