"""The time-ordered source: small state under a short watermark, whatever the
order of the part files; restarts; odd rows."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from streamkit.operators import Agg, time_window
from streamkit.plans.streams import drain_ordered, stream_session
from streamkit.session import checkpoint_dir
from streamkit.sources import ordered
from streamkit.sources.ordered import END_SECONDS, time_ordered_stream
from streamkit.streaming import assign_event_time
from streamkit.streaming.replay import with_instants

EVENTS = "/root/testdata/sf0.001/events.parquet"


def new_folder(spark):
    return os.path.join(checkpoint_dir(spark), f"ordered-{uuid.uuid4().hex[:8]}")


def shuffled(spark, tmp_path):
    """Events in part files of no order of time, the latest files first."""
    path = f"{tmp_path}/events.parquet"
    spark.read.parquet(EVENTS).repartition(4, F.xxhash64("event_id")).write.parquet(path)
    return with_instants(spark.read.parquet(path))


def test_state_holds_a_batch_of_windows(spark, tmp_path):
    own = stream_session(spark)
    rows = shuffled(own, tmp_path)
    aggs = [Agg("count", F.col("event_id"), "n"), Agg("sum", F.col("event_id"), "ids")]
    stream = time_ordered_stream(rows, "ts", new_folder(own), batches=8)
    progress = []
    got = drain_ordered(time_window(assign_event_time(stream, "ts", "1 hour"), "user_id", "ts", "1 hour", aggs), "ordered", progress)
    want = time_window(rows, "user_id", "ts", "1 hour", aggs)
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0
    batches = [p for p in progress if p["numInputRows"] > 0]
    state = [op["numRowsTotal"] for p in progress for op in p["stateOperators"]]
    dropped = sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
    assert len(batches) >= 6 and dropped == 0
    # a batch is about an eighth of the table; without an order of time it would be all windows
    assert max(state) < want.count() / 4 and state[-1] <= 1


def test_a_restarted_query_goes_on(spark, tmp_path):
    own = stream_session(spark)
    rows = shuffled(own, tmp_path).select("event_id", "ts")
    stream = time_ordered_stream(rows, "ts", new_folder(own), batches=8)
    seen, fail_at = {}, [3]

    def take(batch, number):
        got = batch.collect()
        if number == fail_at[0]:
            raise RuntimeError("lost")
        seen[number] = got

    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", new_folder(own))
    with pytest.raises(Exception, match="lost"):
        query = writer.start()
        query.processAllAvailable()
    fail_at[0] = None
    assert sorted(seen) == [0, 1, 2]
    for _ in range(2):  # the failed batch and the rest; then nothing is left
        query = writer.start()
        query.processAllAvailable()
        query.stop()
    got = [r for number in sorted(seen) for r in seen[number]]
    assert sorted(r.event_id for r in got if r.event_id is not None) == sorted(r.event_id for r in rows.collect())
    assert sum(r.event_id is None for r in got) == 1 and len(seen) >= 6
    ends = [max(r.ts for r in seen[n]) for n in sorted(seen)]
    starts = [min(r.ts for r in seen[n]) for n in sorted(seen)]
    assert all(a <= b for a, b in zip(ends, starts[1:]))


def test_odd_rows(spark):
    """A hot instant over several parts, rows without a time, all types kept, an empty table."""
    own = stream_session(spark)
    at = dt.datetime(2024, 3, 31, 2, 30)
    rows = [(i, at if i % 3 else None, f"t{i}" if i % 4 else None, [i], i % 2 == 0) for i in range(40)]
    for data in (rows, []):
        table = own.createDataFrame(data, "id long, ts timestamp_ntz, t string, l array<int>, _to_row_ boolean")
        table = table.withColumn("d", F.lit("1.25").cast("decimal(20,2)")).withColumn("n", F.col("ts")).withColumn("ts", F.expr("ts::timestamp"))
        stream = time_ordered_stream(table, "ts", new_folder(own), batches=3)
        assert stream.schema.simpleString() == table.schema.simpleString()
        got = drain_ordered(stream, "odd")
        end = got.where(F.unix_seconds("ts") == END_SECONDS)
        assert end.count() == 1 and end.first().id is None
        assert got.exceptAll(table).count() == 1 and got.count() == len(data) + 1


def test_numbers_as_time(spark):
    own = stream_session(spark)
    stream = time_ordered_stream(own.range(100).withColumn("x", F.col("id") % 7), "id", new_folder(own), batches=4)
    got = drain_ordered(stream, "numbers")
    few = time_ordered_stream(own.range(100).withColumn("x", F.col("id") % 7), "id", new_folder(own), batch_bytes=1)
    progress = []
    assert drain_ordered(few, "by_bytes", progress).exceptAll(got).count() == 0
    assert sum(p["numInputRows"] > 0 for p in progress) == own.sparkContext.defaultParallelism  # a part each
    assert got.where(F.col("id") < 100).count() == 100 and got.where(F.col("id") == END_SECONDS).count() == 1


def test_micro_batches_are_cut_by_weight(spark, monkeypatch):
    """Rows of much text and little Parquet: as many micro-batches as the text asks for."""
    monkeypatch.setattr(ordered, "TASK_WEIGHT", 10_000, raising=False)
    own = stream_session(spark)
    tasks = own.sparkContext.defaultParallelism
    rows = own.range(tasks * 100).withColumn("t", F.when(F.col("id") >= 0, F.repeat(F.lit("x"), 600)))
    stream = time_ordered_stream(rows, "id", new_folder(own), weight=F.octet_length("t"))
    progress = []
    assert drain_ordered(stream, "by_weight", progress).count() == tasks * 100 + 1
    batches = [p["numInputRows"] for p in progress if p["numInputRows"] > 0]
    assert len(batches) >= 6 and max(batches) <= 100 * tasks / 5
    assert own.conf.get(ordered.SHUFFLE_CLEANUP) == "false"
