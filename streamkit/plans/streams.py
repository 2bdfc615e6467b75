"""Registered streaming queries.

Each streams a whole driver table through Structured Streaming (watermarked
window / session aggregation in append mode, or a per-record operator on
micro-batches with its state in tables), drains it into a parquet table under
the shared checkpoint folder, and returns that table.  Windows read their table
through the time-ordered source (``sources.ordered``): ranges of event time
arrive one after the other, whatever the order of the part files, so the
watermark lags by ``WATERMARK_DELAY`` only, the state holds the windows of about
one micro-batch, a closing row ends the last ones, and the results are those of
the batch queries.
"""

from __future__ import annotations

import os
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from streamkit.functions.time import epoch_millis_to_ts, instant_to_ntz, ntz_micros
from streamkit.operators.keyed import rolling_extreme, rolling_extreme_by, rolling_fold, rolling_reduce, rolling_sum
from streamkit.operators.windows import Agg, count_window, session_window, time_window
from streamkit.plans.programs import concat_windows
from streamkit.plans.programs import windowed_word_count as word_count_windows
from streamkit.session import checkpoint_dir, release_heap, ship_package
from streamkit.sources.ordered import time_ordered_stream
from streamkit.sources.tables import load_table
from streamkit.streaming.event_time import assign_event_time, watermark_conf
from streamkit.streaming.replay import with_instants
from streamkit.streaming.tables import KeyedStream, StreamState

WATERMARK_DELAY = "1 hour"
#: Micro-batches of the per-record queries, and at least about as many of the windows.
ARRIVALS = 5
#: State rows that the words of a window of documents are dealt to.
WORD_PARTS = 4
#: Windows of documents that share these rows.
WORD_SPAN = 64
#: Settings of window streams: no run goes back behind its last micro-batches, so
#: older state goes; rows for Python move in few bytes whatever their number; times
#: are kept as longs.
ORDERED_CONF = {
    "spark.sql.streaming.minBatchesToRetain": "2", "spark.sql.streaming.stateStore.minDeltasForSnapshot": "4",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}
#: Seconds after which executors give back what their heaps hold for nothing.
RELEASE_S = 10
#: Micro-batches of the query with late rows.
LATE_BATCHES = 7


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of its own for one query: a stream's state is split into as
    many parts as there are shuffle partitions when it first starts, and other
    queries keep their setting."""
    ship_package(spark)
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism))
    return own


def _writer(df: DataFrame, name: str) -> tuple[DataStreamWriter, str]:
    run, base = f"{name}-{uuid.uuid4().hex[:12]}", checkpoint_dir(df.sparkSession)
    out = os.path.join(base, "stream-results", run)
    return df.writeStream.format("parquet").option("path", out).option("checkpointLocation", os.path.join(base, "streams", run)).outputMode("append"), out


def drain_to_table(df: DataFrame, name: str, between: list[Callable[[], None]] = ()) -> DataFrame:
    """Run a streaming frame over everything available and read back its
    output; then once more after each of the calls in ``between``."""
    writer, out = _writer(df, name)
    for call in [None, *between]:
        if call:
            call()
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    return df.sparkSession.read.schema(df.schema).parquet(out)


@contextmanager
def _heaps_kept_small(spark: SparkSession) -> Iterator[None]:
    """The state of batches gone by stays in the heap until a full collection: in
    many micro-batches heaps would grow to their limit, next to the Python workers."""
    over = threading.Event()

    def release() -> None:
        with suppress(Exception):  # a stopped session; the stream has its own errors
            while not over.wait(RELEASE_S):
                release_heap(spark)

    thread = threading.Thread(target=release, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()
    release_heap(spark)


def drain_ordered(df: DataFrame, name: str, progress: list | None = None) -> DataFrame:
    """Run a frame over a time-ordered source to its end and read back its
    output; ``progress`` (a list) receives the progress reports."""
    writer, out = _writer(df, name)
    query = writer.trigger(processingTime="0 seconds").start()
    try:
        with _heaps_kept_small(df.sparkSession):
            query.processAllAvailable()
        if progress is not None:
            progress.extend(query.recentProgress)
    finally:
        query.stop()
    return df.sparkSession.read.schema(df.schema).parquet(out)


def _folder(spark: SparkSession, kind: str) -> str:
    return os.path.join(checkpoint_dir(spark), "stream-inputs", f"{kind}-{uuid.uuid4().hex[:12]}")


def _in_order(spark: SparkSession, sf_dir: str, table: str, columns: list[str], time_col: str = "ts", weight: Column | None = None) -> DataFrame:
    """Columns of a table as a stream in the order of ``time_col``."""
    own = stream_session(spark)
    for k, v in ORDERED_CONF.items():
        own.conf.set(k, v)
    rows = with_instants(load_table(own, sf_dir, table).select(*columns))
    with _heaps_kept_small(own):
        return time_ordered_stream(rows, time_col, _folder(own, table), batches=ARRIVALS, weight=weight)


def _cents(ev: DataFrame) -> DataFrame:
    return ev.withColumn("cents", F.round(F.col("value") * 100).cast("long")).withColumn("has_c", F.col("event_type").contains("c"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in order of time, with their watermark."""
    events = _in_order(spark, sf_dir, "events", ["event_id", "user_id", "ts", "event_type", "value"])
    return assign_event_time(_cents(events), "ts", WATERMARK_DELAY)


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, instant_to_ntz(c))
    return df


def _windows(spark: SparkSession, sf_dir: str, name: str, aggs: list[Agg], key: str | None = "user_id", size: str = "1 hour", slide: str | None = None) -> DataFrame:
    events = _events(spark, sf_dir)
    out = time_window(events, key, "ts", size, aggs, slide=slide)
    return _ntz(drain_ordered(out, name), "window_start", "window_end")


def stream_tumbling_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + E2/E3 on a stream: per-user 1 h event-time windows, watermark 1 h."""
    return _windows(spark, sf_dir, "stream_tumbling_sum", [Agg("sum", F.col("cents"), "cents")])


def stream_tumbling_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3 on a stream: per-user 1 h max value."""
    return _windows(spark, sf_dir, "stream_tumbling_max", [Agg("max", F.col("value"), "max_value")])


def stream_tumbling_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 on a stream: per-user 1 h fold from 100 adding 1 per record."""
    return _windows(spark, sf_dir, "stream_tumbling_fold", [Agg("fold", F.lit(1), "fold", initial=100)])


def stream_sliding_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 on a stream: per event type, 2 h windows every 1 h."""
    return _windows(spark, sf_dir, "stream_sliding_count", [Agg("count", F.col("event_id"), "n")], "event_type", "2 hours", "1 hour")


def stream_global_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 on a stream: per 6 h window every 3 h, the event types joined in
    arrival order (time, then event id) and the sum of their lengths."""
    events = _events(spark, sf_dir)
    out = concat_windows(events, text_col="event_type", time_col="ts", order=("event_id",), size="6 hours", slide="3 hours")
    return _ntz(drain_ordered(out, "stream_global_concat"), "window_start", "window_end")


def stream_session_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W10 on a stream: per-user sessions, gap 6 h."""
    events = _events(spark, sf_dir)
    out = session_window(events, "user_id", "ts", "6 hours", [Agg("count", None, "n"), Agg("sum", F.col("cents"), "cents")])
    return _ntz(drain_ordered(out, "stream_session_by_user"), "session_start", "session_end")


def _arriving(spark: SparkSession, sf_dir: str, name: str, columns: list[str], operator: Callable[[DataFrame, StreamState], DataFrame]) -> DataFrame:
    """``operator`` over the events, which arrive in the order of their ids in
    ``ARRIVALS`` micro-batches, with its state in key tables."""
    own = stream_session(spark)
    events = _cents(load_table(own, sf_dir, "events")).select(*columns)
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    share = -(-(high - low + 1) // ARRIVALS) if low is not None else 1
    source, keyed = _folder(own, "events"), KeyedStream(_folder(own, name), operator)
    for i in range(ARRIVALS if low is not None else 1):
        part = events if low is None else events.where(F.col("event_id").between(low + i * share, low + (i + 1) * share - 1))
        part.write.mode("append").parquet(source)
        keyed.run(own.readStream.schema(events.schema).parquet(source))
    return keyed.result(own)


def stream_rolling_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 on a stream: running sum of cents per user, one row per event."""
    return _arriving(spark, sf_dir, "stream_rolling_sum", ["event_id", "user_id", "cents"],
                     lambda ev, state: rolling_sum(ev, "user_id", "event_id", "cents", name="running_cents", state=state))


def stream_rolling_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 on a stream: summing reduce; later records are labelled by key."""
    label = F.when(F.col("has_c"), F.lit("c")).otherwise(F.lit("n"))
    return _arriving(spark, sf_dir, "stream_rolling_reduce", ["event_id", "has_c", "event_type", "cents"],
                     lambda ev, state: rolling_reduce(ev, "has_c", "event_id", "cents", "event_type", label, state=state))


def stream_rolling_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 on a stream: fold from 100 adding 1 per record."""
    return _arriving(spark, sf_dir, "stream_rolling_fold", ["event_id", "has_c"],
                     lambda ev, state: rolling_fold(ev, "has_c", "event_id", F.lit(1), 100, name="fold", state=state))


def stream_rolling_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 on a stream: running max of value; event_type stays the first record's."""
    return _arriving(spark, sf_dir, "stream_rolling_max", ["event_id", "has_c", "event_type", "value"],
                     lambda ev, state: rolling_extreme(ev, "has_c", "event_id", "value", "max", carry=["event_type"], state=state))


def stream_count_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6 on a stream: per user, every 5 events, the sum of their cents."""
    return _arriving(spark, sf_dir, "stream_count_tumbling", ["event_id", "user_id", "cents"],
                     lambda ev, state: count_window(ev, "user_id", "event_id", 5, [Agg("sum", F.col("cents"), "cents")], state=state))


def stream_rolling_maxby(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 on a stream: per event, the user's record with the highest value so far."""
    out = _arriving(spark, sf_dir, "stream_rolling_maxby", ["event_id", "user_id", "event_type", "value"],
                    lambda ev, state: rolling_extreme_by(ev, "user_id", "event_id", "value", ["event_id", "event_type", "value"], "max", prefix="best_", state=state))
    return out.select("event_id", "user_id", "best_event_id", "best_event_type", "best_value")


def stream_count_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 on a stream: per user, after every 2nd event, the cents of the last <= 5."""
    return _arriving(spark, sf_dir, "stream_count_sliding", ["event_id", "user_id", "cents"],
                     lambda ev, state: count_window(ev, "user_id", "event_id", 5, [Agg("sum", F.col("cents"), "cents")], slide=2, state=state))


def stream_windowed_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 on a stream: documents arriving one per second (event time
    ``doc_id`` s, watermark 5 s), words counted in 5 s windows every 1 s."""
    docs = _in_order(spark, sf_dir, "documents", ["doc_id", "text"], "doc_id", F.octet_length("text")).select(F.timestamp_seconds(F.col("doc_id")).alias("ts"), "text")
    out = word_count_windows(assign_event_time(docs, "ts", "5 seconds"), text_col="text", time_col="ts", word_parts=WORD_PARTS, span=WORD_SPAN)
    return _ntz(drain_ordered(out, "stream_windowed_word_count"), "window_start", "window_end")


def stream_epoch_lines_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines whose first token is epoch milliseconds arrive in
    several micro-batches of shuffled times (``event_id`` modulo the number of
    batches); rows whose 1 h window the watermark (6 h behind) has closed are
    dropped.  Each batch is written as text files, however many, and read by a
    run of its own."""
    own = stream_session(spark)
    for k, v in watermark_conf().items():
        own.conf.set(k, v)
    events = load_table(own, sf_dir, "events")
    at = F.floor(ntz_micros("ts") / 1000).cast("long")
    lines = events.select((F.col("event_id") % LATE_BATCHES).alias("batch"),
                          F.concat_ws(" ", at.cast("string"), F.col("user_id").cast("string"), F.round(F.col("value") * 100).cast("long").cast("string")).alias("value"))
    folder = _folder(own, "lines")

    def arrive(batch: int):
        return lambda: lines.where(F.col("batch") == batch).select("value").write.mode("append").text(folder)

    arrive(0)()
    source = own.readStream.text(folder)
    token = F.split("value", " ")
    timed = source.select(epoch_millis_to_ts("value").alias("ts"), token[1].cast("long").alias("user_id"), token[2].cast("long").alias("cents"))
    out = time_window(assign_event_time(timed, "ts", "6 hours"), "user_id", "ts", "1 hour", [Agg("sum", F.col("cents"), "cents"), Agg("count", None, "n")])
    end = own.range(1).select(F.concat_ws(" ", F.unix_millis(F.lit("9999-01-01 00:00:00").cast("timestamp")).cast("string"), F.lit("0"), F.lit("0")).alias("value"))
    rest = [*(arrive(b) for b in range(1, LATE_BATCHES)), lambda: end.write.mode("append").text(folder)]
    return _ntz(drain_to_table(out, "stream_epoch_lines_late", rest), "window_start", "window_end")


STREAM_QUERIES = {f.__name__: f for f in (
    stream_windowed_word_count, stream_rolling_maxby, stream_count_sliding, stream_tumbling_sum, stream_tumbling_max, stream_tumbling_fold,
    stream_sliding_count, stream_global_concat, stream_session_by_user, stream_rolling_sum, stream_rolling_reduce, stream_rolling_fold,
    stream_rolling_max, stream_count_tumbling, stream_epoch_lines_late,
)}
