"""Structured Streaming twins of the operators.

Stateless operators (projections, flatMaps, routing, unions) and windowed
aggregations are the batch functions applied to a streaming DataFrame.
This package adds what streams need on top: event-time assignment with
watermarks, per-record stateful operators (rolling aggregates, count
windows) and helpers to run and replay streams.
"""

from streamkit.streaming.event_time import assign_event_time, processing_time, watermark_conf
from streamkit.streaming.stateful import (
    count_window_stream, rolling_extreme_by_stream, rolling_reduce_stream, rolling_stream,
)
from streamkit.streaming.tables import KeyedStream, KeyTable, StreamState
from streamkit.streaming.run import rows_dropped_by_watermark, run_available, start_query
from streamkit.streaming.replay import replay_lines, line_stream, table_stream

__all__ = [
    "assign_event_time", "processing_time", "watermark_conf", "rolling_stream", "count_window_stream", "rolling_extreme_by_stream", "rolling_reduce_stream",
    "KeyedStream", "KeyTable", "StreamState", "run_available", "rows_dropped_by_watermark", "start_query", "replay_lines", "line_stream", "table_stream",
]
