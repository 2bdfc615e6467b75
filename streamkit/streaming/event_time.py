"""Time notions and watermarks.

* event time: a column of the data (``assign_event_time``), with a bounded
  out-of-orderness watermark = max event time seen - ``delay``;
* processing / ingestion time: ``processing_time()`` (the batch's clock).

Late rows: a row whose window has already been closed by the watermark is
dropped.  Spark filters late rows against the watermark of the *previous*
micro-batch when several stateful operators may be chained; for a single
windowed aggregation set ``watermark_conf()`` on the session so the
current watermark is applied at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamkit.functions.time import ntz_to_instant, to_interval


def processing_time() -> Column:
    """Processing-time column: the timestamp of the micro-batch."""
    return F.current_timestamp()


def assign_event_time(df: DataFrame, ts: Column | str, delay, name: str = "ts") -> DataFrame:
    """Attach event time ``ts`` (TIMESTAMP; NTZ input is cast) and a watermark
    lagging the max event time by ``delay``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    out = df.withColumn(name, c)
    if isinstance(out.schema[name].dataType, T.TimestampNTZType):
        # Zone-free: the wall clock read as UTC, so windows align the same way
        # in every session time zone.
        out = out.withColumn(name, ntz_to_instant(name))
    return out.withWatermark(name, to_interval(delay))


def watermark_conf() -> dict[str, str]:
    """Session settings so a single windowed aggregation drops late rows
    against the current watermark (not the previous batch's)."""
    return {"spark.sql.streaming.statefulOperator.allowMultiple": "false"}
