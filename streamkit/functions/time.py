"""Event-time helpers."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS_US = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def interval_micros(duration) -> int:
    """Microseconds of ``duration``: a ``timedelta``, an int (milliseconds) or
    a string such as ``'5 seconds'`` / ``'50 minutes'``."""
    if isinstance(duration, dt.timedelta):
        return int(duration / dt.timedelta(microseconds=1))
    if isinstance(duration, int):
        return duration * 1_000
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", str(duration).lower())
    if not m or m.group(2) not in _UNITS_US:
        raise ValueError(f"cannot read duration {duration!r}")
    return int(m.group(1)) * _UNITS_US[m.group(2)]


def to_interval(duration) -> str:
    """Spark interval string for ``duration``."""
    return f"{interval_micros(duration)} microseconds"


def leading_epoch_millis(col, sep: str = " ") -> Column:
    """First ``sep``-separated token as epoch milliseconds (bigint; ANSI cast raises on junk)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.split(c, sep, -1).getItem(0).cast("bigint")


def epoch_millis_to_ts(col, sep: str = " ") -> Column:
    """Event time from a line whose first token is epoch milliseconds."""
    return F.timestamp_millis(leading_epoch_millis(col, sep))


_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_EPOCH_UTC = "TIMESTAMP'1970-01-01 00:00:00Z'"


def ntz_micros(name: str) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ column, independent of
    the session time zone: NTZ - NTZ is an exact interval, added to a UTC
    instant.  (``timestampdiff``/casts go through the session zone, which is
    not monotone across a daylight-saving gap.)"""
    return F.expr(f"unix_micros({_EPOCH_UTC} + (`{name}` - {_EPOCH_NTZ}))")


def micros_between(earlier: str, later: str, ntz: bool) -> Column:
    """``later - earlier`` in microseconds, zone-free for both timestamp types."""
    if ntz:
        return F.expr(f"unix_micros({_EPOCH_UTC} + (`{later}` - `{earlier}`))")
    return F.unix_micros(F.col(later)) - F.unix_micros(F.col(earlier))


def ntz_to_instant(name: str) -> Column:
    """TIMESTAMP_NTZ → TIMESTAMP reading the wall clock as UTC (zone-free;
    watermarks need TIMESTAMP)."""
    return F.timestamp_micros(ntz_micros(name))


def instant_to_ntz(name: str) -> Column:
    """TIMESTAMP → TIMESTAMP_NTZ with the UTC wall clock (inverse of
    ``ntz_to_instant``, zone-free)."""
    return F.expr(f"timestampadd(MICROSECOND, unix_micros(`{name}`), {_EPOCH_NTZ})")
