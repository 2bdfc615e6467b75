"""Operators against plain-Python brute force implementations of the
original semantics, on random small inputs."""

import datetime as dt
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from streamkit.functions.text import java_split
from streamkit.operators import Agg, count_window, rolling_extreme_by, session_window

T0 = dt.datetime(2024, 1, 1)


def split_like_the_original(s: str) -> list[str]:
    """Split at every single whitespace character; drop trailing empty
    pieces; a string without separators (also the empty one) is one piece."""
    if not re.search(r"[ \t\n\x0b\f\r]", s):
        return [s]
    pieces = re.split(r"[ \t\n\x0b\f\r]", s)
    while pieces and pieces[-1] == "":
        pieces.pop()
    return pieces


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\n\x0b\f\r", max_size=12), min_size=1, max_size=40))
def test_split_matches_original(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = {r.i: r.w for r in df.select("i", java_split("t").alias("w")).collect()}
    assert all(got[i] == split_like_the_original(t) for i, t in enumerate(texts))


def count_windows_like_the_original(values, size, slide):
    """Per key, in arrival order: trigger every ``slide`` elements (or every
    ``size`` for tumbling), sum over the last ``size`` elements kept."""
    out, buf = [], []
    for n, v in enumerate(values, start=1):
        buf.append(v)
        if slide is None:
            if len(buf) == size:
                out.append((n, sum(buf)))
                buf = []
        else:
            buf = buf[-size:]
            if n % slide == 0:
                out.append((n, sum(buf)))
    return out


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-50, 50)), min_size=1, max_size=80),
       st.integers(1, 6), st.sampled_from([None, 1, 2, 3]))
def test_count_windows_match_original(spark, rows, size, slide):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "seq long, k long, v long")
    got = sorted((r.k, r.window_end_count, r.s) for r in
                 count_window(df, "k", "seq", size, [Agg("sum", F.col("v"), "s")], slide=slide, blocks=5).collect())
    want = []
    for k in {k for k, _ in rows}:
        want += [(k, n, s) for n, s in count_windows_like_the_original([v for kk, v in rows if kk == k], size, slide)]
    assert got == sorted(want)


def sessions_like_the_original(times, gap):
    """Merge windows [t, t + gap) that touch or overlap."""
    sessions = []
    for t in sorted(times):
        if sessions and t <= sessions[-1][1]:
            sessions[-1][1] = max(sessions[-1][1], t + gap)
            sessions[-1][2] += 1
        else:
            sessions.append([t, t + gap, 1])
    return [tuple(s) for s in sessions]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 300)), min_size=1, max_size=80), st.integers(1, 30))
def test_sessions_match_original(spark, rows, gap):
    df = spark.createDataFrame([(i, k, T0 + dt.timedelta(seconds=s)) for i, (k, s) in enumerate(rows)],
                               "id long, k long, ts timestamp_ntz")
    out = session_window(df, "k", "ts", f"{gap} seconds", [Agg("count", None, "n")], tiebreak=("id",), blocks=7)
    got = sorted((r.k, int((r.session_start - T0).total_seconds()), int((r.session_end - T0).total_seconds()), r.n)
                 for r in out.collect())
    want = []
    for k in {k for k, _ in rows}:
        want += [(k, *s) for s in sessions_like_the_original([s for kk, s in rows if kk == k], gap)]
    assert got == sorted(want)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 5)), min_size=1, max_size=60))
def test_rolling_max_by_matches_original(spark, rows):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "seq long, k long, v long")
    out = rolling_extreme_by(df, "k", "seq", "v", ["seq"], "max", prefix="best_", blocks=4)
    got = {r.seq: r.best_seq for r in out.collect()}
    best = {}
    for i, (k, v) in enumerate(rows):
        if k not in best or v > rows[best[k]][1]:  # only a strictly greater value replaces the record
            best[k] = i
        assert got[i] == best[k]


def test_global_count_windows_and_sessions(spark):
    """key=None: one group over all rows (blocked all the same)."""
    values = [(i * 37) % 101 for i in range(1, 300)]
    df = spark.createDataFrame([(i, v, T0 + dt.timedelta(seconds=(i * i) % 977)) for i, v in enumerate(values, 1)],
                               "seq long, v long, ts timestamp_ntz")
    got = sorted((r.window_end_count, r.s) for r in
                 count_window(df, None, "seq", 7, [Agg("sum", F.col("v"), "s")], slide=3, blocks=40).collect())
    assert got == count_windows_like_the_original(values, 7, 3)
    out = session_window(df, None, "ts", "4 seconds", [Agg("count", None, "n")], tiebreak=("seq",), blocks=40)
    got = sorted((int((r.session_start - T0).total_seconds()), int((r.session_end - T0).total_seconds()), r.n)
                 for r in out.collect())
    assert got == sessions_like_the_original([(i * i) % 977 for i in range(1, 300)], 4)
