import pytest
from pyspark.sql import functions as F

from streamkit.functions.time import epoch_millis_to_ts
from streamkit.operators import Agg, session_window, time_window
from streamkit.streaming import (
    assign_event_time, count_window_stream, line_stream, replay_lines, rolling_stream, rows_dropped_by_watermark,
    run_available, watermark_conf,
)


@pytest.fixture()
def strict_late(spark):
    conf = watermark_conf()
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _event_lines(spark, tmp_path, values, delay):
    src = line_stream(spark, replay_lines([str(v) for v in values], str(tmp_path / "in")))
    return assign_event_time(src, epoch_millis_to_ts("value"), delay)


def _emitted(batches, col="value"):
    return sorted(int(r[col]) for _, rows in batches for r in rows)


def test_tumbling_event_time_drops_late(spark, tmp_path, strict_late):
    ev = _event_lines(spark, tmp_path, [1000, 2000, 12999, 13000, 7000, 8000, 23000, 17000, 18000, 34000], "3 seconds")
    out = time_window(ev, "value", "ts", "10 seconds", [Agg("count", None, "n")])
    progress = []
    batches = run_available(out, "tumbling_late", progress=progress)
    assert _emitted(batches) == [1000, 2000, 12999, 13000, 23000]
    assert rows_dropped_by_watermark(progress) == 4  # 7000, 8000, 17000, 18000
    # W[0,10) fires in the batch after 13000 moved the watermark to 10 s (the one reading 7000).
    first = min(b for b, rows in batches if rows)
    assert sorted(int(r.value) for b, rows in batches if b == first for r in rows) == [1000, 2000]


def test_session_event_time(spark, tmp_path):
    ev = _event_lines(spark, tmp_path, [1000, 2000, 3000, 4000, 5000, 6000, 7000, 120000], "1 second")
    out = session_window(ev, "value", "ts", "5 seconds", [Agg("count", None, "n")])
    batches = run_available(out, "sessions")
    assert _emitted(batches) == [1000, 2000, 3000, 4000, 5000, 6000, 7000]
    first_batch = min(b for b, rows in batches if rows)
    first_rows = [int(r.value) for b, rows in batches if b == first_batch for r in rows]
    assert first_rows == [1000]


def test_sliding_event_time(spark, tmp_path):
    ev = _event_lines(spark, tmp_path, [1000, 6000, 10000, 16000], "0 seconds")
    out = time_window(ev, "value", "ts", "10 seconds", [Agg("count", None, "n")], slide="5 seconds")
    rows = [r for _, rs in run_available(out, "sliding") for r in rs]
    got = sorted((int(r.window_start.timestamp()), int(r.value)) for r in rows)
    assert got == [(-5, 1000), (0, 1000), (0, 6000), (5, 6000), (5, 10000)]


def test_rolling_stream_across_batches(spark, tmp_path):
    lines = [f"{k} {i}" for i, k in enumerate("aabab", start=1)]
    src = line_stream(spark, replay_lines(lines, str(tmp_path / "in")), per_batch=2)
    parsed = src.select(F.split("value", " ")[0].alias("k"), F.split("value", " ")[1].cast("long").alias("seq"),
                        F.lit(1).cast("long").alias("one"))
    out = rolling_stream(parsed, "k", "seq", "one", "sum", name="run")
    rows = sorted((r.k, r.seq, r.run) for _, rs in run_available(out, "rolling") for r in rs)
    assert rows == [("a", 1, 1), ("a", 2, 2), ("a", 4, 3), ("b", 3, 1), ("b", 5, 2)]


def test_count_windows_stream(spark, tmp_path):
    src = line_stream(spark, replay_lines([f"a {i}" for i in range(1, 8)], str(tmp_path / "in")), per_batch=3)
    parsed = src.select(F.split("value", " ")[0].alias("k"), F.split("value", " ")[1].cast("long").alias("n"))
    sliding = count_window_stream(parsed, "k", "n", "n", 5, slide=2)
    assert [r.sum for _, rs in run_available(sliding, "cw_slide") for r in rs] == [3, 10, 20]
    tumbling = count_window_stream(parsed, "k", "n", "n", 5)
    assert [r.sum for _, rs in run_available(tumbling, "cw_tumble") for r in rs] == [15]


@pytest.mark.parametrize("slide", [None, 2, 3])
def test_count_window_stream_equals_batch(spark, tmp_path, slide):
    import random

    from streamkit.operators import count_window

    rng = random.Random(slide or 0)
    rows = [(rng.choice("abc"), i, rng.randrange(100)) for i in range(1, 60)]
    src = line_stream(spark, replay_lines([f"{k} {i} {v}" for k, i, v in rows], str(tmp_path / "in")), per_batch=7)
    parts = F.split("value", " ")
    parsed = src.select(parts[0].alias("k"), parts[1].cast("long").alias("seq"), parts[2].cast("long").alias("v"))
    streamed = count_window_stream(parsed, "k", "seq", "v", 5, slide=slide, name="s")
    got = sorted((r.k, r.window_end_count, r.s) for _, rs in run_available(streamed, f"cw_eq_{slide}") for r in rs)
    batch_df = spark.createDataFrame(rows, "k string, seq long, v long")
    want = count_window(batch_df, "k", "seq", 5, [Agg("sum", F.col("v"), "s")], slide=slide, blocks=1)
    assert got == sorted((r.k, r.window_end_count, r.s) for r in want.collect())


def _keyed_lines(spark, tmp_path, rows, per_batch):
    lines = [f"{k} {i} {v} {t}" for k, i, v, t in rows]
    src = line_stream(spark, replay_lines(lines, str(tmp_path / "in")), per_batch=per_batch)
    p = F.split("value", " ")
    return src.select(p[0].alias("k"), p[1].cast("long").alias("seq"), p[2].cast("long").alias("v"), p[3].alias("t"))


def test_rolling_max_by_stream_matches_batch(spark, tmp_path):
    import random

    from streamkit.operators import rolling_extreme_by
    from streamkit.streaming import rolling_extreme_by_stream

    rng = random.Random(5)
    rows = [(rng.choice("ab"), i, rng.randrange(10), f"t{i}") for i in range(1, 40)]
    for kind in ("max", "min"):
        streamed = rolling_extreme_by_stream(_keyed_lines(spark, tmp_path / kind, rows, 6), "k", "seq", "v", ["t", "v"],
                                             kind)
        got = sorted((r.seq, r.best_t, r.best_v) for _, rs in run_available(streamed, f"rmb_{kind}") for r in rs)
        batch = spark.createDataFrame(rows, "k string, seq long, v long, t string")
        want = rolling_extreme_by(batch, "k", "seq", "v", ["t", "v"], kind, prefix="best_", blocks=1)
        assert got == sorted((r.seq, r.best_t, r.best_v) for r in want.collect())


def test_rolling_reduce_and_python_fold_stream(spark, tmp_path):
    from streamkit.streaming import rolling_reduce_stream

    rows = [("a", 1, 1, "JAVA"), ("a", 2, 1, "JVM"), ("b", 3, 1, "MYSQL"), ("a", 4, 1, "JUC"), ("b", 5, 1, "NIO")]
    src = _keyed_lines(spark, tmp_path / "r", rows, 2)
    out = rolling_reduce_stream(src, "k", "seq", "v", "t", label=lambda k: "J" if k == "a" else "N")
    got = sorted((r.seq, r.t, r.v) for _, rs in run_available(out, "rreduce") for r in rs)
    assert got == [(1, "JAVA", 1), (2, "J", 2), (3, "MYSQL", 1), (4, "J", 3), (5, "N", 2)]
    src = _keyed_lines(spark, tmp_path / "f", rows, 2)
    out = rolling_reduce_stream(src, "k", "seq", "v", "t", label=None, step=lambda acc, v: acc * 2 + v, initial=0)
    got = sorted((r.seq, r.v) for _, rs in run_available(out, "rfold") for r in rs)
    assert got == [(1, 1), (2, 3), (3, 1), (4, 7), (5, 3)]


def test_batch_api_accepts_streams(spark, tmp_path):
    """The same operator calls work on a streaming frame (dispatch to the
    stateful twins) and give the batch results."""
    from streamkit.operators import (
        Agg as A, count_window, rolling_extreme, rolling_extreme_by, rolling_fold, rolling_reduce, rolling_sum,
    )

    rows = [("a", 1, 5, "x"), ("b", 2, 3, "y"), ("a", 3, 7, "z"), ("a", 4, 7, "w"), ("b", 5, 1, "v"), ("a", 6, 2, "u")]
    batch = spark.createDataFrame(rows, "k string, seq long, v long, t string")
    label = F.when(F.col("k") == "a", F.lit("A")).otherwise(F.lit("B"))
    calls = {
        "sum": lambda d: rolling_sum(d, "k", "seq", "v", carry=["t"]),
        "fold": lambda d: rolling_fold(d, "k", "seq", "v", 100, name="f"),
        "reduce": lambda d: rolling_reduce(d, "k", "seq", "v", "t", label),
        "max": lambda d: rolling_extreme(d, "k", "seq", "v", "max", name="m", carry=["t"]),
        "maxby": lambda d: rolling_extreme_by(d, "k", "seq", "v", ["t", "v"], "max", prefix="best_"),
        "count": lambda d: count_window(d, "k", "seq", 2, [A("sum", F.col("v"), "s")]),
    }
    for name, call in calls.items():
        stream = _keyed_lines(spark, tmp_path / name, rows, 2)
        got = [tuple(r.asDict()[c] for c in sorted(r.asDict())) for _, rs in run_available(call(stream), f"api_{name}")
               for r in rs]
        want = [tuple(r.asDict()[c] for c in sorted(r.asDict())) for r in call(batch).collect()]
        assert sorted(got) == sorted(want), name


def test_stateful_operators_across_arrow_chunks(spark, tmp_path):
    """A key's rows of one micro-batch arrive in several Arrow chunks and out
    of order; the results still equal the batch results."""
    from streamkit.operators import Agg as A, count_window, rolling_extreme_by, rolling_sum

    rows = [("a" if i % 3 else "b", i, (i * 7) % 11, f"t{i}") for i in range(1, 41)]
    batch = spark.createDataFrame(rows, "k string, seq long, v long, t string")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        calls = {
            "sum": lambda d: rolling_sum(d, "k", "seq", "v", carry=["t"]),
            "maxby": lambda d: rolling_extreme_by(d, "k", "seq", "v", ["t"], "max", prefix="best_"),
            "count": lambda d: count_window(d, "k", "seq", 4, [A("sum", F.col("v"), "s")], slide=3),
        }
        for name, call in calls.items():
            stream = _keyed_lines(spark, tmp_path / name, rows, 100)
            got = sorted(tuple(sorted(r.asDict().items())) for _, rs in run_available(call(stream), f"chunks_{name}")
                         for r in rs)
            want = sorted(tuple(sorted(r.asDict().items())) for r in call(batch).collect())
            assert got == want, name
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_connect_co_map_on_streams(spark, tmp_path):
    from streamkit.operators import connect

    words = line_stream(spark, replay_lines(["Spring", "Redis"], str(tmp_path / "w")))
    nums = line_stream(spark, replay_lines(["1", "2", "3"], str(tmp_path / "n")))
    nums = nums.select(F.col("value").cast("int").alias("i"))
    out = connect(words, nums).co_map(lambda d: F.lower(d["value"]), lambda d: d["i"] * 10)
    rows = [r for _, rs in run_available(out, "co_map_stream") for r in rs]
    assert sorted(r.v1 for r in rows if r.side == 1) == ["redis", "spring"]
    assert sorted(r.v2 for r in rows if r.side == 2) == [10, 20, 30]


@pytest.mark.parametrize("kind", ["count", "fold", "max", "min"])
def test_count_window_stream_kinds(spark, tmp_path, kind):
    import random

    from streamkit.operators import count_window

    rng = random.Random(11)
    rows = [(rng.choice("ab"), i, rng.randrange(50)) for i in range(1, 40)]
    src = line_stream(spark, replay_lines([f"{k} {i} {v}" for k, i, v in rows], str(tmp_path / "in")), per_batch=6)
    p = F.split("value", " ")
    parsed = src.select(p[0].alias("k"), p[1].cast("long").alias("seq"), p[2].cast("long").alias("v"))
    from streamkit.operators import Agg as A

    agg = A(kind, None if kind == "count" else F.col("v"), "x", initial=100)
    for slide in (None, 2):
        streamed = count_window(parsed, "k", "seq", 5, [agg], slide=slide)
        got = sorted((r.k, r.window_end_count, r.x) for _, rs in run_available(streamed, f"cwk_{kind}_{slide}")
                     for r in rs)
        batch = spark.createDataFrame(rows, "k string, seq long, v long")
        want = count_window(batch, "k", "seq", 5, [agg], slide=slide, blocks=1)
        assert got == sorted((r.k, r.window_end_count, r.x) for r in want.collect()), (kind, slide)
