import datetime as dt
import random

import pytest

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from streamkit.operators import Agg, count_window, session_window, time_window, windows
from streamkit.plans.programs import windowed_word_count

T0 = dt.datetime(1970, 1, 1)


def _ms(ms):
    return T0 + dt.timedelta(milliseconds=ms)


def test_count_windows_fixture(spark):
    df = spark.createDataFrame([(i, "a", i) for i in range(1, 8)], "seq long, key string, n long")
    for blocks in (1, 2):
        tumbling = count_window(df, "key", "seq", 5, [Agg("sum", F.col("n"), "n")], blocks=blocks).collect()
        assert [(r.window_end_count, r.n) for r in tumbling] == [(5, 15)]
        sliding = count_window(df, "key", "seq", 5, [Agg("sum", F.col("n"), "n")], slide=2,
                               blocks=blocks).orderBy("window_end_count").collect()
        assert [r.n for r in sliding] == [3, 10, 20]


def test_session_boundaries(spark):
    rows = [("a", 0), ("a", 5000), ("a", 10001), ("b", 0), ("b", 4999)]
    df = spark.createDataFrame([(k, _ms(ms)) for k, ms in rows], "key string, ts timestamp_ntz")
    for blocks in (1, 3):
        out = session_window(df, "key", "ts", "5 seconds", [Agg("count", None, "n")],
                             blocks=blocks).orderBy("key", "session_start").collect()
        got = [(r.key, r.session_start, r.session_end, r.n) for r in out]
        assert got == [("a", _ms(0), _ms(10000), 2), ("a", _ms(10001), _ms(15001), 1), ("b", _ms(0), _ms(9999), 2)]


def test_session_matches_builtin(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(3), _ms(rng.randrange(0, 200_000))) for _ in range(300)]
    df = spark.createDataFrame(rows, "key long, ts timestamp_ntz").withColumn("id", F.monotonically_increasing_id())
    ours = session_window(df, "key", "ts", "7 seconds", [Agg("count", None, "n")], tiebreak=("id",), blocks=20)
    builtin = df.groupBy("key", F.session_window("ts", "7 seconds").alias("s")).agg(F.count("*").alias("n")).select(
        "key", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")
    assert sorted(ours.collect()) == sorted(builtin.collect())


def test_global_concat_fixture(spark):
    df = spark.createDataFrame([(1, "ab", _ms(1000)), (2, "c", _ms(2000))], "seq long, s string, ts timestamp_ntz")
    out = time_window(df, None, "ts", "5 seconds",
                      [Agg("concat", F.col("s"), "concat", order=("ts", "seq")),
                       Agg("sum", F.length("s"), "len")], slide="1 second").orderBy("window_start").collect()
    got = {r.window_start: (r.concat, r.len) for r in out}
    assert got[_ms(-3000)] == ("ab", 2)
    assert got[_ms(-2000)] == ("abc", 3)
    assert len(out) == 6


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([(10, 5), (5, 2), (50, 20), (6, 6)]))
def test_panes_equal_native_sliding(spark, seed, size_slide):
    size, slide = size_slide
    rng = random.Random(seed)
    rows = [(rng.randrange(4), _ms(rng.randrange(0, 100_000)), rng.randrange(100)) for _ in range(200)]
    df = spark.createDataFrame(rows, "key long, ts timestamp_ntz, v long")
    aggs = [Agg("sum", F.col("v"), "s"), Agg("count", None, "c"), Agg("max", F.col("v"), "m"),
            Agg("fold", F.lit(1), "f", initial=100)]
    kw = dict(size=f"{size} seconds", slide=f"{slide} seconds")
    panes = time_window(df, "key", "ts", aggs=aggs, **kw).collect()
    native = time_window(df, "key", "ts", aggs=aggs, panes=False, **kw).collect()
    assert sorted(panes) == sorted(native)


def test_results_do_not_depend_on_session_zone(spark):
    """NTZ arithmetic must be zone-free: a daylight-saving gap in the session
    zone must not reorder rows or change gaps."""
    base = dt.datetime(2024, 3, 10, 1, 0, 0)
    rows = [("k", base + dt.timedelta(minutes=15 * i), i) for i in range(12)]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, v long")

    def run():
        s = session_window(df, "key", "ts", "20 minutes", [Agg("count", None, "n")], blocks=2).collect()
        from streamkit.operators import Scan, keyed_scan
        r = keyed_scan(df, ["key"], ["ts"], [Scan("sum", "v", "run"), Scan("prev", "ts", "p")], blocks=2)
        return sorted(s), sorted(r.collect())

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        in_ny = run()
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        in_utc = run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert in_ny == in_utc
    assert len(in_utc[0]) == 1 and in_utc[0][0].n == 12


def _frames(spark, n=400, seed=4):
    import random

    rng = random.Random(seed)
    rows = [(i, rng.choice("ab"), rng.choice([None, rng.random() * 10 ** rng.randrange(-3, 17)]), f"t{i}") for i in range(n)]
    return rows, spark.createDataFrame(rows, "seq long, key string, v double, t string")


@pytest.mark.parametrize("size,slide", [(100, 1), (5, 2), (70, 3), (3, 7)])
def test_long_sliding_count_windows_for_every_aggregate(spark, monkeypatch, size, slide):
    """Each window's own rows are aggregated, however many windows a row is in."""
    import streamkit.operators.windows as W

    rows, df = _frames(spark)
    monkeypatch.setattr(W, "STRETCH", 1)  # stretches of 8 sizes, so that rows are copied
    aggs = [Agg("sum", F.col("v"), "s"), Agg("max", F.col("v"), "m"), Agg("count", F.col("v"), "n"), Agg("concat", F.col("t"), "c", order=("seq",)),
            Agg("min_by", F.col("t"), "b", order=("seq",), by=F.col("v"))]
    got = {(r.key, r.window_end_count): (r.s, r.m, r.n, r.c, r.b) for r in count_window(df, "key", "seq", size, aggs, slide=slide).collect()}
    want = {}
    for k in "ab":
        mine = [r for r in rows if r[1] == k]
        for e in range(slide, len(mine) + 1, slide):
            w = mine[max(0, e - size):e]
            v = [r[2] for r in w if r[2] is not None]
            best = min((r for r in w if r[2] is not None), key=lambda r: (r[2], r[0]), default=None)
            want[k, e] = (v, max(v, default=None), len(v), "".join(r[3] for r in w), best and best[3])
    assert set(got) == set(want)
    for at, (v, *rest) in want.items():
        assert list(got[at][1:]) == rest
        assert got[at][0] is None if not v else got[at][0] == pytest.approx(sum(v), rel=1e-12)


@pytest.mark.parametrize("size,slide", [(70, 1), (7, 3), (1, 2), (500, 9)])
def test_suffixes_and_prefixes_give_the_windows(spark, monkeypatch, size, slide):
    """Windows merged of two running aggregates, over several stretches and
    cuts, also of null values, null keys and keys shorter than a window."""
    import streamkit.operators.windows as W

    _, df = _frames(spark)
    df = df.withColumn("key", F.when(F.col("seq") % 37 != 0, F.col("key"))).withColumn("v", F.round("v"))
    aggs = [Agg("sum", F.col("v"), "s"), Agg("fold", F.col("seq"), "f", initial=100), Agg("max", F.col("v"), "m"), Agg("count", F.col("v"), "n"),
            Agg("count", None, "rows"), Agg("min", F.col("t"), "t"), Agg("min_by", F.col("t"), "b", order=("seq",), by=F.col("v")),
            Agg("max_by", F.col("t"), "c", order=("seq",), by=F.col("v"))]
    want = sorted(map(str, count_window(df, "key", "seq", size, aggs, slide=slide).drop("s").collect()))
    monkeypatch.setattr(W, "STRETCH", 1)
    monkeypatch.setattr(W, "LONG", 1)
    got = count_window(df, "key", "seq", size, aggs, slide=slide)
    assert sorted(map(str, got.drop("s").collect())) == want and want


def test_sliding_windows_take_one_shuffle(spark):
    """Whole buckets of windows are held by one aggregation; its plan has one
    exchange, with partials before it."""
    df = spark.range(500).select((F.col("id") % 3).alias("k"), F.timestamp_micros(F.col("id") * 700_000 - 90_000_000).alias("ts"),
                                 F.when(F.col("id") % 5 != 0, F.col("id")).alias("v"))
    aggs = [Agg("sum", F.col("v"), "s"), Agg("max", F.col("v"), "m"), Agg("count", F.col("v"), "n"), Agg("fold", F.col("v"), "f", initial=100)]
    one = time_window(df, "k", "ts", "5 seconds", aggs, slide="1 second")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("HashAggregate") == 2
    two = time_window(df, "k", "ts", "5 seconds", [*aggs, Agg("min", F.col("v"), "x")], slide="1 second").drop("x")
    assert two._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_windows_of_elements_move_values_whole(spark, monkeypatch):
    """The words of a span are counted where its lines meet: no word is moved,
    and spans of many bytes, counted by word, give the same rows."""
    rng = random.Random(2)
    lines = [(_ms(rng.randrange(-90_000, 200_000)), " ".join(f"w{int(rng.expovariate(0.1))}" for _ in range(rng.randrange(12)))) for _ in range(300)]
    lines += [(_ms(3_000), "a b a " * 40)] * 2 + [(_ms(64_000), ""), (_ms(5), None), (None, "lost"), (_ms(-1), "  a")]
    df = spark.createDataFrame(lines, "ts timestamp_ntz, value string")
    aggs = [Agg("count", None, "n"), Agg("max", F.length("value"), "m")]
    for size, slide in (("5 seconds", "1 second"), ("7 seconds", "3 seconds"), ("4 seconds", "4 seconds"), ("40 seconds", "1 second")):
        want = time_window(df.withColumn("word", F.explode(F.split("value", " "))), "word", "ts", size, aggs, slide=slide)
        want = sorted(map(str, want.collect()))
        out = lambda: windows.element_windows(df, "value", F.split("value", " "), "word", "ts", size, slide, aggs)  # noqa: B023, E731
        assert sorted(map(str, out().collect())) == want and want
        with monkeypatch.context() as m:
            m.setattr(windows, "TASK", 300)
            m.setattr(windows, "HOT", 1_200)
            assert sorted(map(str, out().collect())) == want
    counted = windowed_word_count(df, time_col="ts")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(word" not in counted and counted.count("Exchange") == 1


def test_time_windows_without_limits(spark):
    """Thousands of windows per row, gaps between windows, times before 1970,
    rows without a time."""
    df = spark.createDataFrame([(1, "1969-12-31 23:59:59.5"), (2, "1970-01-01 00:00:10"), (3, None)], "v long, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    out = time_window(df, None, "ts", "2 hours", [Agg("sum", F.col("v"), "s")], slide="1 second")
    assert out.count() == 7211 and out.where("s = 3").count() == 7189
    out = time_window(df, None, "ts", "2 seconds", [Agg("sum", F.col("v"), "s")], slide="5 seconds").collect()
    assert [(str(r.window_start), r.s) for r in out] == [("1970-01-01 00:00:10", 2)]
    out = time_window(df, None, "ts", "1 second", [Agg("count", None, "n")]).orderBy("window_start").collect()
    assert [str(r.window_start) for r in out] == ["1969-12-31 23:59:59", "1970-01-01 00:00:10"]


def test_sessions_leave_out_rows_without_a_time(spark):
    df = spark.createDataFrame([(None, "a"), ("2020-01-01 00:00:00", "a"), ("2020-01-01 00:00:05", "a")], "ts string, k string").withColumn("ts", F.col("ts").cast("timestamp"))
    out = session_window(df, "k", "ts", "10 seconds", [Agg("count", None, "n")]).collect()
    assert [r.n for r in out] == [2]


@pytest.mark.parametrize("blocks", [1, 2, 5, 60])
def test_sessions_however_they_are_cut(spark, blocks):
    import random

    rng, at = random.Random(8), 0
    rows = []
    for i in range(300):
        at += rng.choice([0, 1, 2, 9, 30])
        rows.append((i, rng.choice(["a", "a", None]), at))
    df = spark.createDataFrame(rows, "id long, k string, at long").withColumn("ts", F.timestamp_seconds("at"))
    out = session_window(df, "k", "ts", "5 seconds", [Agg("count", None, "n"), Agg("concat", F.col("id").cast("string"), "ids", order=("ts", "id"), sep=" ")], tiebreak=("id",), blocks=blocks)
    got = sorted((r.k or "", int(r.session_start.timestamp()), int(r.session_end.timestamp()), r.n, r.ids.replace(" ", ",")) for r in out.collect())
    want = []
    for k in ("a", None):
        mine, cur = [r for r in rows if r[1] == k], []
        for r in mine + [(None, None, 10 ** 9)]:
            if cur and r[2] - cur[-1][2] > 5:
                want.append((k or "", cur[0][2], cur[-1][2] + 5, len(cur), ",".join(str(x[0]) for x in cur)))
                cur = []
            cur.append(r)
    assert [g[:4] for g in got] == [w[:4] for w in sorted(want)]


def test_python_reduce_on_windows(spark):
    from streamkit.operators.windows import count_window_fold, time_window_fold

    rows = [("a", 1, 5), (None, 2, 3), ("a", 3, 7), (None, 4, 4), ("a", 61, 2)]
    df = spark.createDataFrame(rows, "k string, at long, v long").withColumn("ts", F.timestamp_seconds("at"))
    step = lambda acc, r: {**acc, "v": acc["v"] * 3 - r["v"]}
    out = time_window_fold(df, "k", "ts", "1 minute", ["at"], step, "v long").collect()
    assert sorted((r.k or "", int(r.window_start.timestamp()), r.v) for r in out) == [("", 0, 5), ("a", 0, 8), ("a", 60, 2)]
    out = count_window_fold(df, 0, ["at"], 2, step, "v long").collect()
    assert sorted((r.k or "", r.window_end_count, r.v) for r in out) == [("", 2, 5), ("a", 2, 8)]
