import datetime as dt
import random

from pyspark.sql import functions as F


from streamkit.functions import random_int
from streamkit.plans.programs import concat_windows, growth_table, windowed_word_count
from streamkit.plans.streams import drain_ordered
from streamkit.sources.ordered import time_ordered_stream
from streamkit.streaming.event_time import assign_event_time
from streamkit.streaming import line_stream, replay_lines, run_available


def test_word_count_program_event_time(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 0)
    df = spark.createDataFrame([("a b a", t), ("b", t + dt.timedelta(seconds=3))], "value string, ts timestamp_ntz")
    out = windowed_word_count(df, time_col="ts").collect()
    counts = {(r.word, r.window_start): r["count"] for r in out}
    assert counts[("a", t - dt.timedelta(seconds=4))] == 2
    assert counts[("b", t - dt.timedelta(seconds=1))] == 2
    assert counts[("b", t + dt.timedelta(seconds=1))] == 1
    assert len(out) == 13  # a: 5 windows; b: t-4 .. t+3 = 8 windows


def test_word_count_program_processing_time_stream(spark, tmp_path):
    src = line_stream(spark, replay_lines(["to be or", "not to be"], str(tmp_path / "in")), per_batch=2)
    out = windowed_word_count(src)
    batches = run_available(out, "proc_time_wc", output_mode="update")
    totals = {}
    for _, rows in batches:
        for r in rows:
            totals[(r.word, r.window_start)] = r["count"]
    per_word = {}
    for (w, _), c in totals.items():
        per_word[w] = max(per_word.get(w, 0), c)
    assert per_word == {"to": 2, "be": 2, "or": 1, "not": 1}


def test_concat_windows(spark):
    t = dt.datetime(1970, 1, 1, 0, 0, 1)
    df = spark.createDataFrame([(1, "ab", t), (2, "c", t + dt.timedelta(seconds=1))], "seq long, value string, ts timestamp_ntz")
    out = {r.window_start: (r.concat, r.total_len) for r in concat_windows(df, time_col="ts", order=("seq",)).collect()}
    assert out[t - dt.timedelta(seconds=3)] == ("abc", 3)


def test_growth_table_and_random(spark):
    df = spark.createDataFrame([(150000.0,)], "bal double")
    row = growth_table(df, "bal").first()
    assert row.total == 173182.86507551113 and row.per_period == 4810.63514098642
    vals = [r.v for r in spark.range(200).select(random_int(10, seed=3).alias("v")).collect()]
    assert min(vals) >= 0 and max(vals) <= 9 and len(set(vals)) > 5


def test_words_of_a_window_share_few_state_rows(spark, tmp_path):
    lines = [(1, "a b a"), (1, ""), (2, " b  c\t"), (2, None), (3, "é A a"), (4, "   "), (7, " ".join(f"w{i % 300}" for i in range(400)))]
    table = spark.createDataFrame(lines, "ts long, value string").withColumn("ts", F.timestamp_seconds("ts")).coalesce(1)
    want = {tuple(r) for r in windowed_word_count(table, time_col="ts").collect()}
    progress = []
    ordered = time_ordered_stream(table, "ts", str(tmp_path / "parts"))
    out = windowed_word_count(assign_event_time(ordered, "ts", "5 seconds"), time_col="ts", word_parts=3)
    assert {tuple(r) for r in drain_ordered(out, "few_state_rows", progress).collect()} == want
    windows = len({r[1] for r in want}) + 5  # and those of the closing row
    assert max(op.numRowsTotal for p in progress for op in p.stateOperators) <= 3 * windows < len(want)


def test_lines_of_a_span_are_held_once(spark, tmp_path):
    """Spans give the rows of windows of their own: gaps, a hot second over many
    Arrow batches, sizes that the slide does not divide."""
    rng = random.Random(7)
    lines = [(rng.randrange(90), " ".join(f"w{int(rng.expovariate(0.1))}" for _ in range(rng.randrange(9)))) for _ in range(150)]
    lines += [(30, f"a  b w{i} ") for i in range(60)] + [(200, "far away"), (200, None), (None, "lost"), (3, ""), (3, " \t"), (4, "é\u00a0x\nb")]
    table = spark.createDataFrame(lines, "ts long, value string").withColumn("ts", F.timestamp_seconds("ts"))
    held, old = {}, spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for size, slide, span, parts in (("5 seconds", "1 second", 1, 2), ("5 seconds", "1 second", 16, 2), ("5 seconds", "1 second", 16, 1), ("7 seconds", "3 seconds", 4, 3), ("40 seconds", "1 second", 8, 1)):
            want = sorted(map(str, windowed_word_count(table, time_col="ts", size=size, slide=slide).collect()))
            ordered = time_ordered_stream(table, "ts", str(tmp_path / f"{slide}_{size}_{span}_{parts}"), batches=3)
            out = windowed_word_count(assign_event_time(ordered, "ts", "5 seconds"), time_col="ts", size=size, slide=slide, word_parts=parts, span=span)
            progress = []
            assert sorted(map(str, drain_ordered(out, "spans", progress).collect())) == want and want, (size, slide, span, parts)
            held[size, span] = max(op.memoryUsedBytes for p in progress for op in p.stateOperators)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert held["5 seconds", 16] < held["5 seconds", 1] / 2


def test_counts_of_a_window_come_in_bounded_batches(monkeypatch):
    import pyarrow as pa

    from streamkit.plans import programs

    monkeypatch.setattr(programs, "_ROWS", 10)
    batch = pa.RecordBatch.from_arrays([pa.array([0, 0, 2]), pa.array([0, 0, 0]), pa.array([1, 0, 2]), pa.array(["\n".join(f"w{i % 37}" for i in range(50)), "x\n\nx", "x"])], names=["_k", "_part", "at", "words"])
    empty = batch.slice(0, 0)
    got = list(programs.count_words(iter([empty, batch.slice(0, 1), batch.slice(1, 1), empty, batch.slice(2)]), 2, 1, 2))
    assert max(b.num_rows for b in got) < 20
    rows = sorted((r["_k"], r["word"], r["count"]) for b in got for r in b.to_pylist())
    words = {f"w{i}": 2 if i < 13 else 1 for i in range(37)}
    assert rows == sorted([(0, w, n) for w, n in (words | {"x": 2, "": 1}).items()] + [(1, w, n) for w, n in words.items()] + [(2, "x", 1)])
    assert list(programs.count_words(iter([]), 2, 1, 2)) == []


def test_state_of_the_word_count_does_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    """Long lines of few bytes of Parquet: micro-batches are cut by what the state holds."""
    from streamkit.plans import streams
    from streamkit.sources import ordered

    monkeypatch.setattr(ordered, "TASK_WEIGHT", 40_000, raising=False)
    drain, held = streams.drain_ordered, {}
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(300)), lambda i: F.concat(F.lit("w"), (F.pmod(F.hash("doc_id"), F.lit(3)) + i).cast("string"))))
    for n in (500, 2_000):
        path, progress = str(tmp_path / str(n)), []
        spark.range(n).select(F.col("id").alias("doc_id")).select("doc_id", text.alias("text")).coalesce(1).write.parquet(f"{path}/documents.parquet")
        monkeypatch.setattr(streams, "drain_ordered", lambda df, name: drain(df, name, progress))  # noqa: B023
        got = streams.stream_windowed_word_count(spark, path)
        docs = spark.read.parquet(f"{path}/documents.parquet").select(F.timestamp_seconds("doc_id").alias("ts"), "text")
        want = windowed_word_count(docs, text_col="text", time_col="ts")
        digest = lambda d: d.agg(F.count("*"), F.sum(F.hash("word", F.unix_seconds(F.col("window_start").cast("timestamp")), "count").cast("long"))).first()
        assert digest(got) == digest(want)
        held[n] = max(op.memoryUsedBytes for p in progress for op in p.stateOperators)
    assert held[2_000] < 1.5 * held[500]
