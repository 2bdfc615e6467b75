"""Streams against the batch operators on nullable, decimal and double data,
from tables of several files, in several micro-batches."""

import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from streamkit.operators import Agg, count_window, rolling_extreme, rolling_extreme_by, rolling_fold, rolling_reduce, rolling_sum
from streamkit.plans.streams import drain_to_table, stream_session
from streamkit.streaming.replay import table_stream
from streamkit.streaming.run import run_available

BATCHES = 6
KINDS = {"long": "bigint", "double": "double", "decimal": "decimal(20,2)"}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A table of six part files whose modification times follow ``seq``."""
    rng = random.Random(12)
    path = str(tmp_path_factory.mktemp("table"))
    rows = []
    for i in range(240):
        gone = rng.random() < 0.25
        rows.append((i, rng.choice(["a", "a", "b", None]), None if gone else rng.randrange(-2 ** 60, 2 ** 60), None if gone else rng.choice([1e17, 0.1, -1e17, 0.3]),
                     None if gone else Decimal(rng.randrange(-10 ** 9, 10 ** 9)).scaleb(-2), f"t{i}"))
    schema = "seq long, k string, long long, double double, decimal decimal(20,2), t string"
    for b in range(BATCHES):
        part = spark.createDataFrame(rows[b * 40:(b + 1) * 40], schema)
        part.coalesce(1).write.mode("append").parquet(f"{path}/items.parquet")
        for name in os.listdir(f"{path}/items.parquet"):
            full = f"{path}/items.parquet/{name}"
            if os.stat(full).st_mtime > 1e9 + 10 ** 6:
                os.utime(full, (10 ** 9 + b, 10 ** 9 + b))
    return path


def both(spark, folder, name, call):
    batch = call(spark.read.parquet(f"{folder}/items.parquet"))
    batches = run_available(call(table_stream(spark, folder, "items", max_files=1)), name)
    assert len([b for b, rows in batches if rows]) >= 5 or "count" in name
    got = [r for _, rows in batches for r in rows]
    assert sorted(got[0].asDict()) == sorted(batch.columns) if got else True
    key = lambda r: sorted((c, str(v)) for c, v in r.asDict().items())
    return sorted(map(key, got)), sorted(map(key, batch.collect())), batch.schema


@pytest.mark.parametrize("field", sorted(KINDS))
def test_rolling_operators(spark, folder, field):
    label = F.when(F.col("k") == "a", F.lit("A")).otherwise(F.lit("B"))
    keep = lambda d: d.select("seq", "k", F.col(field).alias("v"), "t")
    calls = {
        "max": lambda d: rolling_extreme(keep(d), "k", "seq", "v", "max", name="m", carry=["t"]),
        "min": lambda d: rolling_extreme(keep(d), "k", "seq", "v", "min", name="m"),
        "minby": lambda d: rolling_extreme_by(keep(d), "k", "seq", "v", ["t", "v"], "min", prefix="best_", **({} if d.isStreaming else {"blocks": 1})),
    }
    if field != "long":  # sums of such longs overflow
        calls |= {
            "sum": lambda d: rolling_sum(keep(d), "k", "seq", "v", name="s", carry=["t"], **({} if d.isStreaming else {"blocks": 1})),
            "reduce": lambda d: rolling_reduce(keep(d), "k", "seq", "v", "t", label, **({} if d.isStreaming else {"blocks": 1})),
        }
    for name, call in calls.items():
        got, want, _ = both(spark, folder, f"exact_{field}_{name}", call)
        assert got == want, name


def test_fold_from_a_fraction_over_longs(spark, folder):
    small = lambda d: d.select("seq", "k", (F.col("long") % 1000).alias("v"))
    got, want, schema = both(spark, folder, "exact_fold", lambda d: rolling_fold(small(d), "k", "seq", "v", 0.5, name="f", **({} if d.isStreaming else {"blocks": 1})))
    assert got == want and schema["f"].dataType.simpleString() == "double"


@pytest.mark.parametrize("field", sorted(KINDS))
@pytest.mark.parametrize("slide", [None, 2])
def test_count_windows(spark, folder, field, slide):
    value = F.col(field) % 1000 if field == "long" else F.col(field)
    for kind in ("sum", "max", "min", "count"):
        agg = Agg(kind, value, "x")
        got, want, _ = both(spark, folder, f"exact_count_{field}_{kind}_{slide}", lambda d: count_window(d, "k", "seq", 5, [agg], slide=slide))
        if field == "double" and kind == "sum":  # addition order of a window may differ
            assert len(got) == len(want)
        else:
            assert got == want, kind


def test_a_folder_is_read_whole(spark, folder):
    own = stream_session(spark)
    assert drain_to_table(table_stream(own, folder, "items"), "whole_folder").count() == 240
    assert own.conf.get("spark.sql.shuffle.partitions") == str(spark.sparkContext.defaultParallelism)


def test_window_streams_of_a_folder_close_all_windows(spark, tmp_path):
    """A registered stream over a table of four part files equals the batch query."""
    from streamkit.plans.queries import QUERIES

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    for stream, batch in (("stream_tumbling_sum", "tumbling_sum"), ("stream_session_by_user", "session_by_user"), ("stream_global_concat", "global_concat")):
        a, b = QUERIES[stream](spark, str(tmp_path)), QUERIES[batch](spark, str(tmp_path))
        a = a.select(*b.columns)
        assert a.count() == b.count() and a.exceptAll(b).count() == 0, stream


def test_window_streams_do_not_depend_on_batches_and_order(spark, tmp_path, monkeypatch):
    """Part files in no order of time, each a micro-batch of its own: nothing is late."""
    from streamkit.plans.queries import QUERIES
    from streamkit.streaming import replay

    whole = "/root/testdata/sf0.001"
    for table, time in (("events", "ts"), ("documents", "doc_id")):
        rows, path = spark.read.parquet(f"{whole}/{table}.parquet"), f"{tmp_path}/{table}.parquet"
        rows.repartitionByRange(4, time).write.parquet(path)
        parts = sorted(x for x in os.listdir(path) if x.endswith(".parquet"))
        assert len(parts) == 4
        for i, part in enumerate(reversed(parts)):  # the latest times first
            os.utime(f"{path}/{part}", (10 ** 9 + i, 10 ** 9 + i))
    monkeypatch.setattr(replay, "BATCH_BYTES", "1")
    assert len(run_available(table_stream(spark, str(tmp_path), "events"), "by_part")) == 4
    for name in ("stream_tumbling_sum", "stream_tumbling_max", "stream_tumbling_fold", "stream_sliding_count", "stream_global_concat",
                 "stream_session_by_user", "stream_windowed_word_count"):
        want, got = QUERIES[name](spark, whole), QUERIES[name](spark, str(tmp_path))
        assert want.count() == got.count() and got.exceptAll(want).count() == want.exceptAll(got).count() == 0, name
