import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from streamkit.functions.text import cased_tokens
from streamkit.operators import (
    Scan, key_by, keyed_scan, rolling_extreme, rolling_extreme_by, rolling_fold, rolling_map_in_pandas,
    rolling_reduce, rolling_sum,
)
from streamkit.operators.transform import flat_map

J_WORDS = ["JAVA", "JAVAWEB", "JAVA8", "JVM", "JUC", "LOG4J", "SLF4J", "JENKINS"]


def _tuples(lines_df):
    """(word UPPER, 1) per token, ordered by (line, position), keyed by contains('J')."""
    toks = flat_map(lines_df, cased_tokens(F.col("value")), name="word", keep=("seq",))
    toks = toks.select((F.col("seq") * 2 + F.col("pos")).alias("seq"), "word", F.lit(1).alias("n"))
    return key_by(toks, F.col("word").contains("J"), "key")


@pytest.fixture(params=[1, 3], ids=["plain", "blocked"])
def blocks(request):
    return request.param


def _by_key(rows, field):
    out = {True: [], False: []}
    for r in sorted(rows, key=lambda r: r.seq):
        out[r.key].append(r[field])
    return out


def test_key_by_groups(lines_df):
    rows = _tuples(lines_df).collect()
    assert len(rows) == 48
    assert sorted(r.word for r in rows if r.key) == sorted(J_WORDS)
    assert sum(not r.key for r in rows) == 40


def test_rolling_sum_carries_first_record(lines_df, blocks):
    out = rolling_sum(_tuples(lines_df), "key", "seq", "n", carry=["word"], blocks=blocks).collect()
    by = _by_key(out, "n")
    assert by[True] == list(range(1, 9)) and by[False] == list(range(1, 41))
    words = _by_key(out, "word")
    assert set(words[True]) == {"JAVA"} and set(words[False]) == {"MYSQL"}


def test_rolling_reduce_labels(lines_df, blocks):
    label = F.when(F.col("key"), F.lit("J")).otherwise(F.lit("N"))
    out = rolling_reduce(_tuples(lines_df), "key", "seq", "n", "word", label, blocks=blocks).collect()
    pairs = {k: list(zip(_by_key(out, "word")[k], _by_key(out, "n")[k])) for k in (True, False)}
    assert pairs[True] == [("JAVA", 1)] + [("J", i) for i in range(2, 9)]
    assert pairs[False] == [("MYSQL", 1)] + [("N", i) for i in range(2, 41)]


def test_rolling_fold(lines_df, blocks):
    out = rolling_fold(_tuples(lines_df), "key", "seq", "n", 100, blocks=blocks).collect()
    by = _by_key(out, "fold")
    assert by[True] == list(range(101, 109)) and by[False] == list(range(101, 141))


def test_rolling_max_word(lines_df, blocks):
    out = rolling_extreme(_tuples(lines_df), "key", "seq", "word", "max", name="max_word",
                          blocks=blocks).collect()
    assert _by_key(out, "max_word")[True] == ["JAVA", "JAVAWEB", "JAVAWEB", "JVM", "JVM", "LOG4J", "SLF4J", "SLF4J"]


def test_rolling_max_by_first_wins_ties(spark, blocks):
    df = spark.createDataFrame([(1, "k", 5, "a"), (2, "k", 7, "b"), (3, "k", 7, "c"), (4, "k", 3, "d"),
                                (5, "k", 9, "e")], "seq long, key string, v int, tag string")
    out = rolling_extreme_by(df, "key", "seq", "v", ["tag", "v"], "max", prefix="best_",
                             blocks=blocks).orderBy("seq").collect()
    assert [r.best_tag for r in out] == ["a", "b", "b", "b", "e"]
    out = rolling_extreme_by(df, "key", "seq", "v", ["tag"], "min", prefix="best_",
                             blocks=blocks).orderBy("seq").collect()
    assert [r.best_tag for r in out] == ["a", "a", "a", "d", "d"]


def test_rolling_python_step(spark):
    df = spark.createDataFrame([(i, i % 2, i) for i in range(20)], "seq long, key long, v long")
    out = rolling_map_in_pandas(df, "key", "seq", lambda acc, v: acc * 2 + v, 0, "v", "acc", "bigint").collect()
    for k in (0, 1):
        acc, expect = 0, []
        for i in range(k, 20, 2):
            acc = acc * 2 + i
            expect.append(acc)
        assert [r.acc for r in sorted(out, key=lambda r: r.seq) if r.key == k] == expect


@settings(max_examples=6, deadline=None)
@given(st.integers(min_value=0, max_value=10_000), st.integers(min_value=1, max_value=3))
def test_blocked_scan_equals_plain_window(spark, seed, n_keys):
    rng = random.Random(seed)
    n = 400
    ids = rng.sample(range(10 * n), n)
    rows = [(i, rng.choice([None, *range(n_keys)]) if rng.random() < 0.1 else rng.randrange(n_keys),
             rng.choice([None, rng.randrange(-50, 50)]), f"t{rng.randrange(5)}") for i in ids]
    df = spark.createDataFrame(rows, "seq long, key long, v long, tag string")
    scans = lambda: [Scan("sum", "v", "s"), Scan("count", None, "c"), Scan("max", "v", "mx"),
                     Scan("min", "v", "mn"), Scan("first", "tag", "f"), Scan("prev", "tag", "p"),
                     Scan("prev", "seq", "ps")]
    blocked = keyed_scan(df, ["key"], ["seq"], scans(), blocks=17).orderBy("seq").collect()
    plain = keyed_scan(df, ["key"], ["seq"], scans(), blocks=1).orderBy("seq").collect()
    assert blocked == plain
    w = Window.partitionBy("key").orderBy("seq")
    ref = df.select("seq", F.lag("tag").over(w).alias("p")).orderBy("seq").collect()
    assert [r.p for r in blocked] == [r.p for r in ref]


def _same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _largest(df, order, blocks, keys=("key",)):
    from streamkit.operators.scan import BLK, KEY, plan_blocks, with_blocks

    return with_blocks(df, plan_blocks(df, list(keys), order, blocks)).groupBy(KEY, BLK).count().agg(F.max("count")).first()[0]


SCANS = lambda: [Scan("sum", "v", "s"), Scan("count", None, "c"), Scan("max", "v", "mx"), Scan("min", "v", "mn"), Scan("first", "t", "f"), Scan("prev", "t", "p")]


def test_bursty_hot_key_blocks_stay_balanced(spark):
    """90 % of a hot key's rows crowd into 1 % of its order range."""
    ids = spark.range(60_000)
    seq = F.when(F.col("id") < 6_000, F.col("id") * 1000).otherwise(F.lit(6_000_000) + F.col("id"))
    df = ids.select(seq.alias("seq"), (F.col("id") % 2).alias("key"), F.col("id").alias("v"), F.col("id").cast("string").alias("t"))
    assert _largest(df, ["seq"], 30) <= 1_500
    _same(keyed_scan(df, ["key"], ["seq"], SCANS(), blocks=30), keyed_scan(df, ["key"], ["seq"], SCANS(), blocks=1))


@pytest.mark.parametrize("blocks", [2, 7, 50])
@pytest.mark.parametrize("case", ["strings", "one file", "ties", "null orders", "timestamps", "decimals", "all null", "three ties", "bytes", "dates"])
def test_any_order_is_cut_and_every_cut_gives_the_plain_answer(spark, blocks, case):
    """One key with two thirds of the rows; nulls in keys, values and orders."""
    rng = random.Random(3)
    rows = [(i, rng.choice([1, 1, 2, None]), rng.choice([None, rng.randrange(-9, 9)]), f"t{i}") for i in range(900)]
    df = spark.createDataFrame(rows, "id long, key long, v long, t string")
    path = F.concat(F.lit("file:///data/part-"), F.lpad((F.col("id") % 9).cast("string"), 5, "0"), F.lit("-é.txt"))
    df, order = {
        "strings": (df.withColumn("o", F.md5(F.col("id").cast("string"))), ["o"]),
        "one file": (df.withColumn("o", F.lit("only.txt")).withColumn("o2", F.col("id") * 5), ["o", "o2"]),
        "ties": (df.withColumn("o", F.when(F.col("id") < 800, path).otherwise(F.lit("file:///data/part-00000-é.txt"))), ["o", "id"]),
        "null orders": (df.withColumn("o", F.when(F.col("id") % 3 > 0, F.col("id"))), ["o", "id"]),
        "timestamps": (df.withColumn("o", F.timestamp_seconds(F.col("id") * 100)), ["o"]),
        "decimals": (df.withColumn("o", (F.col("id") * 1.5).cast("decimal(20,2)")), ["o"]),
        "three ties": (df.withColumn("o", F.lit(7) + (F.col("id") > 890).cast("int")).withColumn("o2", F.when(F.col("id") < 700, F.lit("same")).otherwise(F.col("t"))), ["o", "o2", "id"]),
        "bytes": (df.withColumn("o", F.md5(F.col("id").cast("string")).cast("binary")), ["o"]),
        "dates": (df.withColumn("o", F.date_add(F.lit("2024-01-01"), (F.col("id") % 2).cast("int"))).withColumn("o2", F.expr("timestamp_ntz'2024-03-31 02:30:00'") + F.make_interval(secs=F.col("id"))), ["o", "o2"]),
        "all null": (df.withColumn("o", F.lit(None).cast("long")), ["o", "id"]),
    }[case]
    if case != "all null" and blocks > 2:
        assert _largest(df, order, blocks) < 600
    _same(keyed_scan(df, ["key"], order, SCANS(), blocks=blocks), keyed_scan(df, ["key"], order, SCANS(), blocks=1))
    for kind in ("max", "min"):
        one, many = (rolling_extreme_by(df.withColumn("o_n", F.col("id")), "key", "o_n", "v", ["t", "v"], kind, prefix="best_", blocks=b) for b in (1, blocks))
        _same(one, many)


def test_an_outlier_does_not_spoil_the_cuts(spark):
    """20,000 lines of one file and a single path from another root: 16 blocks."""
    from streamkit.operators.scan import BLK, plan_blocks, with_blocks

    path = F.when(F.col("id") == 0, F.lit("hdfs://other/x.txt")).otherwise(F.lit("file:///data/lines/part-00000.txt"))
    df = spark.range(20_000).select(path.alias("path"), F.lit(0).alias("start"), F.col("id").alias("line"), (F.col("id") % 2).alias("key"), F.col("id").alias("v"), F.col("id").cast("string").alias("t"))
    order = ["path", "start", "line"]
    sizes = with_blocks(df, plan_blocks(df, ["key"], order, 16)).groupBy(BLK).count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 2_500
    _same(keyed_scan(df, ["key"], order, SCANS(), blocks=16), keyed_scan(df, ["key"], order, SCANS(), blocks=1))


def test_null_records_are_never_the_extreme(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", 5), (3, "a", 3), (4, "a", None)], "seq long, key string, v long")
    out = rolling_extreme_by(df, "key", "seq", "v", ["seq", "v"], "min", prefix="best_").orderBy("seq").collect()
    assert [(r.best_seq, r.best_v) for r in out] == [(None, None), (2, 5), (3, 3), (3, 3)]


def test_global_group_is_cut_without_cross_joins(spark):
    df = spark.range(3_000).select(((F.col("id") * 7919) % 3_001).alias("seq"), (F.col("id") % 13).alias("v"), F.col("id").cast("string").alias("t"))
    blocked = keyed_scan(df, [], ["seq"], SCANS(), blocks=20)
    _same(blocked, keyed_scan(df, [], ["seq"], SCANS(), blocks=1))
    assert _largest(df, ["seq"], 20, keys=()) <= 200
    plan = blocked._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_empty_table(spark):
    df = spark.createDataFrame([], "seq long, key long, v long, t string")
    assert keyed_scan(df, ["key"], ["seq"], SCANS(), blocks=9).count() == 0


def test_key_forms(spark):
    """Name, position, Column, selector and lists of them."""
    df = spark.createDataFrame([("a", 1, 5), ("b", 2, 3), ("a", 3, 7)], "k string, seq long, v long")
    want = [5, 3, 12]
    for key in ("k", 0, F.col("k") == "a", lambda d: F.upper(d["k"]), ["k"], [0], (F.col("k"), lambda d: F.length(d["k"]))):
        out = rolling_sum(df, key, "seq", "v", name="run").orderBy("seq")
        assert out.columns == ["k", "seq", "v", "run"] and [r.run for r in out.collect()] == want
    assert [r.f for r in rolling_fold(df, 0, "seq", "v", 100, name="f").orderBy("seq").collect()] == [105, 103, 112]
    assert [r.v for r in rolling_extreme(df, 0, "seq", "v").orderBy("seq").collect()] == [5, 3, 7]


def test_python_fold_keeps_exact_keys_and_copies_the_start(spark):
    big = 2 ** 53
    df = spark.createDataFrame([(None, 1, 1), (None, 2, 2), (big, 3, 3), (big + 1, 4, 4), (big, 5, None)], "k long, seq long, v long")

    def add(acc, v):
        acc.append(v)
        return acc

    out = rolling_map_in_pandas(df, "k", "seq", add, [], "v", "seen", "array<long>").orderBy("seq").collect()
    assert [(r.k, r.seen) for r in out] == [(None, [1]), (None, [1, 2]), (big, [3]), (big + 1, [4]), (big, [3, None])]


def test_record_reduce(spark):
    """A step over whole records, the first one as accumulator."""
    from streamkit.operators.keyed import fold_groups

    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 2, 3, "y"), ("b", 3, 1, "z"), ("a", 4, 2, "w")], "k string, seq long, v long, t string")
    step = lambda acc, r: {**acc, "v": acc["v"] * 2 - r["v"], "t": acc["t"] + r["t"]}
    out = fold_groups(df, ["k"], ["seq"], step, "v long, t string").collect()
    assert sorted(map(tuple, out)) == [("a", 5, "x"), ("a", 7, "xy"), ("a", 12, "xyw"), ("b", 1, "z")]
    out = fold_groups(df, ["k"], ["seq"], step, "v long, t string", every=False).collect()
    assert sorted(map(tuple, out)) == [("a", 12, "xyw"), ("b", 1, "z")]
