import pytest
from pyspark.sql import functions as F

from streamkit.functions import compound_growth, epoch_millis_to_ts, java_split, parse_key_int, tokens
from streamkit.functions.time import interval_micros


@pytest.mark.parametrize(
    "text,expected",
    [("", [""]), ("  ", []), ("a  b ", ["a", "", "b"]), (" a", ["", "a"]), ("a\tb\nc", ["a", "b", "c"]),
     ("word", ["word"]), ("a b\n", ["a", "b"])],
)
def test_java_split_rule(spark, text, expected):
    row = spark.createDataFrame([(text,)], "v string").select(java_split("v").alias("t")).first()
    assert row.t == expected


def test_drop_empty(spark):
    row = spark.createDataFrame([("a  b ",)], "v string").select(tokens("v", drop_empty=True).alias("t")).first()
    assert row.t == ["a", "b"]


def test_parse_key_int_strict_and_lenient(spark):
    df = spark.createDataFrame([("a 1",), ("a x",), ("a",)], "v string")
    key, n = parse_key_int(F.col("v"), strict=False)
    rows = df.select(key.alias("k"), n.alias("n")).collect()
    assert [(r.k, r.n) for r in rows] == [("a", 1), ("a", None), ("a", None)]
    key, n = parse_key_int(F.col("v"))
    with pytest.raises(Exception):
        spark.createDataFrame([("a x",)], "v string").select(n).collect()
    with pytest.raises(Exception):
        spark.createDataFrame([("a",)], "v string").select(n).collect()


def test_epoch_millis(spark):
    row = spark.createDataFrame([("13000 hello",)], "v string").select(
        F.unix_millis(epoch_millis_to_ts("v")).alias("ms")).first()
    assert row.ms == 13000


def test_growth_bit_equal_to_loop(spark):
    start = 150000.0
    for _ in range(36):
        start = start * (1 + 0.004)
    row = spark.createDataFrame([(150000.0,)], "b double").select(compound_growth("b", 0.004, 36).alias("t")).first()
    assert row.t == start == 173182.86507551113
    assert row.t / 36 == 4810.63514098642


def test_interval_parsing():
    assert interval_micros("5 seconds") == 5_000_000
    assert interval_micros("50 minutes") == 3_000_000_000
    assert interval_micros(1000) == 1_000_000
    with pytest.raises(ValueError):
        interval_micros("soon")


@pytest.mark.parametrize(
    "text,expected",
    [("", []), ("a", ["a"]), ("a\nb", ["a", "b"]), ("a\nb\n", ["a", "b"]), ("a\r\nb\rc", ["a", "b", "c"]),
     ("\n", [""]), ("a\n\nb", ["a", "", "b"])],
)
def test_text_lines(spark, text, expected):
    from streamkit.functions import text_lines

    row = spark.createDataFrame([(text,)], "v string").select(text_lines("v").alias("l")).first()
    assert row.l == expected
