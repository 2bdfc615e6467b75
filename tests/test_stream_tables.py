"""Per-record operators on micro-batches, with their state in key tables."""

import os

import pytest
from pyspark.sql import functions as F

from streamkit.operators import scan as S
from streamkit.operators.keyed import rolling_extreme, rolling_extreme_by, rolling_reduce, rolling_sum
from streamkit.operators.windows import Agg, count_window
from streamkit.streaming import tables
from streamkit.streaming.tables import KeyedStream, KeyTable

ROWS = [(i, None if i % 10 == 0 else "hot" if i % 3 else f"k{i % 7}", None if i % 6 == 0 else (i * 37) % 101) for i in range(400)]
CUTS = [0, 90, 91, 250, 251, 330, 400]


@pytest.fixture()
def table(spark):
    return spark.createDataFrame(ROWS, "id long, k string, v long").repartition(3).cache()


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


OPERATORS = {
    "sum": lambda df, state=None: rolling_sum(df, "k", "id", "v", name="run", carry=["v"], state=state),
    "reduce": lambda df, state=None: rolling_reduce(df.withColumn("f", F.lit("x")), "k", "id", "v", "f", F.lit("later"), state=state),
    "max": lambda df, state=None: rolling_extreme(df, "k", "id", "v", "max", name="top", state=state),
    "minby": lambda df, state=None: rolling_extreme_by(df, "k", "id", "v", ["id", "v"], "min", prefix="best_", state=state),
    "tumbling": lambda df, state=None: count_window(df, "k", "id", 7, [Agg("sum", F.col("v"), "s"), Agg("concat", F.col("id").cast("string"), "ids", order=("id",), sep=",")], state=state),
    "sliding": lambda df, state=None: count_window(df, "k", "id", 9, [Agg("max", F.col("v"), "m"), Agg("count", None, "n")], slide=4, state=state),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_batches_give_what_one_table_gives(spark, table, tmp_path, monkeypatch, name):
    """Also with a batch of one row, keys that come and go, and snapshots in between."""
    monkeypatch.setattr(tables, "SNAPSHOT", 2)
    keyed = KeyedStream(str(tmp_path / "s"), OPERATORS[name])
    for i, (a, b) in enumerate(zip(CUTS, CUTS[1:])):
        keyed.process(table.where(F.col("id").between(a, b - 1)), i)
    assert rows(keyed.result(spark)) == rows(OPERATORS[name](table))


@pytest.mark.parametrize("name", ["sum", "sliding"])
def test_a_batch_that_runs_again_changes_nothing(spark, table, tmp_path, name):
    keyed = KeyedStream(str(tmp_path / "s"), OPERATORS[name])
    parts = [table.where(F.col("id").between(a, b - 1)) for a, b in ((0, 100), (100, 240), (240, 400))]
    for i in (0, 1, 1, 2, 2):
        keyed.process(parts[i], i)
    state = {n: rows(KeyTable(spark, str(tmp_path / "s" / "state" / n), 3).newest()) for n in os.listdir(tmp_path / "s" / "state")}
    assert rows(keyed.result(spark)) == rows(OPERATORS[name](table))
    keyed.process(parts[2], 2)
    assert {n: rows(KeyTable(spark, str(tmp_path / "s" / "state" / n), 3).newest()) for n in state} == state


def test_a_run_that_died_between_result_and_state(spark, table, tmp_path):
    """The result is there, the state of the batch is half written."""
    keyed = KeyedStream(str(tmp_path / "s"), OPERATORS["sum"])
    keyed.process(table.where("id < 200"), 0)
    keyed.process(table.where("id >= 200 and id < 300"), 1)
    spark.range(1).write.mode("overwrite").parquet(str(tmp_path / "s" / "state" / "scan" / "batch=1"))
    keyed.process(table.where("id >= 200"), 1)
    assert rows(keyed.result(spark)) == rows(OPERATORS["sum"](table))


def test_hot_keys_fill_several_blocks_of_a_batch(spark, table):
    two = table.withColumn("k", F.col("id") % 3 == 0)
    blocking = S.plan_blocks(two, ["k"], ["id"], 8)
    sizes = S.with_blocks(two, blocking).groupBy(S.KEY, S.BLK).count().collect()
    assert len({r[S.BLK] for r in sizes}) >= 8 and max(r["count"] for r in sizes) < 60


def test_state_is_one_row_per_key(spark, table, tmp_path):
    keyed = KeyedStream(str(tmp_path / "s"), OPERATORS["sliding"])
    for i, (a, b) in enumerate(((0, 199), (200, 399))):
        keyed.process(table.where(F.col("id").between(a, b)), i)
    keys = table.select("k").distinct().count()
    for name in ("scan", "tails"):
        assert KeyTable(spark, str(tmp_path / "s" / "state" / name), 2).newest().count() == keys
    assert KeyTable(spark, str(tmp_path / "s" / "state" / "tails"), 2).newest().agg(F.max(F.size("tail"))).first()[0] == 8


def test_as_a_query_that_is_started_again(spark, table, tmp_path):
    keyed, source = KeyedStream(str(tmp_path / "s"), OPERATORS["sum"]), str(tmp_path / "in")
    stream = None
    for a, b in ((0, 149), (150, 399)):
        table.where(F.col("id").between(a, b)).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(table.schema).parquet(source)
        KeyedStream(keyed.folder, keyed.operator).run(stream)
    keyed.run(stream)  # nothing new
    assert rows(keyed.result(spark)) == rows(OPERATORS["sum"](table))
