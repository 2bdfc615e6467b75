from pyspark.sql import functions as F

from streamkit.functions.text import cased_tokens, java_split
from streamkit.operators import connect, first_match_selector, select_outputs, split, union
from streamkit.operators.transform import flat_map
from tests.conftest import LINES

R_WORDS = ["SPRING", "SPRINGMVC", "STRUTS2", "HIBERNATE", "SPRINGBOOT", "SPRINGCLOUD", "REDIS", "RABBITMQ", "SOLR",
           "ELASTICSEARCH", "STORM", "SPARK", "PRESTO", "ZOOKEEPER"]


def _upper_tokens(lines_df):
    return flat_map(lines_df, cased_tokens(F.col("value")), name="token", keep=("seq",))


def _routed(lines_df):
    sel = first_match_selector([(F.col("token").contains("J"), "JJJJ"), (F.col("token").contains("R"), "RRRR")], "****")
    return split(_upper_tokens(lines_df), sel)


def test_self_union_doubles(lines_df):
    toks = _upper_tokens(lines_df)
    out = union(toks, toks)
    assert out.count() == 96
    counts = out.groupBy("token").count().collect()
    assert all(r["count"] == 2 for r in counts if r.token != "JAVA")


def test_split_counts(lines_df):
    rows = _routed(lines_df).groupBy(F.col("_outputs")[0].alias("o")).count().collect()
    assert {r.o: r["count"] for r in rows} == {"JJJJ": 8, "RRRR": 14, "****": 26}


def test_select_outputs(lines_df):
    r = select_outputs(_routed(lines_df), "RRRR").orderBy("seq", "pos").collect()
    assert [x.token for x in r] == R_WORDS
    j = select_outputs(_routed(lines_df), "JJJJ").withColumn("token", F.lower("token")).collect()
    assert all(x.token == x.token.lower() for x in j) and len(j) == 8
    both = select_outputs(_routed(lines_df), "RRRR", "JJJJ")
    assert both.count() == 22


def test_co_map_and_filter(spark, lines_df):
    toks = flat_map(lines_df, cased_tokens(F.col("value"), ((1, "lower"), (0, "upper"))), name="token",
                    keep=("seq",)).where(F.col("token").contains("r"))
    ordered = [r.token for r in toks.orderBy("seq", "pos").collect()]
    assert ordered == ["springmvc", "struts2", "springboot", "solr", "spark"]
    ints = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "i int")
    out = connect(toks, ints).co_map(lambda d: d["token"], lambda d: d["i"]).collect()
    assert len(out) == 9
    assert sorted(r.v2 for r in out if r.side == 2) == [1, 2, 3, 4]
    assert all(r.v2 is None for r in out if r.side == 1)


def test_co_flat_map(spark, lines_df):
    conn = connect(lines_df, lines_df)
    out = conn.co_flat_map(lambda d: F.array(F.upper(java_split(d["value"], " ")[0])),
                           lambda d: F.array(F.size(java_split(d["value"], " ")))).collect()
    firsts = sorted(r.v1 for r in out if r.side == 1)
    assert firsts == sorted(line.split(" ")[0].upper() for line in LINES)
    assert [r.v2 for r in out if r.side == 2] == [2] * 24


def test_write_split_one_pass(spark, lines_df, tmp_path):
    from streamkit.operators import read_output, write_split

    path = str(tmp_path / "routed")
    write_split(_routed(lines_df), path)
    r = read_output(spark, path, "RRRR")
    assert sorted(x.token for x in r.collect()) == sorted(R_WORDS)
    assert read_output(spark, path, "JJJJ").count() == 8
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(output" in plan and "= RRRR)]" in plan


def test_split_on_stream(spark, tmp_path):
    from streamkit.operators import read_output, write_split
    from streamkit.streaming import line_stream, replay_lines
    from streamkit.session import streaming_checkpoint

    src = line_stream(spark, replay_lines(["Java", "Redis", "Hive"], str(tmp_path / "in")))
    sel = first_match_selector([(F.col("value").contains("J"), "JJJJ"), (F.col("value").contains("R"), "RRRR")], "****")
    path = str(tmp_path / "out")
    q = (write_split(split(src, sel), path).option("checkpointLocation", streaming_checkpoint(spark, "split_stream"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert [r.value for r in read_output(spark, path, "RRRR").collect()] == ["Redis"]
    assert [r.value for r in read_output(spark, path, "****").collect()] == ["Hive"]
