import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from streamkit.llm.registry import ORACLE, QUERIES
from tools.check_oracle import table_hash

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator_and_the_pipeline():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = QUERIES[name](spark, SF)
    got, want = pd.DataFrame(sdf.collect(), columns=sdf.columns), con.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    assert table_hash(got) == table_hash(want)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs_with_a_stable_schema(spark, name):
    one, two = QUERIES[name](spark, SF), QUERIES[name](spark, SF)
    assert one.schema == two.schema and one.count() == two.count() > 0
