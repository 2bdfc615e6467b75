import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from streamkit.plans.oracle import ORACLE
from streamkit.plans.queries import QUERIES
from streamkit.sources.tables import TABLES
from tools.check_oracle import table_hash

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["word", "window_start", "window_end", "count"]
    assert df.limit(5).count() == 5


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    got = pd.DataFrame(sdf.collect(), columns=sdf.columns)
    want = duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert table_hash(got) == table_hash(want)
