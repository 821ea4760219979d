"""Every registered query against its DuckDB oracle on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from clicklake import queries
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
KEYS = sorted(queries.QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(entry.queries()) and set(KEYS) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["action_id", "user_id", "content_id", "device_id", "country", "action",
                          "start_time", "end_time", "duration_seconds", "event_date"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(key)
    if sql is None:
        assert len(rows) > 0
        return
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
