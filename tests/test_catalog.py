"""Catalog: DDL, external tables, listing."""

import os

from clicklake.sinks import ddl, writers
from clicklake.sources import readers


def test_silver_ddl_and_listing(spark, tmp_dir):
    writers.create_databases(spark, ["cl_silver"])
    ddl.create_silver_table(spark, "cl_silver.user_actions", os.path.join(tmp_dir, "ua"))
    ddl.create_quarantine_table(spark, "cl_silver.quarantine", os.path.join(tmp_dir, "q"))
    t = spark.table("cl_silver.user_actions")
    assert t.columns[-2:] == ["event_date", "country"] and t.count() == 0
    from clicklake.schemas import SILVER_USER_ACTIONS
    rows = spark.createDataFrame([("a", "u", "m", "d", "IN", "WATCHED", None, None, 1, None)], SILVER_USER_ACTIONS)
    writers.create_or_overwrite_table(rows, "cl_silver.user_actions", ("event_date", "country"))
    assert [r.country for r in spark.table("cl_silver.user_actions").collect()] == ["IN"]
    props = dict((r[0], r[1]) for r in spark.sql("SHOW TBLPROPERTIES cl_silver.user_actions").collect())
    assert props[ddl.ACTION_CHECK_PROPERTY[0]] == ddl.ACTION_CHECK_PROPERTY[1]
    ddl.use_database(spark, "cl_silver")
    names = {r["name"] for r in readers.list_tables(spark).collect()}
    assert {"user_actions", "quarantine"} <= names
    assert "cl_silver" in {r["name"] for r in readers.list_databases(spark).collect()}
    ddl.use_database(spark, "default")


def test_silver_reads_bronze_catalog_table(spark, tmp_dir):
    import datetime as dt

    from clicklake.plans import silver
    from tests.helpers import bronze_df

    rows = [("1", "u", "m", "video_start", "d", 0, "IN"), ("2", "u", "m", "video_pause", "d", 86400, "IN")]
    writers.save_as_table(bronze_df(spark, rows), "bronze_events_t", os.path.join(tmp_dir, "b"), ("event_date",))
    got = silver.read_bronze_days(spark, "bronze_events_t", dt.date(2024, 1, 2)).collect()
    assert [r["event_id"] for r in got] == ["2"]
