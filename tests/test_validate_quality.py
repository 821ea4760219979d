"""Validation split and data-quality suite."""

import datetime as dt
import math

from pyspark.sql import functions as F

from clicklake.functions.columns import json_map_total
from clicklake.operators import quality, validate
from tests.helpers import bronze_df, raw_df

AS_OF = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


def test_validation_codes_in_order(spark):
    rows = [(None, None, "m", "video_start", "d", 0, "IND"), ("2", "u", "m", "video_start", "d", 0, "IN"),
            ("3", "u", None, "login", "d", 0, None)]
    v = validate.with_validation_errors(validate.base_events(bronze_df(spark, rows)))
    got = {r["event_id"]: r["validation_errors"] for r in v.collect()}
    assert got[None] == ["event_id_is_null", "user_id_is_null", "invalid_country_code"]
    assert got["2"] == [] and got["3"] == ["invalid_country_code"]


def test_valid_plus_quarantine_is_input(spark):
    rows = [(str(i) if i % 3 else None, "u", "m", "video_start", "d", i, "IN" if i % 4 else "X")
            for i in range(40)]
    b = bronze_df(spark, rows)
    valid, quarantined = validate.split(b)
    assert valid.count() + quarantined.count() == b.count()
    assert "timestamp" not in quarantined.columns and "validation_errors" not in valid.columns


def test_json_map_total_literal(spark):
    df = spark.createDataFrame([('{"1001": 301.27, "1002": 433.21, "1003": 502.22}',)], "props string")
    assert math.isclose(df.select(json_map_total("props")).first()[0], 1236.70, abs_tol=1e-9)


def _suite(batch=()):
    return quality.Suite(as_of=AS_OF, batch_cols=batch)


def test_profile_metrics(spark):
    rows = [("1", "a", "m1", "video_start", "d", 0, "IN"), ("2", "a", "m1", "video_pause", "d", 1, "IN"),
            ("3", "b", None, "login", "d", 2, "IN"), ("4", None, "m2", "video_pause", "d", 3, "IN")]
    w = quality.profile_wide(raw_df(spark, rows), _suite()).first()
    assert w["size"] == 4
    assert w["completeness_user_id"] == 0.75 and w["completeness_content_id"] == 0.75
    assert math.isclose(w["uniqueness_user_id"], 1 / 3)          # b once, a twice -> 1 of 3 non-null
    assert math.isclose(w["distinctness_content_id"], 2 / 3)
    p = [2 / 4, 1 / 4, 1 / 4]
    assert math.isclose(w["entropy_event_type"], -sum(x * math.log(x) for x in p))
    assert w["compliance_content_required"] == 1.0


def test_checks_gate_blocks_on_null_user(spark):
    rows = [("1", None, "m", "video_start", "d", 0, "IN"), ("2", "u", "m", "video_start", "d", 1, "IN")]
    _, _, checks, _, _ = quality.run_checks(raw_df(spark, rows), _suite())
    status = {r["constraint"]: r["constraint_status"] for r in checks.collect()}
    assert status["isComplete(user_id)"] == "Failure"
    assert status["isComplete(timestamp)"] == "Success"
    assert {r["check_status"] for r in checks.collect()} == {"Error"}


def test_range_and_conditional_checks(spark):
    rows = [("1", "u", None, "video_start", "d", 0, "IN"), ("2", "u", None, "login", "d", 1, "IN")]
    df = raw_df(spark, rows).withColumn("timestamp", F.when(F.col("event_id") == "2", F.lit(5)).otherwise(F.col("timestamp")))
    w = quality.profile_wide(df, _suite()).first()
    assert w["compliance_content_required"] == 0.5
    assert w["compliance_timestamp_range"] == 0.5


def test_size_anomaly_first_run_and_jump(spark):
    hist = spark.createDataFrame([(dt.date(2024, 1, 1), 10), (dt.date(2024, 1, 2), 12),
                                  (dt.date(2024, 1, 3), 100013)], "process_date date, size long")
    got = {r["process_date"].day: (r["status"], r["message"]) for r in quality.size_anomaly(hist).collect()}
    assert got[1] == ("Success", "no history")
    assert got[2] == ("Success", "")
    assert got[3][0] == "Failure"


def test_batched_gate_per_day(spark):
    rows = [("1", "u", "m", "video_start", "d", 0, "IN"), ("2", None, "m", "video_start", "d", 86400, "IN")]
    df = raw_df(spark, rows).withColumn("process_date", F.to_date(F.timestamp_millis("timestamp")))
    _, _, _, _, verdict = quality.run_checks(df, _suite(("process_date",)))
    got = {r["process_date"].day: r["passed"] for r in verdict.collect()}
    assert got == {1: True, 2: False}
