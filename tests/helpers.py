"""Hand-made rows for the operator tests."""

import datetime as dt

from pyspark.sql import functions as F

from clicklake.functions.columns import event_date

BASE_TS = dt.datetime(2024, 1, 1, 10, 0, 0, tzinfo=dt.timezone.utc)
RAW_DDL = ("event_id string, user_id string, content_id string, event_type string, device_id string, "
           "timestamp bigint, country string")


def ms(seconds: float, base: dt.datetime = BASE_TS) -> int:
    return int(base.timestamp() * 1000) + int(round(seconds * 1000))


def raw_df(spark, rows):
    """rows: (event_id, user_id, content_id, event_type, device_id, seconds_after_base, country)."""
    data = [(e, u, c, t, d, ms(s) if s is not None else None, k) for e, u, c, t, d, s, k in rows]
    df = spark.createDataFrame(data, RAW_DDL)
    return df.select("event_id", "user_id", "content_id", "event_type", "device_id", "timestamp",
                     F.struct(F.col("country").alias("country")).alias("geo_location"))


def bronze_df(spark, rows):
    return raw_df(spark, rows).withColumn("event_date", event_date("timestamp"))


def ts(seconds: float):
    return (BASE_TS + dt.timedelta(seconds=seconds)).replace(tzinfo=None)
