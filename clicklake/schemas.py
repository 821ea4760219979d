"""Declared schemas: raw event contract, silver, quarantine."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Field names and types of the raw event contract, down to SILVER_USER_ACTIONS.
GEO_LOCATION = _struct([
    ("city", S), ("country", S), ("ip_address", S), ("latitude", D),
    ("longitude", D), ("postal_code", S), ("region", S),
])

MARKETING_ATTRIBUTION = _struct([
    ("affiliate_id", S), ("campaign_name", S), ("experiment_id", S), ("referral_code", S),
    ("utm_campaign", S), ("utm_content", S), ("utm_medium", S), ("utm_source", S),
    ("utm_term", S), ("variant_id", S),
])

METADATA = _struct([
    ("ad_format", S), ("ad_id", S), ("ad_type", S), ("category", S), ("dropout", B),
    ("duration_seconds", L), ("new_quality", S), ("old_quality", S), ("position", L),
    ("position_seconds", L), ("progress_percentage", L), ("progress_seconds", L),
    ("revenue", D), ("skip_after_seconds", L), ("skip_allowed", B),
])

TECHNICAL_CONTEXT = _struct([
    ("app_version", S), ("browser_type", S), ("browser_version", S), ("connection_type", S),
    ("isp", S), ("network_speed", D), ("os_type", S), ("os_version", S),
    ("screen_resolution", S), ("user_agent", S), ("viewport_size", S),
])

# Full raw event as delivered in the daily JSON-lines drops.
RAW_EVENT = T.StructType([
    T.StructField("content_id", S), T.StructField("device_id", S),
    T.StructField("event_id", S), T.StructField("event_type", S),
    T.StructField("geo_location", GEO_LOCATION),
    T.StructField("marketing_attribution", MARKETING_ATTRIBUTION),
    T.StructField("metadata", METADATA),
    T.StructField("session_id", S),
    T.StructField("technical_context", TECHNICAL_CONTEXT),
    T.StructField("timestamp", L),
    T.StructField("user_id", S),
])

CORRUPT_RECORD = "_corrupt_record"

# Raw schema plus the column that PERMISSIVE mode fills with unparsable lines.
RAW_EVENT_WITH_CORRUPT = T.StructType(RAW_EVENT.fields + [T.StructField(CORRUPT_RECORD, S)])

# Minimal data contract for hourly Parquet drops.
EVENT_CONTRACT = T.StructType([
    T.StructField("event_id", S), T.StructField("user_id", S),
    T.StructField("content_id", S), T.StructField("event_type", S),
    T.StructField("timestamp", L), T.StructField("device_id", S),
    T.StructField("session_id", S),
    T.StructField("technical_context", _struct([
        ("user_agent", S), ("app_version", S), ("os_type", S),
    ])),
])

# Columns of the silver and quarantine tables.
SILVER_USER_ACTIONS = T.StructType([
    T.StructField("action_id", S), T.StructField("user_id", S),
    T.StructField("content_id", S), T.StructField("device_id", S),
    T.StructField("country", S), T.StructField("action", S),
    T.StructField("start_time", T.TimestampType()), T.StructField("end_time", T.TimestampType()),
    T.StructField("duration_seconds", L), T.StructField("event_date", T.DateType()),
])

QUARANTINE = T.StructType([
    T.StructField("event_id", S), T.StructField("user_id", S),
    T.StructField("content_id", S), T.StructField("event_type", S),
    T.StructField("event_date", T.DateType()), T.StructField("device_id", S),
    T.StructField("country", S), T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("validation_errors", T.ArrayType(S)),
])
