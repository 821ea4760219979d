"""Column-level building blocks (all JVM-side built-ins, codegen friendly)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event vocabulary understood by the silver layer.
WATCHED_EVENT_TYPES = ("video_start", "video_progress", "video_end")
PAUSED_EVENT_TYPES = ("video_pause", "video_resume")
# Action labels.
WATCHED, PAUSED, IGNORE = "WATCHED", "PAUSED", "IGNORE"
VALID_ACTIONS = (WATCHED, PAUSED)
# Event types that need no content id.
CONTENTLESS_EVENT_TYPES = ("login", "logout")
# Timestamp plausibility window (2020-01-01 UTC; five minutes of clock skew).
START_OF_2020_MS = 1577836800000
FUTURE_SKEW_MS = 5 * 60 * 1000
# Country codes are exactly two characters.
COUNTRY_CODE_LENGTH = 2


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_timestamp(ms: str | Column = "timestamp") -> Column:
    """Epoch milliseconds -> TIMESTAMP (exact, no floating point)."""
    return F.timestamp_millis(col(ms))


def event_date(ms: str | Column = "timestamp") -> Column:
    """Epoch milliseconds -> DATE in the session zone (UTC)."""
    return F.to_date(F.timestamp_millis(col(ms)))


def classify_action(event_type: str | Column = "event_type",
                    watched: tuple[str, ...] = WATCHED_EVENT_TYPES,
                    paused: tuple[str, ...] = PAUSED_EVENT_TYPES) -> Column:
    """WATCHED / PAUSED / IGNORE from the event type (vocabulary is a parameter)."""
    e = col(event_type)
    return F.when(e.isin(*watched), WATCHED).when(e.isin(*paused), PAUSED).otherwise(IGNORE)


def action_id(user_id="user_id", content_id="content_id", device_id="device_id",
              action="action", start_time="start_time") -> Column:
    """md5 of the concatenated natural key; NULL when any part is NULL."""
    return F.md5(F.concat(col(user_id), col(content_id), col(device_id), col(action),
                          col(start_time).cast("string")))


def duration_seconds(start="start_time", end="end_time") -> Column:
    """Whole seconds: both ends floored to seconds, then subtracted."""
    return col(end).cast("long") - col(start).cast("long")


def invalid_country(country: str | Column = "country") -> Column:
    c = col(country)
    return c.isNull() | (F.length(c) != COUNTRY_CODE_LENGTH)


def as_of_ms(as_of: dt.datetime | int) -> int:
    if isinstance(as_of, int):
        return as_of
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=dt.timezone.utc)
    return int(as_of.timestamp() * 1000)


def timestamp_in_range(as_of: dt.datetime | int, ms: str | Column = "timestamp") -> Column:
    """2020-01-01 <= ts <= as_of + 5 minutes (NULL stays NULL)."""
    return col(ms).between(F.lit(START_OF_2020_MS), F.lit(as_of_ms(as_of) + FUTURE_SKEW_MS))


def content_required(event_type="event_type", content_id="content_id") -> Column:
    """Events other than login/logout must carry a content id."""
    return col(event_type).isin(*CONTENTLESS_EVENT_TYPES) | col(content_id).isNotNull()


def json_map_total(json_col: str | Column) -> Column:
    """Sum of the numeric values of a JSON object such as '{"a": 1.5, "b": 2}'."""
    parsed = F.from_json(col(json_col), "map<string,double>")
    return F.aggregate(F.map_values(parsed), F.lit(0.0), lambda acc, x: acc + x)


def year_month_day(date_col: str | Column = "date") -> list[Column]:
    d = col(date_col)
    return [F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day")]
