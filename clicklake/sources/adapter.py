"""Map the shared ``events`` test table onto the raw clickstream event shape.

``events`` is (event_id bigint, ts timestamp_ntz, user_id bigint, event_type,
value double, props string).  Every input row becomes one raw event; the
rules below only *shape* values (ids as strings, silver vocabulary, some
NULLs and a bad country code so validation has work to do).  No row is
dropped.

Variants:
  base  -- as described; fails the quality gate on purpose (NULL user ids)
  clean -- without the NULL rules for event_id, user_id and country
  ties  -- timestamps truncated to the hour, as an hourly producer stamps them
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VARIANTS = ("base", "clean", "ties")

# Event vocabulary mapping of the fixture adapter.
EVENT_TYPE_MAP = {
    "view": "video_start",
    "click": "video_progress",
    "purchase": "video_pause",
    "signup": "login",
}
# Remainder of event_id % 3 -> event type for all other source types.
OTHER_TYPES_BY_MOD3 = {0: "video_resume", 1: "video_end", 2: "search"}
# Country by user_id % 3.
COUNTRY_BY_USER_MOD3 = {0: "IN", 1: "SG", 2: "AE"}
# Null / bad-value injection periods on event_id.
NULL_EVENT_ID_EVERY, NULL_USER_ID_EVERY, NULL_DEVICE_EVERY = 97, 89, 53
NULL_COUNTRY_EVERY, BAD_COUNTRY_EVERY, BAD_COUNTRY = 41, 43, "IND"


def _nullify(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None).cast("string")).otherwise(value)


def raw_events(events: DataFrame, variant: str = "base") -> DataFrame:
    """Return raw events: event_id, user_id, content_id, event_type, device_id,
    timestamp (epoch ms), geo_location{country}."""
    if variant not in VARIANTS:
        raise ValueError(f"unknown variant {variant!r}; expected one of {VARIANTS}")
    eid, uid, etype = F.col("event_id"), F.col("user_id"), F.col("event_type")
    strict = variant != "clean"

    event_id = eid.cast("string")
    user_id = F.concat(F.lit("user_"), uid.cast("string"))
    if strict:
        event_id = _nullify(eid % NULL_EVENT_ID_EVERY == 0, event_id)
        user_id = _nullify(eid % NULL_USER_ID_EVERY == 0, user_id)

    content_id = _nullify(etype == "signup", F.concat(F.lit("movie_"), (eid % 2).cast("string")))

    other = F.when(eid % 3 == 0, OTHER_TYPES_BY_MOD3[0]).when(eid % 3 == 1, OTHER_TYPES_BY_MOD3[1]) \
        .otherwise(OTHER_TYPES_BY_MOD3[2])
    mapped = None
    for source, target in EVENT_TYPE_MAP.items():
        mapped = (F.when(etype == source, target) if mapped is None
                  else mapped.when(etype == source, target))
    event_type = mapped.otherwise(other)

    device_id = _nullify(eid % NULL_DEVICE_EVERY == 0, F.concat(F.lit("dev_"), (uid % 2).cast("string")))

    ts = F.col("ts").cast("timestamp")
    if variant == "ties":
        ts = F.date_trunc("hour", ts)
    timestamp = F.unix_millis(ts)

    country = F.when(uid % 3 == 0, COUNTRY_BY_USER_MOD3[0]).when(uid % 3 == 1, COUNTRY_BY_USER_MOD3[1]) \
        .otherwise(COUNTRY_BY_USER_MOD3[2])
    country = F.when(eid % BAD_COUNTRY_EVERY == 0, BAD_COUNTRY).otherwise(country)
    if strict:
        country = _nullify(eid % NULL_COUNTRY_EVERY == 0, country)

    return events.select(
        event_id.alias("event_id"),
        user_id.alias("user_id"),
        content_id.alias("content_id"),
        event_type.alias("event_type"),
        device_id.alias("device_id"),
        timestamp.alias("timestamp"),
        F.struct(country.alias("country")).alias("geo_location"),
    )


def load_events(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def load_raw(spark, sf_dir: str, variant: str = "base") -> DataFrame:
    return raw_events(load_events(spark, sf_dir), variant)


def write_daily_drops(raw: DataFrame, base_path: str) -> None:
    """Write raw events as gzip JSON-lines drops, one directory per event day (DAILY_DIRS)."""
    from ..functions.columns import event_date

    (raw.withColumn("drop_date", event_date("timestamp"))
     .hint("rebalance", "drop_date")
     .write.mode("overwrite").partitionBy("drop_date").option("compression", "gzip").json(base_path))


def _write_lines(raw: DataFrame, line, base_path: str) -> None:
    from ..functions.columns import event_date

    (raw.select(line.alias("value"), event_date("timestamp").alias("drop_date")).hint("rebalance", "drop_date")
     .write.mode("overwrite").partitionBy("drop_date").option("compression", "gzip").text(base_path))


def write_daily_drops_with_bad_lines(raw: DataFrame, base_path: str, every: int) -> None:
    """The same drops; lines whose timestamp is a multiple of ``every`` are replaced by a broken text, an array
    with a mistyped element, an object with text behind it, or one with a mistyped nested field."""
    ms = F.col("timestamp")
    kind, number = (ms / every).cast("long") % 4, ms.cast("string")
    broken = (F.when(kind == 0, F.concat(F.lit("broken "), F.col("event_type"), F.lit(" "), number))
              .when(kind == 1, F.concat(F.lit('[{"event_id":"a"},{"event_id":"b","timestamp":"oops '), number, F.lit('"}]')))
              .when(kind == 2, F.concat(F.lit('{"event_id":"a"} tail '), number))
              .otherwise(F.concat(F.lit('{"event_id":"a","geo_location":{"latitude":"north '), number, F.lit('"}}'))))
    _write_lines(raw, F.when(ms % every == 0, broken).otherwise(F.to_json(F.struct(*raw.columns))), base_path)


def write_daily_drops_with_timestamps(raw: DataFrame, written, base_path: str) -> None:
    """The same drops with the JSON text ``written`` as every line's timestamp."""
    rest = F.to_json(F.struct(*[c for c in raw.columns if c != "timestamp"]))
    _write_lines(raw, F.concat(F.lit('{"timestamp":'), written, F.lit(","), F.substring(rest, 2, 1 << 30)), base_path)


def write_daily_drops_with_new_fields(raw: DataFrame, base_path: str) -> None:
    """The same drops, some rows with fields outside the schema: at the top level, nested, and of two types."""
    ms = F.col("timestamp")
    geo = F.struct(F.col("geo_location.country").alias("country"), F.when(ms % 11 == 0, ms % 1000).alias("asn"))
    added = [F.when(ms % 7 == 0, F.struct((ms % 10).alias("x"))).alias("campaign"), F.when(ms % 13 == 0, F.lit("seen")).alias("note"),
             F.when(ms % 17 == 0, F.when(ms % 2 == 0, F.lit("1.5").cast("double")).otherwise(F.lit(2.25))).alias("weight")]
    _write_lines(raw, F.to_json(F.struct(*[c for c in raw.columns if c != "geo_location"], geo.alias("geo_location"), *added)), base_path)


# Region of each country code in the hourly Parquet layout.
REGION_BY_COUNTRY = {"IN": "India", "SG": "SouthEast Asia", "AE": "Middle East"}
UNKNOWN_REGION = "Unknown"


def hourly_layout(raw: DataFrame) -> DataFrame:
    """Raw events plus the region / date / hour partition columns of the hourly drops."""
    from ..functions.columns import event_timestamp

    country = F.col("geo_location.country")
    region = F.lit(UNKNOWN_REGION)
    for code, name in reversed(list(REGION_BY_COUNTRY.items())):
        region = F.when(country == code, name).otherwise(region)
    ts = event_timestamp("timestamp")
    return raw.select("*", region.alias("region"), F.date_format(ts, "yyyy-MM-dd").alias("date"),
                      F.date_format(ts, "HH").alias("hour"))
