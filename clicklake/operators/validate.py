"""Row validation: ordered rule list -> valid / quarantine split with error codes.

A row is valid when no rule fails: a plain conjunction, so null tests reach the Parquet scan as pushed
filters and the rest stays in generated code.  Error codes are built for failing rows only.  Splitting
costs no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import event_timestamp, invalid_country

ERRORS = "validation_errors"

# Error codes, in the order they are reported.
EVENT_ID_IS_NULL = "event_id_is_null"
USER_ID_IS_NULL = "user_id_is_null"
EVENT_TIMESTAMP_IS_NULL = "event_timestamp_is_null"
INVALID_COUNTRY_CODE = "invalid_country_code"


def default_rules() -> list[tuple[str, Column]]:
    """(error code, failing condition) in reporting order."""
    return [
        (EVENT_ID_IS_NULL, F.col("event_id").isNull()),
        (USER_ID_IS_NULL, F.col("user_id").isNull()),
        (EVENT_TIMESTAMP_IS_NULL, F.col("event_timestamp").isNull()),
        (INVALID_COUNTRY_CODE, invalid_country("country")),
    ]


def base_events(bronze: DataFrame) -> DataFrame:
    """Columns the silver layer needs, the nested country lifted out (other struct fields are pruned)."""
    # The columns of the data contract.
    return bronze.select(
        "event_id", "user_id", "content_id", "event_type", "event_date", "device_id", "timestamp",
        F.col("geo_location.country").alias("country"), event_timestamp("timestamp").alias("event_timestamp"))


def passes(rules: list[tuple[str, Column]] | None = None) -> Column:
    """True when no rule fails; a condition that is NULL does not fail."""
    if rules is None:  # never NULL, and bare null tests are what a scan takes as pushed filters
        held = [~failing for _, failing in default_rules()]
    else:
        held = [~F.coalesce(failing, F.lit(False)) for _, failing in rules]
    return reduce(lambda a, b: a & b, held, F.lit(True))


def with_validation_errors(df: DataFrame, rules: list[tuple[str, Column]] | None = None) -> DataFrame:
    rules = default_rules() if rules is None else rules
    return df.withColumn(ERRORS, F.array_compact(F.array(*[F.when(failing, F.lit(code)) for code, failing in rules])))


def split(bronze: DataFrame, rules=None) -> tuple[DataFrame, DataFrame]:
    """(valid events, quarantined events with their error codes) from a bronze frame."""
    events, ok = base_events(bronze), passes(rules)
    return events.filter(ok), with_validation_errors(events.filter(~ok), rules).drop("timestamp")
