"""Catalog DDL for the silver and quarantine tables (external Parquet tables).

The row check on ``action`` is recorded as a table property and enforced by
``writers.enforce_action_domain`` inside every silver write (Parquet tables
have no CHECK constraints).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..schemas import QUARANTINE, SILVER_USER_ACTIONS

# Table property carrying the action domain check.
ACTION_CHECK_PROPERTY = ("check.valid_action", "action IN ('WATCHED', 'PAUSED')")


def _columns(schema, skip=()) -> str:
    return ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in skip)


def create_silver_table(spark: SparkSession, name: str, location: str) -> None:
    key, value = ACTION_CHECK_PROPERTY
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {name} (
  {_columns(SILVER_USER_ACTIONS)})
USING parquet
PARTITIONED BY (event_date, country)
LOCATION '{location}'
TBLPROPERTIES ('{key}' = "{value}")""")


def create_quarantine_table(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {name} (
  {_columns(QUARANTINE)})
USING parquet
PARTITIONED BY (event_date)
LOCATION '{location}'""")


def use_database(spark: SparkSession, name: str) -> None:
    """``USE name``."""
    spark.catalog.setCurrentDatabase(name)
