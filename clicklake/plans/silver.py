"""Bronze -> silver: validate, quarantine, sessionize, merge.

One call processes one day or a whole range of days in a single pass (the
backfill): ``event_date`` is part of every window key, so the result equals
day-by-day runs, and the bronze read prunes to exactly those partitions.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import sessionize, validate
from ..session import ensure_defaults, path_exists
from ..sinks import merge, writers
from ..sources import readers

log = logging.getLogger(__name__)


def _is_path(name: str) -> bool:
    return "/" in name or ":" in name


def read_bronze_days(spark: SparkSession, bronze_path: str, days: dt.date | Iterable[dt.date] | None) -> DataFrame:
    """Bronze rows of the given ``event_date`` partitions (all when ``days`` is None).

    In a folder only those days' directories are listed, at either layout's place; with a catalog table
    the metastore answers the partition filter.
    """
    if not _is_path(bronze_path):
        bronze = spark.table(bronze_path)
        return bronze if days is None else bronze.filter(F.to_date(F.col("event_date")).isin(_days(days)))
    if days is None:
        return spark.read.parquet(bronze_path)
    root = bronze_path.rstrip("/")
    found = [f"{root}/event_date={d}" for d in _days(days) if path_exists(spark, f"{root}/event_date={d}")]
    return readers.read_directories(spark, root, found or [f"{root}/processing_date=*/event_date={d}" for d in _days(days)])


def _days(days) -> list[dt.date]:
    return [days] if isinstance(days, dt.date) else list(days)


def transform(bronze: DataFrame):
    """(silver user actions, quarantined rows) -- both lazy."""
    valid, quarantined = validate.split(bronze)
    return sessionize.user_actions(valid), quarantined


def run(spark: SparkSession, bronze_path: str, silver_path: str, days=None, *,
        quarantine_path: str | None = None,
        null_safe: bool = True, mode: str = "merge") -> str:
    """Process ``days`` of bronze into silver; returns 'empty', 'create', 'merge' or 'overwrite'.

    ``mode``:
      merge      upsert into the Parquet table at ``silver_path`` (never deletes)
      overwrite  replace the processed ``event_date`` partitions: the clean re-run
                 after late data, when run boundaries moved and stale runs must go
      sql        ``MERGE INTO`` the catalog table named ``silver_path`` (v2 catalogs)
      table      upsert into the catalog table named ``silver_path``, as ``ddl.create_silver_table`` declares it;
                 new (event_date, country) partitions are registered
    """
    ensure_defaults(spark)
    with writers.staging_scope(spark):
        return _run(spark, bronze_path, silver_path, days, quarantine_path, null_safe, mode)


def _run(spark, bronze_path, silver_path, days, quarantine_path, null_safe, mode) -> str:
    bronze = read_bronze_days(spark, bronze_path, days)
    if bronze.isEmpty():
        raise ValueError(f"no bronze rows for {days} at {bronze_path}")
    processed = _days(days) if days is not None else [r[0] for r in bronze.select("event_date").distinct().collect()]
    silver, quarantined = transform(bronze)
    if quarantine_path:
        _write_days(spark, quarantined, quarantine_path, processed)
    # Staged once: the merge reads it several times.  The days it touches are seen while it is written.
    silver, seen = writers.stage_observed(spark, silver, "silver-updates", days=F.collect_set("event_date"))
    if mode == "overwrite":
        _write_days(spark, writers.enforce_action_domain(merge.dedupe_updates(silver)), silver_path, processed)
        return "overwrite" if seen["days"] else "empty"
    if not seen["days"]:
        log.info("no user actions for %s", days)
        return "empty"
    if mode == "merge":
        return merge.merge_into_path(spark, silver, silver_path, null_safe=null_safe, days=seen["days"])
    if mode == "sql":
        merge.merge_into_table(spark, silver, silver_path)
        return "merge"
    if mode == "table":
        return merge.merge_into_registered(spark, silver, silver_path, seen["days"], null_safe=null_safe)
    raise ValueError(f"unknown mode {mode!r}")


def _write_days(spark: SparkSession, rows: DataFrame, path: str, processed: list, clustered: bool = True) -> None:
    """``rows`` replace the processed days at ``path``; what an earlier run left in days without rows now goes."""
    now = Observation()
    rows = rows.observe(now, F.collect_set("event_date").alias("days"))
    if writers.table_exists(spark, path):
        writers.overwrite_partitions(rows, path, ("event_date",), clustered=clustered)
    else:
        writers.create_partitioned(rows, path, ("event_date",))
    written = set(writers.observed(now).get("days", ()))                                                         # one value per day
    stale = [f"event_date={d}" for d in processed if d is not None and d not in written]
    writers.clear_partitions(spark, path, rows.schema, stale)


# ---------------------------------------------------------------------------- late data

def touched_keys(late: DataFrame) -> DataFrame:
    """Distinct (user, content, device, day) keys, one struct column, whose runs the rows may change."""
    act = sessionize.actionable(validate.split(late)[0])
    return act.select(F.struct(*sessionize.KEY_FIELDS).alias(sessionize.KEY)).distinct()


def of_keys(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows whose key is (``left_semi``) or is not (``left_anti``) among ``keys``, NULL fields matching NULL."""
    keyed = rows.withColumn(sessionize.KEY, F.struct(*sessionize.KEY_FIELDS))
    return keyed.join(keys, sessionize.KEY, how).drop(sessionize.KEY)


# Touched keys up to this many are broadcast, so that no other key's rows move.
MAX_BROADCAST_KEYS = 500_000


def correct(spark: SparkSession, bronze_path: str, late: DataFrame, silver_path: str, *,
            quarantine_path: str | None = None) -> str:
    """Sessionize again just the keys of ``late`` bronze rows (already landed at ``bronze_path``).

    A late event may split, join, lengthen or shorten runs, so all silver rows of its key and day are
    retracted and the recomputed ones take their place; the result is the table of a fresh run.  Rows
    of other keys are copied from their files to the rewritten day without a shuffle.  For events that were
    changed or removed, ``late`` holds their old rows as well.  Returns 'empty', 'create' or 'correct'.
    """
    ensure_defaults(spark)
    with writers.staging_scope(spark):
        keys, seen = writers.stage_observed(spark, touched_keys(late), "touched-keys", n=F.count(F.lit(1)),
                                            days=F.collect_set(f"{sessionize.KEY}.event_date"))
        if quarantine_path:
            days = [r[0] for r in late.select(F.to_date("event_date")).distinct().collect()]
            _write_days(spark, validate.split(read_bronze_days(spark, bronze_path, days))[1], quarantine_path, days)
        if not seen["n"]:
            return "empty"
        if seen["n"] <= MAX_BROADCAST_KEYS:
            keys = F.broadcast(keys)
        valid = validate.split(read_bronze_days(spark, bronze_path, seen["days"]))[0]
        rebuilt = sessionize.user_actions_from_actionable(of_keys(sessionize.actionable(valid), keys, "left_semi"))
        rebuilt = writers.enforce_action_domain(merge.dedupe_updates(rebuilt))
        if not writers.table_exists(spark, silver_path):
            writers.create_partitioned(rebuilt, silver_path, ("event_date",))
            return "create"
        kept = of_keys(merge.read_partitions(spark, silver_path, seen["days"]).select(*merge.COLUMNS), keys, "left_anti")
        rows = kept.unionByName(rebuilt.hint("rebalance", "event_date"))
        _write_days(spark, rows, silver_path, seen["days"], clustered=False)
    return "correct"
