"""Bronze landing: raw drops -> gate -> date-partitioned bronze table.

``land_daily`` covers both daily variants:

* ``layout="event_date"``      one partition level; a re-run replaces every
  ``event_date`` it contains (late rows replace whole older days)
* ``layout="processing_date"`` two levels (processing_date, event_date); a
  re-run only touches its own processing date -- the safe default

Write-audit-publish: the gzip drops (unsplittable, costly to parse) are
parsed once into a staged Parquet copy under the shared checkpoint folder;
the gate profiles the staged copy (4 columns, columnar) and only days that
pass are published.  Several drop days run as one batch with one verdict
per day, equal to running the days one by one.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import event_date, year_month_day
from ..operators import quality
from ..session import ensure_defaults, path_exists, table_exists
from ..sinks import writers
from ..sources import ledger, readers

log = logging.getLogger(__name__)

# Namespaces created by the landing job.
NAMESPACES = ("bronze", "silver", "gold")
PROCESS_DATE = "process_date"


class GateFailed(RuntimeError):
    pass


@dataclass
class LandingResult:
    status: str                      # "empty" | "published" | "blocked"
    published_days: list
    blocked_days: list


def with_process_date(raw: DataFrame, layout: readers.DropLayout = readers.DAILY_FILES) -> DataFrame:
    """Drop date taken from the file path at scan time (``_source_file`` when present)."""
    if readers.SOURCE_FILE in raw.columns:
        return raw.withColumn(PROCESS_DATE, readers.drop_date(layout, readers.SOURCE_FILE)).drop(readers.SOURCE_FILE)
    return raw.withColumn(PROCESS_DATE, readers.drop_date(layout))


def size_history(spark: SparkSession, metrics_path: str | None) -> DataFrame | None:
    """(process_date, size) of every earlier checked day from the metrics history.

    Every checked day counts, passed or not: within a batch each day is
    compared with the day before it, so the history must do the same for a
    batch run to equal day-by-day runs.
    """
    if not metrics_path or not table_exists(spark, metrics_path):
        return None
    m = spark.read.parquet(metrics_path)
    return m.filter(F.col("name") == "Size").select(PROCESS_DATE, F.col("value").cast("long").alias("size"))


def append_metrics(metrics: DataFrame, verdict: DataFrame, metrics_path: str) -> None:
    """Metric rows with the run's verdict; a re-run replaces its own process_date."""
    rows = metrics.join(verdict.select(PROCESS_DATE, "passed"), PROCESS_DATE)
    writers.overwrite_partitions(rows, metrics_path, (PROCESS_DATE,))


def land_daily(spark: SparkSession, source_base: str, bronze_path: str,
               days: dt.date | Iterable[dt.date], *, layout: str = "processing_date",
               gate: bool = True, as_of: dt.datetime | None = None,
               metrics_path: str | None = None, on_failure: str = "raise",
               drops: readers.DropLayout = readers.DAILY_FILES,
               size_change_bounds: tuple[float, float] = (quality.SIZE_MAX_DECREASE,
                                                          quality.SIZE_MAX_INCREASE),
               bad_lines_path: str | None = None) -> LandingResult:
    """Land the drops of ``days`` (one day or a batch of days).

    Lines that do not parse go to ``bad_lines_path`` (by default ``<bronze_path>_bad_lines``) with their
    text, by process date; bronze gets whole rows only.  Fields outside the schema stay as JSON text in
    ``extra_fields``.  A re-run leaves nothing of its own earlier run behind.
    """
    ensure_defaults(spark)
    days = [days] if isinstance(days, dt.date) else sorted(days)
    texts = {"timestamp": readers.RAW_TIMESTAMP} if gate else None
    raw = with_process_date(readers.read_drops(spark, source_base, days, layout=drops, raw_texts=texts), drops)
    return publish(spark, raw, bronze_path, layout=layout, gate=gate, as_of=as_of, metrics_path=metrics_path,
                   on_failure=on_failure, size_change_bounds=size_change_bounds, days=days, bad_lines_path=bad_lines_path)


def publish(spark: SparkSession, raw: DataFrame, bronze_path: str, *, layout: str = "processing_date",
            gate: bool = True, as_of: dt.datetime | None = None, metrics_path: str | None = None,
            on_failure: str = "raise",
            size_change_bounds: tuple[float, float] = (quality.SIZE_MAX_DECREASE, quality.SIZE_MAX_INCREASE),
            days: list | None = None, bad_lines_path: str | None = None) -> LandingResult:
    """Stage raw rows (with ``process_date``), gate them per day, publish the passing days."""
    with writers.staging_scope(spark):
        return _publish(spark, raw, bronze_path, layout, gate, as_of, metrics_path, on_failure, size_change_bounds, days,
                        bad_lines_path or bronze_path.rstrip("/") + "_bad_lines")


def _publish(spark, raw, bronze_path, layout, gate, as_of, metrics_path, on_failure, size_change_bounds, days,
             bad_lines_path) -> LandingResult:
    # Parse once into the staged copy; emptiness is checked there (no second read of the drops).
    staged = writers.stage(spark, raw, "bronze-staging")
    if staged.isEmpty():
        log.info("no rows in the drops for %s", days)
        return LandingResult("empty", [], [])

    passing, blocked = days, []
    if not gate and days is None:
        passing = sorted(r[0] for r in staged.select(PROCESS_DATE).distinct().collect())  # one row per day
    if gate:
        suite = quality.Suite(as_of=as_of or dt.datetime.now(dt.timezone.utc), batch_cols=(PROCESS_DATE,),
                              size_change_bounds=size_change_bounds,
                              raw_timestamp=readers.RAW_TIMESTAMP if readers.RAW_TIMESTAMP in staged.columns else None)
        # The profile (one row per day) is staged once; metrics, checks and the
        # verdict are narrow projections of it.
        wide, metrics, _checks, _anomalies, verdict = quality.run_checks(
            staged, suite, size_history(spark, metrics_path),
            materialize=lambda df: writers.stage(spark, df, "gate-profile"))
        if metrics_path:
            append_metrics(metrics, verdict, metrics_path)
        rows = verdict.collect()                                   # bounded by the days in the batch
        passing = sorted(r[PROCESS_DATE] for r in rows if r["passed"])
        blocked = sorted(r[PROCESS_DATE] for r in rows if not r["passed"])

    bad = (staged.filter(F.col(readers.CORRUPT_RECORD).isNotNull())
           .select(PROCESS_DATE, F.col(readers.CORRUPT_RECORD).alias("line")))
    if not bad.isEmpty() or table_exists(spark, bad_lines_path):
        writers.create_or_overwrite_partitions(spark, bad, bad_lines_path, (PROCESS_DATE,))
        with_bad = {r[0] for r in bad.select(PROCESS_DATE).distinct().collect()}            # one row per day
        writers.clear_partitions(spark, bad_lines_path, bad.schema,
                                 [f"{PROCESS_DATE}={d}" for d in (days or passing) if d not in with_bad])

    if passing:
        bronze = (staged.filter(F.col(PROCESS_DATE).isin(passing) & F.col(readers.CORRUPT_RECORD).isNull())
                  .withColumn("event_date", event_date("timestamp")))
        if layout == "processing_date":
            bronze = bronze.withColumnRenamed(PROCESS_DATE, "processing_date")
            cols = ("processing_date", "event_date")
        elif layout == "event_date":
            bronze = bronze.drop(PROCESS_DATE)
            cols = ("event_date",)
        else:
            raise ValueError(f"unknown layout {layout!r}")
        bronze = bronze.drop(readers.CORRUPT_RECORD, readers.RAW_TIMESTAMP)
        stale = _folders_of(spark, bronze_path, passing) if layout == "processing_date" else set()
        writers.create_or_overwrite_partitions(spark, bronze, bronze_path, cols)
        if stale:
            now = {f"processing_date={r[0]}/event_date={r[1]}" for r in bronze.select(*cols).distinct().collect()}
            writers.clear_partitions(spark, bronze_path, bronze.schema, sorted(stale - now))

    if blocked and on_failure == "raise":
        raise GateFailed(f"quality gate blocked {blocked}; published {passing}")
    return LandingResult("published" if passing else "blocked", passing, blocked)


def _folders_of(spark: SparkSession, bronze_path: str, days: list) -> set[str]:
    """Two-level partition folders that earlier runs of the given processing dates have left."""
    if not table_exists(spark, bronze_path):
        return set()
    root = bronze_path.rstrip("/")
    old = [f"{root}/processing_date={d}" for d in days if path_exists(spark, f"{root}/processing_date={d}")]
    if not old:
        return set()
    rows = readers.read_directories(spark, root, old).select("processing_date", "event_date").distinct()
    return {f"processing_date={a}/event_date={b}" for a, b in rows.collect() if b is not None}


def ingest_hourly(spark: SparkSession, root: str, table_path: str, process_dt: dt.datetime | None = None,
                  mode: str = "replace", contract=None) -> tuple[int, list]:
    """Hive-partitioned raw Parquet (region/date/hour) -> bronze snapshot.

    Only the directories of the wanted date and hour are listed and read; ``process_dt=None`` takes
    every hour.  ``mode='replace'``
    keeps only this run's rows; ``'partitions'`` replaces just the
    (region, year, month, day, hour) partitions present.
    """
    ensure_defaults(spark)
    if process_dt is None:
        df = readers.read_partitioned_parquet(spark, root, contract)
    else:
        base, hour = root.rstrip("/"), process_dt.hour
        df = readers.read_directories(spark, base, [f"{base}/region=*/date={process_dt.date()}/hour={{{hour},{hour:02d}}}"], contract)
    df = readers.with_source_file(df)          # lineage taken at the scan
    if df.isEmpty():
        return 0, []
    out = (df.select("*", *year_month_day("date"))
           .withColumn("ingestion_timestamp", F.current_timestamp())
           .drop("date"))
    if mode == "replace":
        writers.replace_table(out, table_path)
    else:
        writers.overwrite_partitions(out, table_path, ("region", "year", "month", "day", "hour"))
    return writers.verify_after_write(spark, table_path)


@dataclass
class IncrementalResult:
    files_read: int
    files_gone: int
    folders: list


FILE, HOURLY_KEYS = "source_file_name", ("region", "year", "month", "day", "hour")


def ingest_new_files(spark: SparkSession, root: str, table_path: str, ledger_path: str,
                     process_dt: dt.datetime | None = None, contract=None) -> IncrementalResult:
    """Hourly ingestion by ledger: only files that are new or changed since the last run are read.

    The table's rows carry the file they came from.  In each folder with a change, rows of changed and vanished
    files go, rows of the others stay, and those of the new files are added; other folders are not touched.
    A replay reads no file.  ``process_dt`` narrows the listing to one hour.  Data first, ledger last: a run
    that fails in between is repeated with the same result.
    """
    ensure_defaults(spark)
    base = root.rstrip("/")
    part = "region=*/date=*/hour=*" if process_dt is None else f"region=*/date={process_dt.date()}/hour={{{process_dt.hour},{process_dt.hour:02d}}}"
    known = ledger.known_files(spark, ledger_path)
    if process_dt is not None:
        known = known.filter(F.col("location").rlike(f"/date={process_dt.date()}/hour=0?{process_dt.hour}/"))
    with writers.staging_scope(spark):
        seen = ledger.changes(ledger.list_files(spark, [f"{base}/{part}"]), known)
        seen = writers.stage(spark, seen.filter(F.col("state") != ledger.SAME), "file-changes")
        # Paths of the changed files and folders: file names of one delivery, which the scan's plan lists anyway.
        files = [(r["location"], r["state"]) for r in seen.select("location", "state").collect()]
        if not files:
            return IncrementalResult(0, 0, [])
        fresh = sorted(p for p, state in files if state != ledger.GONE)
        folders = _hour_folders(seen)
        rows = None
        if fresh:
            rows = readers.with_source_file(readers.read_directories(spark, base, fresh, contract))
            rows = (rows.select("*", *year_month_day("date")).withColumn("ingestion_timestamp", F.current_timestamp()).drop("date"))
        if table_exists(spark, table_path):
            stays = _rows_of_folders(spark, table_path, sorted(folders.values())).join(
                seen.select(F.col("path").alias(FILE)), FILE, "left_anti")
            rows = stays if rows is None else rows.unionByName(stays, allowMissingColumns=True)
        if rows is not None:
            rows = writers.stage(spark, rows, "changed-folders")
            writers.create_or_overwrite_partitions(spark, rows, table_path, HOURLY_KEYS)
            left = {tuple(r) for r in rows.select(*HOURLY_KEYS).distinct().collect()}        # one row per changed folder
            writers.clear_partitions(spark, table_path, rows.schema, sorted(at for key, at in folders.items() if key not in left))
        ledger.record(spark, seen, ledger_path)
    return IncrementalResult(len(fresh), len(files) - len(fresh), sorted(folders.values()))


def _hour_folders(files: DataFrame) -> dict[tuple, str]:
    """Partition values -> folder of the table for the hours that the files lie in (one entry per folder)."""
    at = lambda key: F.regexp_extract("location", f"/{key}=([^/]+)/", 1)
    day = F.to_date(at("date"))
    rows = files.select(at("region"), F.year(day), F.month(day), F.dayofmonth(day), at("hour").cast("int")).distinct().collect()
    out = {}
    for region, *rest in rows:
        value = None if region == NULL_FOLDER else unquote(region)       # folder names escape special characters
        out[(value, *rest)] = "/".join(f"{k}={v}" for k, v in zip(HOURLY_KEYS, (region, *rest)))
    return out


# Fixed value: folder name of a NULL partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _rows_of_folders(spark: SparkSession, table_path: str, folders: list[str]) -> DataFrame:
    root = table_path.rstrip("/")
    found = [f"{root}/{at}" for at in folders if path_exists(spark, f"{root}/{at}")]
    if not found:
        return spark.read.parquet(root).limit(0)
    return readers.read_directories(spark, root, found)
