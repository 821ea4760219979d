"""Idempotent upsert of user actions into the silver table.

Match on (user_id, content_id, device_id, action, start_time): a matched row
takes the new ``end_time`` and ``duration_seconds``, an unmatched update is
inserted, target rows are never deleted.

On path-based Parquet the merge reads only the ``event_date`` partitions the
updates touch (``event_date`` is the date of ``start_time``, so a match can
only sit in a touched partition), joins them with the updates and overwrites
those partitions in one job: a dynamic overwrite reads the old files until it
commits.  A table bucketed on the merge key takes the same merge without moving
its own rows.  A catalog that supports ``MERGE INTO`` (Iceberg, Delta) can take
the SQL form instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SILVER_USER_ACTIONS
from ..session import path_exists, table_exists
from .writers import create_partitioned, enforce_action_domain, overwrite_partitions, overwrite_table_partitions, stage_observed, staging_scope

MERGE_KEYS = ("user_id", "content_id", "device_id", "action", "start_time")
UPDATED = ("end_time", "duration_seconds")
COLUMNS = tuple(f.name for f in SILVER_USER_ACTIONS.fields)


MK = "_merge_key"


def _merge_key() -> "F.Column":
    # One struct column: struct equality and hashing treat NULL fields as equal,
    # so the join is null-safe and keeps the partitioning of the dedupe aggregate.
    return F.struct(*MERGE_KEYS).alias(MK)


def _dedupe_keyed(updates: DataFrame) -> DataFrame:
    others = [c for c in COLUMNS if c not in MERGE_KEYS]
    rank = F.struct((-F.unix_micros("end_time")).alias("neg_end"), F.col("country").alias("country"))
    return (updates.groupBy(_merge_key()).agg(F.min_by(F.struct(*others), rank).alias("_r"))
            .select(MK, *[F.col(f"{MK}.{k}").alias(k) for k in MERGE_KEYS], "_r.*"))


def dedupe_updates(updates: DataFrame) -> DataFrame:
    """One row per merge key: the latest ``end_time``, then the smallest ``country``.

    A plain aggregate (partial aggregation map-side); groups are one run each.
    """
    return _dedupe_keyed(updates).select(*COLUMNS)


def merge_frames(target: DataFrame, updates: DataFrame, null_safe: bool = True,
                 dedupe: bool = True) -> DataFrame:
    """The merged table as a DataFrame (full outer join on the merge keys)."""
    if null_safe:
        s = _dedupe_keyed(updates) if dedupe else updates.select(_merge_key(), *COLUMNS)
        t = target.select(_merge_key(), *COLUMNS)
        cond = [F.col(f"t.{MK}") == F.col(f"s.{MK}")]
    else:
        s = dedupe_updates(updates) if dedupe else updates.select(*COLUMNS)
        t = target.select(*COLUMNS)
        cond = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in MERGE_KEYS]
    s = s.withColumn("_in_s", F.lit(True)).alias("s")
    t = t.withColumn("_in_t", F.lit(True)).alias("t")
    joined = t.join(s, cond, "full_outer")
    in_t, in_s = F.coalesce(F.col("t._in_t"), F.lit(False)), F.coalesce(F.col("s._in_s"), F.lit(False))
    out = []
    for c in COLUMNS:
        if c in UPDATED:
            out.append(F.when(in_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return joined.select(*out)


def merge_into_path(spark: SparkSession, updates: DataFrame, target_path: str,
                    null_safe: bool = True, days: list | None = None) -> str:
    """MERGE ``updates`` into the Parquet table at ``target_path``; returns 'create' or 'merge'.

    ``days`` names the event dates that staged updates touch; without it the updates are staged here.
    The action-domain check runs inside the write jobs (``enforce_action_domain``).
    """
    updates = enforce_action_domain(updates)
    if not table_exists(spark, target_path):
        create_partitioned(dedupe_updates(updates), target_path, ("event_date",))
        return "create"
    with staging_scope(spark):
        if days is None:  # seen while the updates are staged; bounded by the number of days in the batch
            updates, seen = stage_observed(spark, updates, "merge-updates", days=F.collect_set("event_date"))
            days = seen["days"] or []
        target = read_partitions(spark, target_path, days)
        overwrite_partitions(merge_frames(target, updates, null_safe), target_path, ("event_date",))
    return "merge"


def merge_into_registered(spark: SparkSession, updates: DataFrame, table: str, days: list, null_safe: bool = True) -> str:
    """MERGE staged ``updates`` of ``days`` into the catalog table of ``ddl.create_silver_table``.

    The catalog answers which partitions the days have; only those are read and rewritten, and the write
    registers the (event_date, country) values that are new.  Nothing lists or repairs the whole table.
    """
    target = spark.table(table).filter(F.col("event_date").isin(days))
    merged = merge_frames(target, enforce_action_domain(updates), null_safe)
    overwrite_table_partitions(merged, table, ("event_date", "country"))
    return "merge"


# ---------------------------------------------------------------------------- tables bucketed on the merge key

MERGE_HASH = "merge_key"


def _merge_hash() -> "F.Column":
    """128-bit digest of the merge key as one text: NULL fields are left out, so equal keys have equal digests."""
    return F.md5(F.to_json(F.struct(*[(F.unix_micros(k) if k == "start_time" else F.col(k)).alias(k) for k in MERGE_KEYS])))


def create_bucketed(updates: DataFrame, table: str, buckets: int) -> None:
    """Catalog table of deduped rows by ``event_date``, bucketed and sorted on the digest of the merge key."""
    rows = dedupe_updates(enforce_action_domain(updates)).withColumn(MERGE_HASH, _merge_hash())
    (rows.repartition(buckets, MERGE_HASH).write.partitionBy("event_date").bucketBy(buckets, MERGE_HASH).sortBy(MERGE_HASH)
     .format("parquet").saveAsTable(table))


def bucketed_merge(target: DataFrame, updates: DataFrame, buckets: int) -> DataFrame:
    """Rows of the merged table; only the updates are exchanged, into the target's buckets."""
    fresh = dedupe_updates(updates).withColumn(MERGE_HASH, _merge_hash()).repartition(buckets, MERGE_HASH)
    s, t = fresh.withColumn("_in_s", F.lit(True)).alias("s"), target.withColumn("_in_t", F.lit(True)).alias("t")
    joined = t.join(s, F.col(f"t.{MERGE_HASH}") == F.col(f"s.{MERGE_HASH}"), "full_outer")
    out = []
    for c in (*COLUMNS, MERGE_HASH):
        first, second, known = ("s", "t", "s._in_s") if c in UPDATED else ("t", "s", "t._in_t")
        out.append(F.when(F.col(known), F.col(f"{first}.{c}")).otherwise(F.col(f"{second}.{c}")).alias(c))
    return joined.select(*out)


def merge_into_bucketed(spark: SparkSession, updates: DataFrame, table: str, buckets: int) -> str:
    """The merge on a table of ``create_bucketed``; returns 'create' or 'merge'."""
    if not spark.catalog.tableExists(table):
        create_bucketed(updates, table, buckets)
        return "create"
    with staging_scope(spark):
        updates, seen = stage_observed(spark, enforce_action_domain(updates), "merge-updates", days=F.collect_set("event_date"))
        target = spark.table(table).filter(F.col("event_date").isin(seen["days"] or []))
        merged = bucketed_merge(target, updates, buckets).select(*spark.table(table).columns)
        merged.write.option("partitionOverwriteMode", "dynamic").insertInto(table, overwrite=True)
    return "merge"


def read_partitions(spark: SparkSession, path: str, days) -> DataFrame:
    """The ``event_date`` partitions of ``days`` only: just those directories are listed."""
    root = path.rstrip("/")
    dirs = [f"{root}/event_date={d}" for d in days]
    dirs = [d for d in dirs if path_exists(spark, d)]
    reader = spark.read.schema(SILVER_USER_ACTIONS).option("basePath", root)
    if not dirs:
        return spark.createDataFrame([], SILVER_USER_ACTIONS)
    return reader.parquet(*dirs)


def merge_into_table(spark: SparkSession, updates: DataFrame, table: str) -> None:
    """SQL MERGE for catalogs that support it (v2 tables)."""
    on = " AND ".join(f"t.{k} <=> s.{k}" for k in MERGE_KEYS)
    spark.sql(
        f"""MERGE INTO {table} t USING {{src}} s ON {on}
            WHEN MATCHED THEN UPDATE SET t.end_time = s.end_time, t.duration_seconds = s.duration_seconds
            WHEN NOT MATCHED THEN INSERT *""",
        src=dedupe_updates(enforce_action_domain(updates)))
