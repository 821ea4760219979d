"""Table writers on path-based Parquet (or a v2 catalog when one is configured).

Partitioned writes go through a ``rebalance`` hint on the partition columns:
rows of one partition value are clustered so each writer task emits few
files, and adaptive execution splits a hot partition value (say one day with
a third of all rows) over several tasks and merges tiny ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import VALID_ACTIONS
from ..session import can_move_paths, delete_path, path_exists, rename_path, scratch_path, table_exists


def _clustered(df: DataFrame, partition_cols) -> DataFrame:
    return df.hint("rebalance", *partition_cols) if partition_cols else df


def create_partitioned(df: DataFrame, path: str, partition_cols=("event_date",),
                       compression: str = "snappy") -> None:
    """Create a new partitioned table; fails when one is already there."""
    (_clustered(df, partition_cols).write.mode("errorifexists")
     .partitionBy(*partition_cols).option("compression", compression).parquet(path))


def overwrite_partitions(df: DataFrame, path: str, partition_cols=("event_date",),
                         compression: str = "snappy", clustered: bool = True) -> None:
    """Dynamic overwrite: replace only the partitions present in ``df``, which may be computed from them.

    The new files are written beside the table and take the place of the old ones when the job commits, so
    no copy is staged.  ``clustered=False`` is for rows that already lie by partition.
    """
    ((_clustered(df, partition_cols) if clustered else df).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).option("compression", compression).parquet(path))


def create_or_overwrite_partitions(spark: SparkSession, df: DataFrame, path: str,
                                   partition_cols=("event_date",)) -> str:
    """Create the table when absent, else replace the partitions present in ``df``."""
    if table_exists(spark, path):
        overwrite_partitions(df, path, partition_cols)
        return "overwrite"
    create_partitioned(df, path, partition_cols)
    return "create"


def replace_table(df: DataFrame, path: str, partition_cols=()) -> None:
    """Replace the whole table (every old partition is gone); ``df`` may read the old one.

    The new files are written beside the table, which stays readable all that time; then the folders change
    places by two renames.  A job that fails while writing leaves the old table as it was, and a failing
    second rename puts it back.  Under Spark Connect, which cannot move folders, the rows are staged and copied.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    if not can_move_paths(spark):
        w = _clustered(stage(spark, df, "replacement"), partition_cols).write.mode("overwrite").option("partitionOverwriteMode", "static")
        (w.partitionBy(*partition_cols) if partition_cols else w).parquet(root)
        return
    mark = uuid.uuid4().hex
    fresh, old = f"{root}__new_{mark}", f"{root}__old_{mark}"
    try:
        w = _clustered(df, partition_cols).write.mode("errorifexists")
        (w.partitionBy(*partition_cols) if partition_cols else w).parquet(fresh)
    except BaseException:
        delete_path(spark, fresh)
        raise
    there = path_exists(spark, root)
    if there:
        rename_path(spark, root, old)
    try:
        rename_path(spark, fresh, root)
    except BaseException:
        if there:
            rename_path(spark, old, root)
        raise
    if there:
        delete_path(spark, old)
    spark.catalog.refreshByPath(root)


def write_hive_partitioned(df: DataFrame, root: str, partition_cols, compression: str = "snappy",
                           mode: str = "overwrite") -> None:
    """``col=value/`` directory layout, snappy Parquet (raw drop layout)."""
    (_clustered(df, partition_cols).write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .option("compression", compression).partitionBy(*partition_cols).parquet(root))


def save_as_table(df: DataFrame, name: str, path: str, partition_cols=(), mode: str = "overwrite") -> None:
    """Register a catalog table whose data lives at ``path`` (an external table)."""
    w = _clustered(df, partition_cols).write.mode(mode).option("path", path)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.saveAsTable(name)


def create_databases(spark: SparkSession, names, catalog: str | None = None) -> None:
    """Idempotent namespace creation (one catalog prefix for all of them)."""
    for n in names:
        qualified = f"{catalog}.{n}" if catalog else n
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {qualified}")


def action_domain_violations(df: DataFrame, allowed=VALID_ACTIONS) -> DataFrame:
    """Rows whose ``action`` is outside the allowed domain (the table's row check)."""
    return df.filter(~F.coalesce(F.col("action").isin(*allowed), F.lit(False)))


def action_domain_counts(df: DataFrame, allowed=VALID_ACTIONS) -> DataFrame:
    """One row: rows_checked and violations of the domain check."""
    ok = F.coalesce(F.col("action").isin(*allowed), F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("rows_checked"), F.count_if(~ok).alias("violations"))


def assert_action_domain(df: DataFrame, allowed=VALID_ACTIONS) -> None:
    """Fail before a write when any row violates the domain check."""
    if not action_domain_violations(df, allowed).isEmpty():
        raise ValueError(f"rows with action outside {allowed}")


def enforce_action_domain(df: DataFrame, allowed=VALID_ACTIONS) -> DataFrame:
    """The same check inside the write job: a violating row fails the job, and a
    failed job commits nothing -- no separate pass over the data."""
    ok = F.coalesce(F.col("action").isin(*allowed), F.lit(False))
    msg = F.concat(F.lit(f"action outside {allowed}: "), F.coalesce(F.col("action"), F.lit("NULL")))
    return df.withColumn("action", F.when(ok, F.col("action")).otherwise(F.raise_error(msg).cast("string")))


def verify_after_write(spark: SparkSession, path: str, sample: int = 5):
    """Read the table back: (row count, first ``sample`` rows)."""
    table = spark.read.parquet(path)
    return table.count(), table.limit(sample).collect()


# Folders staged inside the open ``staging_scope`` blocks of this thread, innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("staging_scopes", default=())


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads the staged files instead of
    recomputing upstream shuffles) and lets several actions share one result.
    """
    path = scratch_path(spark, name)
    df.write.parquet(path)
    scopes = _SCOPES.get()
    if scopes:
        scopes[-1].append(path)
    return spark.read.parquet(path)


def stage_observed(spark: SparkSession, df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``stage`` with aggregates of the rows taken while they are written: they cost no job of their own."""
    seen = Observation()
    staged = stage(spark, df.observe(seen, *[m.alias(k) for k, m in metrics.items()]), name)
    return staged, {**dict.fromkeys(metrics), **observed(seen)}


def observed(seen: Observation) -> dict:
    """Observed values after the action; none where the optimizer has found the input to be empty and cut it off."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "PythonSQLUtils.toPyRow" not in str(error):
            raise
        return {}


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Folders staged inside the block (by this thread) are removed when it ends: for jobs that commit their own output."""
    own: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), own))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        for path in own:
            delete_path(spark, path)


# ---------------------------------------------------------------------------- named catalog tables

def _is_v2(spark: SparkSession, name: str) -> bool:
    """A table of a catalog other than the session's own is written through the v2 API."""
    parts = name.split(".")
    return len(parts) > 2 and parts[0] != "spark_catalog"


def named_table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_table(df: DataFrame, name: str, partition_cols=("event_date",)) -> None:
    """Create a named partitioned table from ``df``; fails when there is one."""
    rows = _clustered(df, partition_cols)
    if _is_v2(df.sparkSession, name):
        rows.writeTo(name).partitionedBy(*[F.col(c) for c in partition_cols]).create()
    else:
        rows.write.mode("errorifexists").partitionBy(*partition_cols).format("parquet").saveAsTable(name)


def overwrite_table_partitions(df: DataFrame, name: str, partition_cols=("event_date",)) -> None:
    """Replace only the partitions of the named table that are present in ``df``; columns go by name."""
    spark = df.sparkSession
    rows = _clustered(df, partition_cols)
    if _is_v2(spark, name):
        rows.writeTo(name).overwritePartitions()
    else:
        rows.select(*spark.table(name).columns).write.option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True)


def create_or_overwrite_table(df: DataFrame, name: str, partition_cols=("event_date",)) -> str:
    """Create the named table when absent, else replace the partitions present in ``df``."""
    if named_table_exists(df.sparkSession, name):
        overwrite_table_partitions(df, name, partition_cols)
        return "overwrite"
    create_table(df, name, partition_cols)
    return "create"


def replace_named_table(df: DataFrame, name: str, partition_cols=()) -> None:
    """Replace the whole named table; in the session catalog by a swap of its location (``swap_table``)."""
    if _is_v2(df.sparkSession, name):
        writer = df.writeTo(name)
        (writer.partitionedBy(*[F.col(c) for c in partition_cols]) if partition_cols else writer).createOrReplace()
    else:
        swap_table(df, name, partition_cols)


def swap_table(df: DataFrame, name: str, partition_cols=()) -> str:
    """Point the named table at a new folder that holds ``df``; returns the folder.

    The rows are written to a folder of their own first.  The switch is one ``ALTER TABLE ... SET LOCATION``, so
    readers see the old table or the new one and a job that fails at any point leaves the old one.  The
    folder of the generation before stays for queries that still read it; the ones before that are removed.
    New columns at the end are added first; other changes of the columns fail before anything is written.
    The catalog does not track the partitions of such a table (they are found by listing its folder).  A
    table that was made otherwise is registered anew at its first swap, after its new files are complete.
    """
    spark = df.sparkSession
    exists = named_table_exists(spark, name)
    rows = df.select(*[c for c in df.columns if c not in partition_cols], *partition_cols)
    swapped = exists and _generations(spark, name) is not None
    added = _added_columns(spark, name, rows, partition_cols) if swapped else []
    *database, table = name.split(".")
    home = spark.catalog.getDatabase(database[-1] if database else spark.catalog.currentDatabase()).locationUri
    folder = f"{home.rstrip('/')}/{table}__{uuid.uuid4().hex}"
    w = _clustered(rows, partition_cols).write.mode("errorifexists")
    (w.partitionBy(*partition_cols) if partition_cols else w).parquet(folder)
    if swapped:
        before = _generations(spark, name)
        if added:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in added)})")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{GENERATIONS}' = '{before[-1]} {folder}')")
        for stale in before[:-1]:
            delete_path(spark, stale)
    else:
        if exists:
            spark.sql(f"DROP TABLE {name}")
        _register_listed(spark, name, folder, rows.schema, partition_cols)
    spark.catalog.refreshTable(name)
    return folder


# Table property: folders of a swapped table, the current one last.
GENERATIONS = "swap.generations"


def _generations(spark: SparkSession, name: str) -> list[str] | None:
    shown = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}   # a few rows of the catalog
    return shown[GENERATIONS].split(" ") if GENERATIONS in shown else None


def _added_columns(spark: SparkSession, name: str, rows: DataFrame, partition_cols) -> list[T.StructField]:
    now = [(f.name, f.dataType) for f in spark.table(name).schema.fields]
    parts, plain = now[len(now) - len(partition_cols):], now[:len(now) - len(partition_cols)]
    wanted = rows.schema.fields[:len(rows.columns) - len(partition_cols)]
    if [c for c, _ in parts] != list(partition_cols) or [(f.name, f.dataType) for f in wanted[:len(plain)]] != plain:
        raise ValueError(f"columns or partitions of {name} differ: {now} and {rows.schema.simpleString()}")
    return wanted[len(plain):]


def _register_listed(spark: SparkSession, name: str, folder: str, schema: T.StructType, partition_cols) -> None:
    """External table over ``folder`` whose partitions the catalog does not track."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_cols)})" if partition_cols else ""
    tracked = spark.conf.get("spark.sql.hive.manageFilesourcePartitions")
    spark.conf.set("spark.sql.hive.manageFilesourcePartitions", "false")
    try:
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {by} LOCATION '{folder}' TBLPROPERTIES ('{GENERATIONS}' = '{folder}')")
    finally:
        spark.conf.set("spark.sql.hive.manageFilesourcePartitions", tracked)


# ---------------------------------------------------------------------------- stale partitions

def clear_partitions(spark: SparkSession, path: str, schema: T.StructType, folders) -> None:
    """Empty the partition folders (relative to ``path``) that exist; used for days without new rows."""
    partitioned = {part.split("=")[0] for f in folders for part in f.split("/")}
    fields = T.StructType([f for f in schema.fields if f.name not in partitioned])
    for folder in folders:
        target = f"{path.rstrip('/')}/{folder}"
        if path_exists(spark, target):
            spark.createDataFrame([], fields).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target)
