"""Session factory and session-level defaults.

The pipeline's date logic (epoch ms -> timestamp -> date) depends on the
session time zone, so every entry point pins it to UTC.  Paths stay
URI-agnostic: object-store and catalog settings come in as a plain dict.
"""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Session settings the pipeline relies on.
PIPELINE_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Starting point for a large cluster (~1000 executors, ~100 TB per backfill):
# many initial shuffle partitions that AQE coalesces to ~256 MB each, 256 MB
# input splits, skew splitting for joins and rebalanced writes.
CLUSTER_PROFILE = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app_name: str, conf: dict | None = None, master: str | None = None,
                  profile: dict | None = None) -> SparkSession:
    """Create (or attach to) a session by application name.

    ``master`` is left to spark-submit unless given; ``conf`` carries
    connector settings such as ``spark.hadoop.fs.s3a.*`` or catalog entries;
    ``profile`` (e.g. ``CLUSTER_PROFILE``) supplies defaults that ``conf`` overrides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**PIPELINE_DEFAULTS, **(profile or {}), **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_defaults(spark)
    return spark


def ensure_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for key, value in PIPELINE_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """The package sent to the Python workers, as ``--py-files`` would, once per application."""
    context = _context(spark)
    if context is None or context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    if package.is_dir():                                   # an archive on the path was shipped by its submitter
        archive = Path(tempfile.mkdtemp(prefix="clicklake-py-")) / "clicklake_core.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))                    # the driver serves it to every executor
    _SHIPPED.add(context.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  When neither is set a local
    run gets a private folder; on any other master that would be a folder of one machine, so the call
    fails instead.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or None
    context = _context(spark)
    if not root and context is not None:
        root = context.getCheckpointDir()
    if not root:
        master = context.master if context is not None else ""
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="clicklake-ckpt-")
        context.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of any Hadoop file system (nothing happens under Spark Connect, which has no handle on it)."""
    context = _context(spark)
    if context is not None:
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def can_move_paths(spark: SparkSession) -> bool:
    """Spark Connect has no handle on the file system."""
    return _context(spark) is not None


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder within its Hadoop file system; ``target`` must not exist."""
    context = _context(spark)
    old, new = context._jvm.org.apache.hadoop.fs.Path(source), context._jvm.org.apache.hadoop.fs.Path(target)
    if not old.getFileSystem(context._jsc.hadoopConfiguration()).rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions raise here
        return None


def session_id(spark: SparkSession) -> str:
    context = _context(spark)
    return context.applicationId if context is not None else spark.conf.get("spark.app.id", str(id(spark)))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/clicklake/{name}/{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """One filesystem metadata call (any Hadoop URI); no listing of the table."""
    context = _context(spark)
    if context is None:  # Spark Connect: no JVM handle, fall back to a read attempt
        return _readable(spark, path)
    jvm = context._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(context._jsc.hadoopConfiguration()).exists(hpath))


def _readable(spark: SparkSession, path: str) -> bool:
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when a committed Parquet table lives at ``path``."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS") or (path_exists(spark, path) and _readable(spark, path))
