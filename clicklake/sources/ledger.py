"""Ledger of ingested files: what changed since the last run, by path, length and modification time.

The listing is a DataFrame (the file source's metadata; no file is opened) and so is the ledger, a Parquet
table to which every run appends what it ingested or found gone.  Their difference is one full outer join
on the path.  The ledger is written after the data, so a run that dies in between is repeated with the same
files, which replace the same rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_exists

NEW, CHANGED, GONE, SAME = "new", "changed", "gone", "same"
COLUMNS = "path string, location string, length bigint, modified timestamp"


def list_files(spark: SparkSession, patterns: list[str], name_glob: str = "*.parquet") -> DataFrame:
    """(path, location, length, modified) of the files below folders or globs; nothing there: no rows.

    ``path`` is the name that ``_metadata.file_path`` gives the rows of a file, ``location`` the one to read it by
    (not URL-encoded).  The content column is pruned, so only file statuses are read.
    """
    try:
        found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", name_glob).load(patterns))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COLUMNS)
    return found.select(F.col("_metadata.file_path").alias("path"), F.col("path").alias("location"), "length",
                        F.col("modificationTime").alias("modified"))


def known_files(spark: SparkSession, ledger_path: str) -> DataFrame:
    """(path, location, length, modified) of the files whose latest ledger entry says they are ingested."""
    if not table_exists(spark, ledger_path):
        return spark.createDataFrame([], COLUMNS)
    entry = F.struct("run_at", "location", "length", "modified", "state")
    last = spark.read.parquet(ledger_path).groupBy("path").agg(F.max(entry).alias("e"))
    return last.filter(F.col("e.state") != GONE).select("path", "e.location", "e.length", "e.modified")


def changes(listed: DataFrame, known: DataFrame) -> DataFrame:
    """(path, location, length, modified, state): ``new``, ``changed``, ``gone`` or ``same`` for every file on either side."""
    now = listed.select("path", F.struct("location", "length", "modified").alias("now"))
    before = known.select("path", F.struct("location", "length", "modified").alias("before"))
    state = (F.when(F.col("before").isNull(), NEW).when(F.col("now").isNull(), GONE)
             .when(F.col("now") == F.col("before"), SAME).otherwise(CHANGED))
    seen = F.coalesce("now", "before")
    return (now.join(before, "path", "full_outer")
            .select("path", *[seen[c].alias(c) for c in ("location", "length", "modified")], state.alias("state")))


def record(spark: SparkSession, changed: DataFrame, ledger_path: str) -> None:
    """Append the changes of a run, stamped with its time (one entry per file, later ones win)."""
    rows = changed.filter(F.col("state") != SAME).withColumn("run_at", F.current_timestamp())
    rows.write.mode("append").parquet(ledger_path)
