"""Small helpers shared by the operators: typed inputs, staging, pass-1 offsets."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_defaults
from ..sinks.writers import stage as _stage

# The white space of the text contracts ([\x20\x09-\x0D]).
WHITESPACE_CLASS = r"[\x20\x09-\x0D]"


def text_of(column: str | Column) -> Column:
    """The text, NULL read as empty."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(""))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once under the shared checkpoint folder and read back (cuts lineage)."""
    return _stage(df.sparkSession, df, f"llm-{name}")


# Rows of a narrow staged table that are broadcast; a larger one is joined by a shuffle.
MAX_BROADCAST_ROWS = 500_000


def broadcast_if_small(df: DataFrame, most: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` (staged, narrow rows) with a broadcast hint if its counted rows are few enough."""
    return F.broadcast(df) if df.count() <= most else df


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column of ``df`` is called that."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def slices(batches: Iterator, rows: int = 1024) -> Iterator:
    """The Arrow batches in pieces of at most ``rows`` rows, so that what a worker builds of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def offsets_by_part(totals: DataFrame, part: str, total: str, out: str, *groups: str) -> DataFrame:
    """Exclusive prefix sums of per-partition totals, in partition order.

    ``totals`` holds one row per (group and) partition of a staged table, so its
    size is the number of tasks that wrote it, whatever the number of rows.
    """
    order = Window.partitionBy(*groups) if groups else Window.partitionBy()
    before = order.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(out, F.coalesce(F.sum(total).over(before), F.lit(0).cast("long")))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.

    ``translate`` deletes NUL characters, so a text that holds one takes the slower way round.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    by_char = F.array_join(F.transform(F.split(c, ""), lambda x: F.when(x.between("A", "Z"), F.lower(x)).otherwise(x)), "")
    return F.when(F.contains(c, F.lit("\0")), by_char).otherwise(F.translate(c, upper, lower))


_SHIPPED: set[str] = set()
# Bytes of an Arrow batch between an executor and a Python worker: 10,000 rows, Spark's own bound, may be whole texts.
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session defaults, and the package sent to the Python workers (as ``--py-files`` would) once per application."""
    ensure_defaults(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="clicklake-py-")) / "clicklake.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))  # the driver serves it to every executor
        _SHIPPED.add(context.applicationId)
    return spark
