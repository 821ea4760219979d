"""Quality metrics of long ranges from daily states, without the data.

A day leaves two small tables: ``sums`` (one row: counts and exact sums) and ``frequencies`` (one row per
column and value: its count).  Both are additive, so the states of any days merge by adding them up, and
every metric of the suite -- uniqueness and entropy too, which do not follow from the days' own metrics --
is computed from merged states.  A re-checked day replaces its own states.

Frequencies are as long as the day's distinct values and stay distributed: merging shuffles (column, value)
counts that are pre-aggregated per task, so a value that a third of all rows hold is one row a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import content_required, timestamp_in_range
from ..sinks import writers
from . import quality

SUMS, FREQUENCIES = "sums", "frequencies"


def _sum_columns(suite: quality.Suite) -> list[Column]:
    holds = lambda pred: F.count_if(F.coalesce(pred, F.lit(False)))
    ts = F.col("timestamp")
    present = sorted({c for _, c in suite.profile if c != "*"} | {"timestamp"})
    summed = sorted({c for m, c in suite.profile if m == "Mean"})
    return [F.count(F.lit(1)).alias("size"),
            *[F.count(c).alias(f"present_{c}") for c in present],
            *[F.sum(F.col(c).cast("decimal(38,0)")).alias(f"sum_{c}") for c in summed],
            holds(F.coalesce(ts, F.lit(0)) >= 0).alias("non_negative_timestamp"),
            holds(timestamp_in_range(suite.as_of)).alias("timestamp_range"),
            holds(content_required()).alias("content_required"),
            F.count_if(ts.cast("string").rlike(quality.INTEGRAL_PATTERN)).alias("integral_timestamp")]


def daily_sums(df: DataFrame, suite: quality.Suite) -> DataFrame:
    """One row of additive counts and sums per batch."""
    return df.groupBy(*suite.batch_cols).agg(*_sum_columns(suite))


def daily_frequencies(df: DataFrame, suite: quality.Suite) -> DataFrame:
    """(batch..., column, value, n) of the non-NULL values of every frequency column, from one shuffle."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in suite.freq_columns()]
    return (df.select(*suite.batch_cols, F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())
            .groupBy(*suite.batch_cols, "column", "value").agg(F.count(F.lit(1)).alias("n")))


def save_states(df: DataFrame, suite: quality.Suite, path: str) -> None:
    """Write the states of the batches in ``df`` below ``path``; states of the same batches are replaced."""
    spark, by = df.sparkSession, suite.batch_cols
    root = path.rstrip("/")
    writers.create_or_overwrite_partitions(spark, daily_sums(df, suite), f"{root}/{SUMS}", by)
    writers.create_or_overwrite_partitions(spark, daily_frequencies(df, suite), f"{root}/{FREQUENCIES}", by)


def range_profile(spark: SparkSession, path: str, suite: quality.Suite, group: dict[str, Column] | None = None,
                  where: Column | None = None) -> DataFrame:
    """The wide profile over merged days: one row per ``group`` (name -> expression over the batch columns).

    ``where`` picks batches (a partition filter).  Without ``group`` there is one row for all picked days.  The
    columns are those of ``quality.profile_wide``, so ``profile_rows``, ``check_rows`` and the gate take it.
    """
    group = group or {}
    names = list(group)

    def state(kind: str, schema: T.StructType | None = None) -> DataFrame:
        reader = spark.read if schema is None else spark.read.schema(schema)
        rows = reader.parquet(f"{path.rstrip('/')}/{kind}")
        rows = rows.filter(where) if where is not None else rows
        return rows.withColumns(group) if group else rows

    sums = state(SUMS)
    counted = [c for c in sums.columns if c not in (*names, *suite.batch_cols)]
    total = sums.groupBy(*names).agg(*[F.sum(c).alias(c) for c in counted])
    wide = total.select(*names, *_metrics_of_sums(suite))
    # Days without any value leave no frequency file, so the columns are stated.
    values = T.StructType([f for f in sums.schema.fields if f.name in suite.batch_cols]).add("column", "string").add("value", "string").add("n", "long")
    freq = state(FREQUENCIES, values).groupBy(*names, "column", "value").agg(F.sum("n").alias("n"))
    freq = quality.metrics_of_frequencies(freq, names, suite.freq_columns())
    if names:
        return wide.join(freq, names, "left")
    return wide.crossJoin(freq)                       # one row each


def _metrics_of_sums(suite: quality.Suite) -> list[Column]:
    rows, ratio = F.col("size"), quality._ratio
    out = [rows.alias("size")]
    for m, c in suite.profile:
        if m == "Completeness":
            out.append(ratio(F.col(f"present_{c}"), rows).alias(quality._metric_col(m, c)))
        elif m == "Mean":
            out.append(ratio(F.col(f"sum_{c}"), F.col(f"present_{c}")).alias(quality._metric_col(m, c)))
    return out + [ratio(F.col("non_negative_timestamp"), rows).alias("compliance_non_negative_timestamp"),
                  ratio(F.col("integral_timestamp"), F.col("present_timestamp")).alias("ratio_integral_timestamp"),
                  ratio(F.col("timestamp_range"), rows).alias("compliance_timestamp_range"),
                  ratio(F.col("content_required"), rows).alias("compliance_content_required")]
