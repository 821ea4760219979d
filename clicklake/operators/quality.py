"""Data-quality profile, constraint checks, size anomaly and the ingestion gate.

Metric definitions (standard meanings):

* completeness  = non-NULL rows / rows
* uniqueness    = values occurring exactly once / non-NULL rows
* distinctness  = distinct values / non-NULL rows
* entropy       = -sum p ln p over the non-NULL value frequencies
* mean          = average of non-NULL values
* compliance    = rows where the predicate is TRUE / rows (NULL counts as not satisfied)

Cost: every metric of a batch comes from two jobs, whatever the number of
columns: one wide aggregate (sizes, completeness, mean, compliance) and one
frequency aggregate in which all profiled columns share a single shuffle
(values are exploded to (column, value) pairs and pre-aggregated map-side, so
a hot value sends one row per task).  Both are grouped by optional batch
columns (e.g. ``process_date``) so a backfill checks many days in one pass.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import content_required, timestamp_in_range

# Profiled metrics as (metric, column) in reporting order.
PROFILE = (
    ("Size", "*"),
    ("Completeness", "user_id"),
    ("Uniqueness", "user_id"),
    ("Completeness", "content_id"),
    ("Distinctness", "content_id"),
    ("Completeness", "event_type"),
    ("Distinctness", "event_type"),
    ("Entropy", "event_type"),
    ("Completeness", "timestamp"),
    ("Mean", "timestamp"),
)
# Integral-number pattern used by the data-type check.
INTEGRAL_PATTERN = r"^[-+]?\d+$"
# Kinds of raw values told apart by the data-type check, and the patterns of their JSON texts.
KINDS = ("integral", "fractional", "boolean", "string", "unknown")
FRACTIONAL_PATTERN = r"^[-+]?\d*\.?\d+([eE][-+]?\d+)?$|^[-+]?\d+\.$"
BOOLEAN_PATTERN = r"^(true|false)$"
# Completeness threshold and size-change bounds of the gate.
USER_ID_MIN_COMPLETENESS = 0.95
SIZE_MAX_DECREASE = -100000.0
SIZE_MAX_INCREASE = 100000.0

SUCCESS, FAILURE, ERROR = "Success", "Failure", "Error"
NO_HISTORY = "no history"


def _metric_col(metric: str, column: str) -> str:
    return "size" if metric == "Size" else f"{metric.lower()}_{column}"


@dataclass
class Suite:
    """The bronze check suite; ``as_of`` is the upper time reference of the range check."""

    as_of: dt.datetime
    batch_cols: tuple[str, ...] = ()
    profile: tuple[tuple[str, str], ...] = PROFILE
    name: str = "raw events quality"
    frequency_columns: tuple[str, ...] = field(default=())
    size_change_bounds: tuple[float, float] = (SIZE_MAX_DECREASE, SIZE_MAX_INCREASE)
    # Column with the JSON text of the timestamp as it was delivered, before any cast; None: only the cast value is at hand.
    raw_timestamp: str | None = None

    def freq_columns(self) -> list[str]:
        if self.frequency_columns:
            return list(self.frequency_columns)
        cols = []
        for m, c in self.profile:
            if m in ("Uniqueness", "Distinctness", "Entropy") and c not in cols:
                cols.append(c)
        return cols


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den.cast("double"))


def value_kind(text: Column) -> Column:
    """Kind of a JSON value by its text: integral, fractional, boolean, string (quoted, or anything else); unknown for NULL."""
    return (F.when(text.isNull() | (text == "null"), "unknown").when(text.rlike(INTEGRAL_PATTERN), "integral")
            .when(text.rlike(FRACTIONAL_PATTERN), "fractional").when(text.rlike(BOOLEAN_PATTERN), "boolean").otherwise("string"))


def kind_counts(text: Column, name: str) -> list[Column]:
    """One count per kind of the raw texts, as aggregates: ``<kind>_<name>``."""
    kind = value_kind(text)
    return [F.count_if(kind == k).alias(f"{k}_{name}") for k in KINDS]


def type_histogram(df: DataFrame, text_col: str, name: str, batch_cols=()) -> DataFrame:
    """(batch..., kind, n): how many raw values are of each kind, zero counts too (one map-side aggregate)."""
    counts = df.groupBy(*batch_cols).agg(*kind_counts(F.col(text_col), name))
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_{name}").alias("n")) for k in KINDS])
    return counts.select(*batch_cols, F.inline(rows))


def _integral_timestamp(suite: Suite) -> list[Column]:
    """The share of integral timestamps among the typed ones, from the delivered texts where they are at hand."""
    ts = F.col("timestamp")
    if suite.raw_timestamp is None:
        return [_ratio(F.sum(ts.cast("string").rlike(INTEGRAL_PATTERN).cast("long")), F.count(ts)).alias("ratio_integral_timestamp")]
    kind = value_kind(F.col(suite.raw_timestamp))
    return [_ratio(F.count_if(kind == "integral"), F.count_if(kind != "unknown")).alias("ratio_integral_timestamp"),
            *kind_counts(F.col(suite.raw_timestamp), "timestamp")]


def _wide_aggregates(suite: Suite) -> list[Column]:
    rows = F.count(F.lit(1))
    ts = F.col("timestamp")
    aggs = [rows.alias("size")]
    for m, c in suite.profile:
        if m == "Completeness":
            aggs.append(_ratio(F.count(c), rows).alias(_metric_col(m, c)))
        elif m == "Mean":
            # Exact sum (decimal) before the division: the mean does not depend on row order.
            aggs.append(_ratio(F.sum(F.col(c).cast("decimal(38,0)")), F.count(c)).alias(_metric_col(m, c)))
    as_int = lambda pred: F.sum(F.coalesce(pred, F.lit(False)).cast("long"))
    aggs += [
        _ratio(as_int(F.coalesce(ts, F.lit(0)) >= 0), rows).alias("compliance_non_negative_timestamp"),
        *_integral_timestamp(suite),
        _ratio(as_int(timestamp_in_range(suite.as_of)), rows).alias("compliance_timestamp_range"),
        _ratio(as_int(content_required()), rows).alias("compliance_content_required"),
    ]
    return aggs


def integral_ratio(df: DataFrame, text_col: str, batch_cols=()) -> DataFrame:
    """``ratio_integral``: share of the non-NULL raw texts written as whole numbers, per batch (before any cast)."""
    whole = F.count_if(F.col(text_col).rlike(INTEGRAL_PATTERN))
    return df.groupBy(*batch_cols).agg(_ratio(whole, F.count(text_col)).alias("ratio_integral"))


def _frequency_metrics(df: DataFrame, suite: Suite) -> DataFrame:
    """Uniqueness, distinctness and entropy of every frequency column in one shuffle."""
    batch = list(suite.batch_cols)
    cols = suite.freq_columns()
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]))
    freq = (df.select(*batch, pairs.alias("p"))
            .select(*batch, "p.column", "p.value")
            .filter(F.col("value").isNotNull())
            .groupBy(*batch, "column", "value").agg(F.count(F.lit(1)).alias("n")))
    return metrics_of_frequencies(freq, batch, cols)


def metrics_of_frequencies(freq: DataFrame, batch: list[str], cols: list[str]) -> DataFrame:
    """(batch..., column, value, n) -> one row per batch with a column per (metric, column).

    One conditional aggregate: no pivot, one small shuffle.
    """
    n = F.col("n").cast("double")
    aggs = []
    for c in cols:
        mine = F.col("column") == c
        total = F.sum(F.when(mine, n))
        aggs += [
            (F.coalesce(F.sum(F.when(mine & (F.col("n") == 1), 1.0)), F.lit(0.0)) / total)
            .alias(f"uniqueness_{c}"),
            (F.sum(F.when(mine, 1.0)) / total).alias(f"distinctness_{c}"),
            # -sum p ln p == ln N - sum(n ln n) / N
            (F.log(total) - F.sum(F.when(mine, n * F.log(n))) / total).alias(f"entropy_{c}"),
        ]
    return freq.groupBy(*batch).agg(*aggs)


def profile_wide(df: DataFrame, suite: Suite) -> DataFrame:
    """One row per batch: every metric and compliance ratio as a column."""
    batch = list(suite.batch_cols)
    wide = df.groupBy(*batch).agg(*_wide_aggregates(suite))
    freq = _frequency_metrics(df, suite)
    if batch:
        # Batches with only NULL values still get a profile row.
        return wide.join(freq, batch, "left")
    # Unbatched: both sides are a single row.
    return wide.crossJoin(freq)


def profile_rows(wide: DataFrame, suite: Suite) -> DataFrame:
    """Metrics in long form: (batch..., entity, instance, name, value)."""
    entries = []
    for m, c in suite.profile:
        entity = "Dataset" if m == "Size" else "Column"
        entries.append(F.struct(F.lit(entity).alias("entity"), F.lit(c).alias("instance"),
                                F.lit(m).alias("name"),
                                F.col(_metric_col(m, c)).cast("double").alias("value")))
    if suite.raw_timestamp is not None:
        entries += [F.struct(F.lit("Column").alias("entity"), F.lit("timestamp").alias("instance"), F.lit(f"Type.{k}").alias("name"),
                             F.col(f"{k}_timestamp").cast("double").alias("value")) for k in KINDS]
    return (wide.select(*suite.batch_cols, F.explode(F.array(*entries)).alias("m"))
            .select(*suite.batch_cols, "m.*"))


def _constraints(suite: Suite):
    """(constraint, metric column, passes(metric) -> Column, hint) in check order."""
    is_one = lambda v: v == 1.0
    return [
        ("isComplete(timestamp)", "completeness_timestamp", is_one, "timestamp must not be null"),
        ("isComplete(event_type)", "completeness_event_type", is_one, "event_type must not be null"),
        ("isComplete(user_id)", "completeness_user_id", is_one, "user_id must not be null"),
        (f"hasCompleteness(user_id) > {USER_ID_MIN_COMPLETENESS}", "completeness_user_id",
         lambda v: v > USER_ID_MIN_COMPLETENESS, "at least 95% of rows must have a user_id"),
        ("isNonNegative(timestamp)", "compliance_non_negative_timestamp", is_one,
         "timestamp must be non-negative"),
        ("hasDataType(timestamp, Integral)", "ratio_integral_timestamp",
         lambda v: v.isNull() | (v == 1.0), "timestamp must be an integral number"),
        ("satisfies(timestamp within [2020-01-01, as_of + 5 min])", "compliance_timestamp_range", is_one,
         "timestamp must be after 2020 and not in the future"),
        ("satisfies(event_type IN (login, logout) OR content_id IS NOT NULL)", "compliance_content_required",
         is_one, "content_id must be present for non-login/logout events"),
    ]


def _constraint_ok(passes, metric: str):
    return F.coalesce(passes(F.col(metric)), F.lit(False))


def failed_constraints(suite: Suite):
    """Number of failing constraints, as a column over the wide profile row."""
    return sum(F.when(_constraint_ok(p, m), 0).otherwise(1) for _, m, p, _ in _constraints(suite))


def check_rows(wide: DataFrame, suite: Suite) -> DataFrame:
    """One row per constraint: (batch..., check, check_level, check_status, constraint,
    constraint_status, constraint_message, value).  Narrow: derived from the profile row."""
    batch = list(suite.batch_cols)
    entries = []
    for name, metric, passes, hint in _constraints(suite):
        ok = _constraint_ok(passes, metric)
        entries.append(F.struct(
            F.lit(name).alias("constraint"),
            F.when(ok, SUCCESS).otherwise(FAILURE).alias("constraint_status"),
            F.when(ok, "").otherwise(hint).alias("constraint_message"),
            F.col(metric).cast("double").alias("value")))
    status = F.when(failed_constraints(suite) > 0, ERROR).otherwise(SUCCESS)
    return (wide.select(*batch, status.alias("check_status"), F.explode(F.array(*entries)).alias("c"))
            .select(*batch, F.lit(suite.name).alias("check"), F.lit(ERROR).alias("check_level"),
                    "check_status", "c.*"))


def size_anomaly(history: DataFrame, date_col: str = "process_date", size_col: str = "size",
                 dataset_col: str | None = None,
                 max_decrease: float = SIZE_MAX_DECREASE, max_increase: float = SIZE_MAX_INCREASE) -> DataFrame:
    """Absolute change of Size against the previous run; the first run passes ("no history").

    ``history`` holds one row per run (and dataset), so this window is over run
    metadata, never over data rows.
    """
    w = Window.partitionBy(*([dataset_col] if dataset_col else [])).orderBy(date_col)
    prev = F.lag(size_col).over(w)
    delta = (F.col(size_col) - F.col("previous_size")).cast("double")
    return (history.withColumn("previous_size", prev)
            .withColumn("size_change", delta)
            .withColumn("status", F.when(F.col("previous_size").isNull(), SUCCESS)
                        .when((F.col("size_change") >= max_decrease) & (F.col("size_change") <= max_increase), SUCCESS)
                        .otherwise(FAILURE))
            .withColumn("message", F.when(F.col("previous_size").isNull(), NO_HISTORY)
                        .when(F.col("status") == SUCCESS, "").otherwise("size change outside bounds")))


def gate(wide: DataFrame, anomalies: DataFrame | None, suite: Suite) -> DataFrame:
    """Verdict per batch: passed only when every constraint and the anomaly check succeed."""
    batch = list(suite.batch_cols)
    c = wide.select(*batch, failed_constraints(suite).alias("failed_constraints"))
    if anomalies is not None:
        c = c.join(anomalies.select(*batch, F.col("status").alias("anomaly_status")), batch, "left")
    else:
        c = c.withColumn("anomaly_status", F.lit(SUCCESS))
    anomaly = F.coalesce(F.col("anomaly_status"), F.lit(SUCCESS))
    return c.select(*batch, F.col("failed_constraints").cast("long").alias("failed_constraints"),
                    anomaly.alias("anomaly_status"),
                    ((F.col("failed_constraints") == 0) & (anomaly == SUCCESS)).alias("passed"))


def run_checks(df: DataFrame, suite: Suite, history: DataFrame | None = None, materialize=None):
    """Profile + checks + anomaly + gate for ``df``.

    ``history`` is earlier (batch..., size) rows from the metrics repository;
    sizes of the current batches are appended before the anomaly window, so
    consecutive batches of a backfill are compared with each other.
    ``materialize`` (e.g. a staging write) is applied to the profile -- one
    row per batch -- so metrics, checks and verdict do not rescan the data.
    Returns (wide profile, metric rows, check rows, anomaly rows, gate rows).
    """
    wide = profile_wide(df, suite)
    if materialize is not None:
        wide = materialize(wide)
    metrics = profile_rows(wide, suite)
    checks = check_rows(wide, suite)
    date_col = suite.batch_cols[0] if suite.batch_cols else None
    anomalies = None
    if date_col:
        sizes = wide.select(date_col, "size")
        if history is not None:
            sizes = history.select(date_col, "size").join(sizes, date_col, "left_anti").unionByName(sizes)
        lo, hi = suite.size_change_bounds
        anomalies = size_anomaly(sizes, date_col, max_decrease=lo, max_increase=hi) \
            .join(wide.select(date_col), date_col, "left_semi")
    verdict = gate(wide, anomalies, suite)
    return wide, metrics, checks, anomalies, verdict
