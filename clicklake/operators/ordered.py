"""Ordered per-key scans that stay parallel on hot keys and on ties: one exchange and one sort of the rows.

A window ``PARTITION BY key`` sends every row of a key to one task, so a key (or one timestamp of a key)
holding a third of the data would run in one task.  Here the rows are range-partitioned on (key, full
order), which is total, and sorted inside the partitions.  A map reads each partition once, in order, and
cuts it into *pieces* that start and end between two keys; only the first and the last key of a
partition, and a key of over ``CUT_ROWS`` rows, are cut inside.  What lies in one piece is finished where
it lies.  The few cut keys are flagged as edges; one summary row per (key, piece) gives the offset or
the open run that a piece takes over from those before it.

Flags and running counts inside a piece are NumPy prefix sums over Arrow columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICE = "_slice"
EDGE = "_edge"
# Rows of one key that a task holds before it cuts the key.
CUT_ROWS = 262_144


def range_sorted(df: DataFrame, *order: str) -> DataFrame:
    """``df`` range-partitioned on ``order`` and sorted inside the partitions."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


# ---------------------------------------------------------------------------- pieces of a sorted partition

def changes(column: pa.Array) -> np.ndarray:
    """True where a row differs from the one before it (NULL equals NULL); the first row is True."""
    n = len(column)
    if n < 2:
        return np.ones(n, bool)
    here, before = column.slice(1), column.slice(0, n - 1)
    differ = pc.fill_null(pc.not_equal(here, before), False)
    differ = pc.or_(differ, pc.not_equal(pc.is_null(here), pc.is_null(before)))
    return np.r_[True, differ.to_numpy(zero_copy_only=False)]


def _any_change(batch: pa.RecordBatch, columns: list[int]) -> np.ndarray:
    out = changes(batch.column(columns[0]))
    for c in columns[1:]:
        out = out | changes(batch.column(c))
    return out


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.concat_batches(batches) if len(batches) > 1 else batches[0]


def pieces(batches: Iterator[pa.RecordBatch], width: int, cut_rows: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int]]:
    """(rows, key starts, edge flag per row, slice number) over a sorted partition; the key is its first ``width`` columns.

    Slice numbers grow with the order of the rows, over partitions too.
    """
    columns, number = list(range(width)), TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    count, opened = 0, True  # ``opened``: the held key may have begun in an earlier piece

    def piece(rows: pa.RecordBatch, first_is_edge: bool, all_edge: bool):
        nonlocal number
        starts = _any_change(rows, columns)
        edge = (np.cumsum(starts) == 1) & first_is_edge | all_edge
        number += 1
        return rows, starts, edge, number

    for batch in batches:
        if not batch.num_rows:
            continue
        starts = _any_change(_joined([held[-1].slice(held[-1].num_rows - 1), batch]) if held else batch, columns)
        starts = starts[1:] if held else starts
        at = np.flatnonzero(starts)
        last = int(at[-1]) if len(at) else 0
        if len(at) and (held or last):                              # the held key, or one of this batch, has ended
            ended = _joined([*held, batch.slice(0, last)]) if last else _joined(held)
            yield piece(ended, opened, False)
            held, count, opened = [], 0, False
        held.append(batch.slice(last))
        count += batch.num_rows - last
        if count >= cut_rows:
            yield piece(_joined(held), True, True)
            # The next row may go on with this key: its last row stays known through ``opened``.
            held, count, opened = [], 0, True
    if held:
        yield piece(_joined(held), True, True)


def _ranks(column: pa.Array) -> np.ndarray:
    """Dense ranks of the values, NULL first."""
    encoded = column.dictionary_encode()
    order = pc.sort_indices(encoded.dictionary).to_numpy()
    rank = np.empty(len(order) + 1, np.int64)
    rank[order] = np.arange(len(order))
    rank[-1] = -1
    return rank[pc.fill_null(encoded.indices, -1).to_numpy(zero_copy_only=False)]


# ---------------------------------------------------------------------------- row numbers

def numbered_pieces(width: int, group: int, cut_rows: int):
    """Adds (rn over the key, rn over key and group, slice, edge) to sorted rows, counted inside each piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts, edge, number in pieces(batches, width, cut_rows):
            n = rows.num_rows
            key, at = np.cumsum(starts), np.arange(n)
            first = np.maximum.accumulate(np.where(starts, at, 0))
            code = _ranks(rows.column(group))
            order = np.lexsort((at, code, key))
            new = np.r_[True, (key[order][1:] != key[order][:-1]) | (code[order][1:] != code[order][:-1])]
            in_group = np.empty(n, np.int64)
            in_group[order] = at - np.maximum.accumulate(np.where(new, at, 0)) + 1
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(at - first + 1, pa.int64()), pa.array(in_group), pa.array(np.full(n, number)), pa.array(edge)],
                [*rows.schema.names, "_rn_all", "_rn_grp", SLICE, EDGE])

    return run


def keyed_row_numbers(df: DataFrame, key: tuple[str, ...], group: str, order: list[str], out_all: str, out_group: str,
                      cut_rows: int = CUT_ROWS) -> DataFrame:
    """Two 64-bit row numbers: over ``key`` and over (``key``, ``group``), rows taken in ``order`` (total)."""
    from ..sinks.writers import stage

    others = [c for c in df.columns if c not in key]
    ordered = range_sorted(df.select(*key, *others), *key, *order)
    schema = _schema(ordered) + f", _rn_all long, _rn_grp long, {SLICE} long, {EDGE} boolean"
    rows = stage(df.sparkSession, ordered.mapInArrow(numbered_pieces(len(key), len(key) + others.index(group), cut_rows), schema), "events-in-order")
    columns = [*key, *others]
    inside = rows.filter(~F.col(EDGE)).select(*columns, F.col("_rn_all").alias(out_all), F.col("_rn_grp").alias(out_group))
    cut = rows.filter(EDGE).withColumn("_key", F.struct(*key))

    def earlier(*part):
        return Window.partitionBy(*part).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)

    counts = cut.groupBy("_key", SLICE, group).agg(F.count(F.lit(1)).alias("_n"))
    zero = F.lit(0).cast("long")
    whole = counts.groupBy("_key", SLICE).agg(F.sum("_n").alias("_all"))
    whole = whole.select("_key", SLICE, F.coalesce(F.sum("_all").over(earlier("_key")), zero).alias("_before_all"))
    by_group = counts.select("_key", SLICE, group, F.coalesce(F.sum("_n").over(earlier("_key", group)), zero).alias("_before_grp"))
    joined = cut.join(whole, ["_key", SLICE]).join(by_group, ["_key", SLICE, group])
    return inside.unionByName(joined.select(*columns, (F.col("_before_all") + F.col("_rn_all")).alias(out_all),
                                            (F.col("_before_grp") + F.col("_rn_grp")).alias(out_group)))


# ---------------------------------------------------------------------------- runs of one value

RUN_FIELDS = ("start_time", "last_event_time", "closing_event_id", "closing_events", "next_start_time")


def run_pieces(width: int, cut_rows: int):
    """Sorted (key..., event_id, country, action, event_timestamp) -> one row per run and country inside each piece.

    A run is a change flag summed up: it ends where the action differs from the row before.  A key inside a
    piece also gets the start of its next run in (start, last time, action, country) order.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts, edge, number in pieces(batches, width, cut_rows):
            event_id, country, action, time = (rows.column(width + i) for i in range(4))
            n = rows.num_rows
            flags = starts | changes(action)
            run_no = np.cumsum(flags) - 1
            where = _ranks(country) + 1
            _, first, group = np.unique(run_no * (int(where.max()) + 1) + where, return_index=True, return_inverse=True)
            last = np.zeros(len(first), np.int64)
            last[group] = np.arange(n)
            micros = pc.fill_null(time.cast(pa.int64()), np.iinfo(np.int64).min).to_numpy()
            closing = np.bincount(group[micros == micros[last][group]], minlength=len(first))
            key = np.cumsum(starts)[first]
            order = np.lexsort((run_no[first], where[first], _ranks(action)[first], micros[last], micros[first], key))
            follows = np.full(len(first), -1)
            follows[order[:-1]] = np.where(key[order[1:]] == key[order[:-1]], first[order[1:]], -1)
            at_edge = edge[first]
            follows[at_edge] = -1
            following = time.take(pa.array(np.where(follows < 0, 0, follows), mask=follows < 0))
            head, tail = pa.array(first), pa.array(last)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(i).take(head) for i in range(width)), country.take(head), action.take(head), time.take(head),
                 time.take(tail), event_id.take(tail), pa.array(closing, pa.int64()), following,
                 pa.array(run_no[first], pa.int64()), pa.array(np.full(len(first), number)), pa.array(at_edge)],
                [*rows.schema.names[:width], "country", "action", *RUN_FIELDS, "_run", SLICE, EDGE])

    return run


def keyed_runs(events: DataFrame, key: tuple[str, ...], order: list[str], cut_rows: int = CUT_ROWS) -> DataFrame:
    """Run rows of ``events`` (key, event_id, country, action, event_timestamp); see ``run_pieces``."""
    ordered = range_sorted(events.select(*key, "event_id", "country", "action", "event_timestamp"), *key, *order)
    kinds = dict(ordered.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in key), "country string, action string, start_time timestamp, last_event_time timestamp",
                        f"closing_event_id {kinds['event_id']}, closing_events long, next_start_time timestamp, _run long, {SLICE} long, {EDGE} boolean"])
    return ordered.mapInArrow(run_pieces(len(key), cut_rows), schema)


def stitched_runs(cut: DataFrame, key: str) -> DataFrame:
    """Run rows of cut keys (edges) with the parts of one run put together; ``_island`` numbers the runs of a key.

    One summary row per (key, slice) tells whether its first run goes on with the last one before it.
    """
    w = Window.partitionBy(key).orderBy(SLICE)
    parts = cut.groupBy(key, SLICE).agg(F.min("_run").alias("_a"), F.max("_run").alias("_b"),
                                        F.min_by("action", "_run").alias("_head"), F.max_by("action", "_run").alias("_tail"))
    goes_on = F.coalesce((F.lag("_tail").over(w) == F.col("_head")).cast("long"), F.lit(0).cast("long"))
    parts = parts.withColumn("_goes_on", goes_on)
    before = F.sum(F.col("_b") - F.col("_a") + 1 - F.col("_goes_on")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    shift = F.coalesce(before, F.lit(0).cast("long")) - F.col("_goes_on") - F.col("_a")
    shifted = cut.join(parts.select(key, SLICE, shift.alias("_shift")), [key, SLICE]).withColumn("_island", F.col("_run") + F.col("_shift"))
    run = [key, "country", "action", "_island"]
    at_time = shifted.groupBy(*run, "last_event_time").agg(
        F.min("start_time").alias("_start"), F.max("closing_event_id").alias("_id"), F.sum("closing_events").alias("_n"))
    return at_time.groupBy(*run).agg(
        F.min("_start").alias("start_time"), F.max(F.struct("last_event_time", "_id", "_n")).alias("_close")).select(
        *run, "start_time", "_close.last_event_time", F.col("_close._id").alias("closing_event_id"), F.col("_close._n").alias("closing_events"))


def _schema(df: DataFrame) -> str:
    return ", ".join(f"{c} {t}" for c, t in df.dtypes)


# ---------------------------------------------------------------------------- successors of rows of cut keys

def range_sliced(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """``df`` staged in (key, order) ranges; ``_slice`` numbers the ranges in order."""
    from ..sinks.writers import stage

    return stage(df.sparkSession, df.repartitionByRange(key, *order).withColumn(SLICE, F.spark_partition_id()), name)


def keyed_next_ts(sliced: DataFrame, key: str, order: list[str], ts: str, out: str) -> DataFrame:
    """``LEAD(ts)`` per key in ``order``, which starts with ``ts``."""
    local = sliced.withColumn("_next_local", F.lead(ts).over(Window.partitionBy(key, SLICE).orderBy(*order)))
    # The successor of a slice's last row is the earliest ts of the key's next slice.
    firsts = sliced.groupBy(key, SLICE).agg(F.min(ts).alias("_first_ts"))
    nxt = firsts.select(key, SLICE, F.lead("_first_ts").over(Window.partitionBy(key).orderBy(SLICE)).alias("_next_slice_ts"))
    return (local.join(nxt, [key, SLICE]).withColumn(out, F.coalesce("_next_local", "_next_slice_ts"))
            .drop("_next_local", "_next_slice_ts", SLICE))
