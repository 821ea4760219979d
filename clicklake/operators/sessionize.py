"""Sessionization: valid events -> user-action intervals.

Steps (each also exposed on its own):

* ``actionable``      -- classify WATCHED / PAUSED, drop IGNORE and content-less rows
* ``numbered``        -- row numbers over the key, and over key + action
* ``islands``         -- island id = rn_all - rn_action (the row-number form)
* ``event_runs``      -- one row per run: MIN / MAX event time
* ``run_closing_event`` -- the run with its last event and the number of events at that time
* ``runs_with_next``  -- LEAD(start_time) per key
* ``user_actions``    -- end = next start else last event; md5 action id; duration

Ordering is made total so results never depend on tie order: events by (event_timestamp, event_id), runs
by (start_time, last_event_time, action, country, island).  ``event_date`` belongs to the key, so one
pass over many days equals running each day on its own.  There is one plan whatever the size of a key
(``ordered``): events are range-partitioned and sorted once, a map turns them into runs with their
successors, and only the runs of keys that a partition edge cuts are stitched afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import IGNORE, action_id, classify_action, duration_seconds
from ..session import ship_package
from . import ordered

KEY = "_key"
KEY_FIELDS = ("user_id", "content_id", "device_id", "event_date")
EVENT_ORDER = ["event_timestamp", "event_id"]
RUN_ORDER = ["start_time", "last_event_time", "action", "country", "_island"]

USER_ACTION_COLUMNS = ("action_id", "user_id", "content_id", "device_id", "country", "action",
                       "start_time", "end_time", "duration_seconds", "event_date")


def actionable(valid: DataFrame, watched=None, paused=None) -> DataFrame:
    """Valid events with an ``action``; IGNORE and rows without content are dropped."""
    return classified(valid, watched, paused).filter(F.col("action") != IGNORE)


def classified(valid: DataFrame, watched=None, paused=None) -> DataFrame:
    """Valid events of some content with their ``action``, IGNORE included."""
    kwargs = {k: v for k, v in (("watched", watched), ("paused", paused)) if v is not None}
    return valid.filter(F.col("content_id").isNotNull()).withColumn("action", classify_action("event_type", **kwargs))


def numbered(act: DataFrame) -> DataFrame:
    """rn_all over (user, content, device, day); rn_action additionally over action (both 64-bit)."""
    ship_package(act.sparkSession)
    events = act.select(*KEY_FIELDS, "event_id", "country", "action", "event_timestamp")
    return ordered.keyed_row_numbers(events, KEY_FIELDS, "action", EVENT_ORDER, "rn_all", "rn_action", ordered.CUT_ROWS)


def islands(act: DataFrame) -> DataFrame:
    """Row-number form of the island id: ``grp = rn_all - rn_action``."""
    return numbered(act).withColumn("grp", F.col("rn_all") - F.col("rn_action"))


def _cut_runs(act: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(runs of keys that lie in one piece, stitched runs of the cut keys), from one staged table."""
    from ..sinks.writers import stage

    ship_package(act.sparkSession)
    runs = stage(act.sparkSession, ordered.keyed_runs(act, KEY_FIELDS, EVENT_ORDER, ordered.CUT_ROWS), "runs")
    cut = runs.filter(ordered.EDGE).withColumn(KEY, F.struct(*KEY_FIELDS)).drop(*KEY_FIELDS)
    return runs.filter(~F.col(ordered.EDGE)), ordered.stitched_runs(cut, KEY)


def _flat(stitched: DataFrame, *columns: str) -> DataFrame:
    return stitched.select(*[F.col(f"{KEY}.{f}").alias(f) for f in KEY_FIELDS], "country", "action", "start_time", "last_event_time", *columns)


def _all_runs(act: DataFrame, *columns: str) -> DataFrame:
    inside, stitched = _cut_runs(act)
    flat = _flat(stitched, *columns)
    return inside.select(*flat.columns).unionByName(flat)


def event_runs(act: DataFrame) -> DataFrame:
    """One row per run: key, country, action, event_date, start_time, last_event_time."""
    return _all_runs(act)


def runs_with_next(act: DataFrame) -> DataFrame:
    """Runs with ``next_start_time``, the LEAD of the start per key."""
    inside, stitched = _cut_runs(act)
    sliced = ordered.range_sliced(stitched, KEY, RUN_ORDER, "cut-runs-in-order")
    flat = _flat(ordered.keyed_next_ts(sliced, KEY, RUN_ORDER, "start_time", "next_start_time"), "next_start_time")
    return inside.select(*flat.columns).unionByName(flat)


def user_actions_from_actionable(act: DataFrame) -> DataFrame:
    return (runs_with_next(act).withColumn("end_time", F.coalesce("next_start_time", "last_event_time"))
            .withColumn("action_id", action_id()).withColumn("duration_seconds", duration_seconds())
            .select(*USER_ACTION_COLUMNS))


def user_actions(valid: DataFrame, watched=None, paused=None) -> DataFrame:
    """Silver user actions from valid events (the full sessionization)."""
    return user_actions_from_actionable(actionable(valid, watched, paused))


def run_closing_event(act: DataFrame) -> DataFrame:
    """One row per run: the run, ``closing_event_id`` and ``closing_events``.

    ``closing_events`` counts the run's events at its closing time, ``closing_event_id`` is the largest of
    their ids.  Both come out of the scan that finds the runs, so there is no join and ties add no rows.
    """
    return _all_runs(act, "closing_event_id", "closing_events")
