"""Sessionization: hand-made cases, plain windows as brute force, ties and hot keys."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clicklake.operators import sessionize, validate
from clicklake.operators.ordered import range_sliced
from tests.helpers import bronze_df, ts

COLS = ["user_id", "content_id", "device_id", "country", "action", "start_time", "end_time", "duration_seconds"]


def actions(spark, rows):
    valid, _ = validate.split(bronze_df(spark, rows))
    return sessionize.user_actions(valid)


def _sort_key(row):
    return tuple((v is None, str(v)) for v in row)


def as_set(df, cols=COLS):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=_sort_key)


def test_runs_and_end_times(spark):
    rows = [
        ("1", "u", "m", "video_start", "d", 0, "IN"),
        ("2", "u", "m", "video_progress", "d", 5, "IN"),
        ("3", "u", "m", "video_pause", "d", 9, "IN"),
        ("4", "u", "m", "video_resume", "d", 12, "IN"),
        ("5", "u", "m", "video_progress", "d", 20.5, "IN"),
        ("6", "u", "m", "search", "d", 21, "IN"),          # IGNORE: dropped
    ]
    got = as_set(actions(spark, rows))
    assert got == [
        ("u", "m", "d", "IN", "PAUSED", ts(9), ts(20.5), 11),
        ("u", "m", "d", "IN", "WATCHED", ts(0), ts(9), 9),
        ("u", "m", "d", "IN", "WATCHED", ts(20.5), ts(20.5), 0),
    ]


def test_duration_floors_both_ends(spark):
    rows = [("1", "u", "m", "video_start", "d", 6.1, "IN"), ("2", "u", "m", "video_pause", "d", 7.9, "IN")]
    got = {r["action"]: r["duration_seconds"] for r in actions(spark, rows).collect()}
    assert got["WATCHED"] == 1


def test_action_id_is_md5_of_key_and_null_with_null_device(spark):
    rows = [("1", "u", "m", "video_start", None, 0, "IN"), ("2", "u", "m", "video_start", "d", 0, "IN")]
    out = {r["device_id"]: r["action_id"] for r in actions(spark, rows).collect()}
    assert out[None] is None
    import hashlib
    expect = hashlib.md5(("u" + "m" + "d" + "WATCHED" + "2024-01-01 10:00:00").encode()).hexdigest()
    assert out["d"] == expect


def test_ties_resolved_by_event_id(spark):
    # Same timestamp everywhere: order falls back to event_id (string order).
    rows = [("a", "u", "m", "video_start", "d", 0, "IN"), ("b", "u", "m", "video_pause", "d", 0, "IN"),
            ("c", "u", "m", "video_start", "d", 0, "IN")]
    got = as_set(actions(spark, rows))
    assert len(got) == 3 and {g[4] for g in got} == {"WATCHED", "PAUSED"}
    assert all(g[5] == ts(0) and g[6] == ts(0) for g in got)


def test_closing_event_is_one_row_per_run(spark):
    # Run A closes at 12 with two of its events; run B starts at 20.
    rows = [("1", "u", "m", "video_start", "d", 10, "IN"), ("2", "u", "m", "video_progress", "d", 12, "IN"),
            ("3", "u", "m", "video_end", "d", 12, "IN"), ("4", "u", "m", "video_pause", "d", 20, "IN")]
    valid, _ = validate.split(bronze_df(spark, rows))
    closing = {r.action: r for r in sessionize.run_closing_event(sessionize.actionable(valid)).collect()}
    assert (closing["WATCHED"].closing_event_id, closing["WATCHED"].closing_events) == ("3", 2)
    assert (closing["PAUSED"].closing_event_id, closing["PAUSED"].closing_events) == ("4", 1)


def test_country_splits_run_but_not_lead(spark):
    rows = [("1", "u", "m", "video_start", "d", 0, "IN"), ("2", "u", "m", "video_progress", "d", 5, "SG"),
            ("3", "u", "m", "video_progress", "d", 8, "IN"), ("4", "u", "m", "video_pause", "d", 30, "IN")]
    got = as_set(actions(spark, rows))
    # IN run 0..8 ends at the next start (5, the SG run); SG run ends at 30.
    assert ("u", "m", "d", "IN", "WATCHED", ts(0), ts(5), 5) in got
    assert ("u", "m", "d", "SG", "WATCHED", ts(5), ts(30), 25) in got


def test_event_date_splits_keys(spark):
    rows = [("1", "u", "m", "video_start", "d", 13 * 3600 + 59 * 60, "IN"),          # 23:59 on Jan 1
            ("2", "u", "m", "video_progress", "d", 14 * 3600 + 60, "IN")]            # 00:01 on Jan 2
    got = as_set(actions(spark, rows), ["event_date", "start_time", "end_time"])
    assert len(got) == 2 and all(g[1] == g[2] for g in got)


def _random_rows(seed, n=600, hot_share=0.5):
    rng = random.Random(seed)
    types = ["video_start", "video_progress", "video_end", "video_pause", "video_resume", "search"]
    rows = []
    for i in range(n):
        hot = rng.random() < hot_share
        user = "hot" if hot else f"u{rng.randint(0, 5)}"
        dev = None if rng.random() < 0.05 else f"d{rng.randint(0, 1)}"
        sec = rng.choice([rng.randint(0, 3 * 3600), rng.randint(0, 40) * 60])  # many ties at minute marks
        rows.append((f"e{i:05d}", user, f"m{rng.randint(0, 1)}", rng.choice(types), dev, sec,
                     rng.choice(["IN", "SG"])))
    return rows


def _plain_islands(act):
    key = list(sessionize.KEY_FIELDS)
    rn = [F.row_number().over(Window.partitionBy(*p).orderBy("event_timestamp", "event_id")) for p in (key, [*key, "action"])]
    return act.withColumn("rn_all", rn[0]).withColumn("rn_action", rn[1]).withColumn("grp", F.col("rn_all") - F.col("rn_action"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_row_numbers_equal_plain_windows(spark, seed):
    valid, _ = validate.split(bronze_df(spark, _random_rows(seed)))
    act = sessionize.actionable(valid)
    cols = ["event_id", "rn_all", "rn_action", "grp"]
    assert as_set(sessionize.islands(act), cols) == as_set(_plain_islands(act), cols)


def _plain_runs(act):
    """Runs, closing events and LEAD by plain windows."""
    d = _plain_islands(act)
    key, run = list(sessionize.KEY_FIELDS), [*sessionize.KEY_FIELDS, "country", "action", "grp"]
    last = Window.partitionBy(*run)
    d = d.withColumn("_close", F.max("event_timestamp").over(last))
    runs = d.groupBy(*run).agg(F.min("event_timestamp").alias("start_time"), F.max("event_timestamp").alias("last_event_time"),
                               F.max(F.when(F.col("event_timestamp") == F.col("_close"), F.col("event_id"))).alias("closing_event_id"),
                               F.count_if(F.col("event_timestamp") == F.col("_close")).alias("closing_events"))
    order = Window.partitionBy(*key).orderBy("start_time", "last_event_time", "action", "country", "grp")
    return runs.withColumn("next_start_time", F.lead("start_time").over(order))


@pytest.mark.parametrize(("cut_rows", "batch_rows", "parts"), [(262_144, 10_000, 8), (1, 3, 3), (40, 16, 1), (7, 5, 8)])
def test_scan_equals_plain_windows_in_any_cut(spark, monkeypatch, cut_rows, batch_rows, parts):
    """Batch, piece and partition edges anywhere: row numbers, runs, closing events and LEAD stay the same."""
    from clicklake.operators import ordered

    monkeypatch.setattr(ordered, "CUT_ROWS", cut_rows)
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": batch_rows, "spark.sql.shuffle.partitions": parts,
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        valid, _ = validate.split(bronze_df(spark, _random_rows(cut_rows, hot_share=0.7)))
        act = sessionize.actionable(valid)
        cols = ["event_id", "rn_all", "rn_action", "grp"]
        assert as_set(sessionize.islands(act), cols) == as_set(_plain_islands(act), cols)
        plain = _plain_runs(act)
        run = [*sessionize.KEY_FIELDS, "country", "action", "start_time", "last_event_time"]
        for step, more in ((sessionize.event_runs, []), (sessionize.runs_with_next, ["next_start_time"]),
                           (sessionize.run_closing_event, ["closing_event_id", "closing_events"])):
            assert as_set(step(act), run + more) == as_set(plain, run + more)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_one_type_whatever_the_size(spark):
    small, _ = validate.split(bronze_df(spark, _random_rows(4, n=3)))
    large, _ = validate.split(bronze_df(spark, _random_rows(4, n=900, hot_share=1.0)))
    for step in (sessionize.islands, sessionize.runs_with_next, sessionize.run_closing_event):
        assert step(sessionize.actionable(small)).schema == step(sessionize.actionable(large)).schema
    assert dict(sessionize.numbered(sessionize.actionable(small)).dtypes)["rn_all"] == "bigint"


def test_one_key_at_one_time_is_cut_into_several_tasks(spark):
    types = ["video_start", "video_pause", "video_progress"]
    rows = [(f"e{i:05d}", "u", "m", types[i * 7 % 3], "d", 60, "IN") for i in range(4000)]
    valid, _ = validate.split(bronze_df(spark, rows))
    act = sessionize.actionable(valid)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = act.select(F.struct(*sessionize.KEY_FIELDS).alias("k"), "event_id", "event_timestamp")
        cut = range_sliced(keyed, "k", sessionize.EVENT_ORDER, "test-cut").groupBy("_slice").count().collect()
        assert len(cut) > 4 and max(r["count"] for r in cut) < 1500
        cols = ["event_id", "rn_all", "rn_action", "grp"]
        assert as_set(sessionize.islands(act), cols) == as_set(_plain_islands(act), cols)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_islands_cover_each_actionable_event_once(spark):
    valid, _ = validate.split(bronze_df(spark, _random_rows(5)))
    act = sessionize.actionable(valid)
    isl = sessionize.islands(act)
    assert isl.count() == act.count() == isl.select("event_id").distinct().count()


def test_backfill_equals_day_by_day(spark):
    rows = [(f"e{i}", "u", "m", t, "d", s, "IN") for i, (t, s) in enumerate(
        [("video_start", 0), ("video_pause", 600), ("video_start", 86400 - 36000 + 5),
         ("video_progress", 86400 - 36000 + 700), ("video_pause", 2 * 86400 - 36000 + 1)])]
    bronze = bronze_df(spark, rows)
    valid, _ = validate.split(bronze)
    whole = as_set(sessionize.user_actions(valid), COLS + ["event_date"])
    days = [r[0] for r in bronze.select("event_date").distinct().collect()]
    per_day = []
    for d in days:
        v, _ = validate.split(bronze.filter(F.col("event_date") == d))
        per_day += as_set(sessionize.user_actions(v), COLS + ["event_date"])
    assert whole == sorted(per_day, key=_sort_key)


@pytest.mark.parametrize("variant", ["base", "ties"])
def test_matches_oracle_on_test_table(spark, variant):
    """Sessionization of the whole sf0.01 events table equals the SQL definition."""
    import duckdb

    from clicklake import oracle, queries
    from tools.oracle_check import digest

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet')")
    res = con.execute(oracle.user_actions_sql(variant))
    expect = digest([d[0] for d in res.description], res.fetchall())[0]
    df = sessionize.user_actions(queries.valid_events(spark, sf, variant))
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == expect
