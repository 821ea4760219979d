"""Writers, merge, bronze landing and silver pipeline on hand-made rows."""

import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from clicklake import queries
from clicklake.operators import sessionize, validate
from clicklake.plans import bronze as bronze_plan
from clicklake.plans import silver as silver_plan
from clicklake.schemas import RAW_EVENT_WITH_CORRUPT, SILVER_USER_ACTIONS
from clicklake.sinks import merge, writers
from clicklake.sources import readers
from tests.helpers import bronze_df, ms, ts

AS_OF = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


def ua_rows(spark, rows):
    return spark.createDataFrame(rows, SILVER_USER_ACTIONS)


def _ua(uid, dev, action, start, end, country="IN"):
    return (None, uid, "m", dev, country, action, ts(start), ts(end), int(end - start),
            ts(start).date())


def test_dedupe_keeps_latest_end_then_smallest_country(spark):
    rows = [_ua("u", "d", "WATCHED", 0, 10, "SG"), _ua("u", "d", "WATCHED", 0, 20, "SG"),
            _ua("u", "d", "WATCHED", 0, 20, "IN")]
    out = merge.dedupe_updates(ua_rows(spark, rows)).collect()
    assert len(out) == 1 and out[0]["end_time"] == ts(20) and out[0]["country"] == "IN"


def test_merge_updates_inserts_and_keeps(spark, tmp_dir):
    path = os.path.join(tmp_dir, "silver")
    first = [_ua("u", "d", "WATCHED", 0, 10), _ua("v", "d", "PAUSED", 5, 6)]
    second = [_ua("u", "d", "WATCHED", 0, 30), _ua("w", "d", "WATCHED", 7, 8)]
    assert merge.merge_into_path(spark, ua_rows(spark, first), path) == "create"
    assert merge.merge_into_path(spark, ua_rows(spark, second), path) == "merge"
    got = {(r["user_id"], r["start_time"]): r["end_time"] for r in spark.read.parquet(path).collect()}
    assert got == {("u", ts(0)): ts(30), ("v", ts(5)): ts(6), ("w", ts(7)): ts(8)}


def test_merge_null_device_is_idempotent(spark, tmp_dir):
    path = os.path.join(tmp_dir, "silver")
    rows = [_ua("u", None, "WATCHED", 0, 10)]
    merge.merge_into_path(spark, ua_rows(spark, rows), path)
    merge.merge_into_path(spark, ua_rows(spark, rows), path)
    assert spark.read.parquet(path).count() == 1
    # Plain equality (null-unsafe MERGE) would duplicate the row.
    t = spark.read.parquet(path)
    assert merge.merge_frames(t, ua_rows(spark, rows), null_safe=False).count() == 2


def test_merge_twice_equals_once(spark, tmp_dir):
    rows = [_ua("u", "d", "WATCHED", i * 10, i * 10 + 5) for i in range(5)]
    a, b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    merge.merge_into_path(spark, ua_rows(spark, rows), a)
    merge.merge_into_path(spark, ua_rows(spark, rows), b)
    merge.merge_into_path(spark, ua_rows(spark, rows), b)
    key = lambda df: sorted((tuple(r) for r in df.collect()), key=lambda t: tuple(map(str, t)))
    assert key(spark.read.parquet(a)) == key(spark.read.parquet(b))


def test_action_domain_check(spark, tmp_dir):
    bad = ua_rows(spark, [_ua("u", "d", "SKIPPED", 0, 1)])
    with pytest.raises(ValueError):
        writers.assert_action_domain(bad)
    path = os.path.join(tmp_dir, "silver")
    with pytest.raises(Exception, match="action outside"):
        merge.merge_into_path(spark, bad, path)
    assert not os.path.exists(path) or spark.read.parquet(path).count() == 0


def test_overwrite_partitions_leaves_others(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    rows = [("1", "u", "m", "video_start", "d", 0, "IN"), ("2", "u", "m", "video_start", "d", 86400, "IN")]
    writers.create_partitioned(bronze_df(spark, rows), path)
    day2 = [f for f in os.listdir(path) if f.startswith("event_date=2024-01-02")][0]
    before = sorted(os.listdir(os.path.join(path, day2)))
    writers.overwrite_partitions(bronze_df(spark, [("3", "u", "m", "video_end", "d", 5, "IN")]), path)
    got = sorted(r["event_id"] for r in spark.read.parquet(path).collect())
    assert got == ["2", "3"]
    assert sorted(os.listdir(os.path.join(path, day2))) == before


def _write_drop(base, day, lines):
    os.makedirs(base, exist_ok=True)
    with gzip.open(os.path.join(base, f"events_{day:%Y-%m-%d}.jsonl.gz"), "wt") as f:
        for line in lines:
            f.write(line if isinstance(line, str) else json.dumps(line))
            f.write("\n")


def _event(eid, uid, t, sec, content="m", base=dt.datetime(2024, 1, 2, 8, tzinfo=dt.timezone.utc)):
    return {"event_id": eid, "user_id": uid, "content_id": content, "event_type": t, "device_id": "d",
            "timestamp": ms(sec, base), "geo_location": {"country": "IN"}}


def test_daily_file_layout_bad_line_and_gate(spark, tmp_dir):
    src, out, metrics = (os.path.join(tmp_dir, x) for x in ("src", "bronze", "metrics"))
    day = dt.date(2024, 1, 2)
    _write_drop(src, day, [_event("1", "u", "video_start", 0), _event("2", "u", "video_pause", 5), "{bad"])
    raw = readers.read_jsonl_daily(spark, src, day).select("event_id", "_corrupt_record")
    assert raw.filter(F.col("_corrupt_record").isNotNull()).collect()[0]["_corrupt_record"] == "{bad"
    assert raw.filter(F.col("event_id").isNotNull()).count() == 2
    # The bad line has no user_id / timestamp: the gate blocks the day and nothing is written.
    with pytest.raises(bronze_plan.GateFailed):
        bronze_plan.land_daily(spark, src, out, day, as_of=AS_OF, metrics_path=metrics)
    assert not os.path.exists(out)
    assert spark.read.parquet(metrics).filter(~F.col("passed")).count() > 0


def test_empty_drop_exits_cleanly(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "bronze")
    day = dt.date(2024, 1, 2)
    _write_drop(src, day, [])
    res = bronze_plan.land_daily(spark, src, out, day, as_of=AS_OF)
    assert res.status == "empty" and not os.path.exists(out)


def test_first_run_no_history_then_size_jump(spark, tmp_dir):
    src, out, metrics = (os.path.join(tmp_dir, x) for x in ("src", "bronze", "metrics"))
    d1, d2 = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    _write_drop(src, d1, [_event("1", "u", "video_start", 0)])
    res = bronze_plan.land_daily(spark, src, out, d1, as_of=AS_OF, metrics_path=metrics)
    assert res.published_days == [d1]
    # Narrow bounds instead of writing 100,001 rows: 3 more rows than last run is a jump.
    base2 = dt.datetime(2024, 1, 3, 8, tzinfo=dt.timezone.utc)
    _write_drop(src, d2, [_event(str(i), "u", "video_start", i, base=base2) for i in range(4)])
    with pytest.raises(bronze_plan.GateFailed):
        bronze_plan.land_daily(spark, src, out, d2, as_of=AS_OF, metrics_path=metrics,
                               size_change_bounds=(-2.0, 2.0))
    assert spark.read.parquet(out).count() == 1


def test_late_row_one_level_vs_two_level(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    jan1 = dt.datetime(2024, 1, 1, 8, tzinfo=dt.timezone.utc)
    _write_drop(src, d1, [_event("1", "u", "video_start", 0, base=jan1), _event("2", "u", "video_end", 9, base=jan1)])
    _write_drop(src, d2, [_event("3", "u", "video_start", 0), _event("late", "u", "video_end", 60, base=jan1)])
    one, two = os.path.join(tmp_dir, "one"), os.path.join(tmp_dir, "two")
    for day in (d1, d2):
        bronze_plan.land_daily(spark, src, one, day, layout="event_date", gate=False)
        bronze_plan.land_daily(spark, src, two, day, layout="processing_date", gate=False)
    jan1_one = sorted(r["event_id"] for r in spark.read.parquet(one).filter(F.col("event_date") == d1).collect())
    jan1_two = sorted(r["event_id"] for r in spark.read.parquet(two).filter(F.col("event_date") == d1).collect())
    assert jan1_one == ["late"]                       # whole Jan 1 replaced by the late row
    assert jan1_two == ["1", "2", "late"]             # two-level layout keeps it


def test_multi_day_batch_equals_single_days(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    days = [dt.date(2024, 1, d) for d in (2, 3)]
    for d in days:
        base = dt.datetime(d.year, d.month, d.day, 8, tzinfo=dt.timezone.utc)
        _write_drop(src, d, [_event(f"{d.day}-{i}", "u", "video_start", i, base=base) for i in range(3)])
    batch, single = os.path.join(tmp_dir, "batch"), os.path.join(tmp_dir, "single")
    bronze_plan.land_daily(spark, src, batch, days, as_of=AS_OF)
    for d in days:
        bronze_plan.land_daily(spark, src, single, d, as_of=AS_OF)
    key = lambda p: sorted((r["event_id"], r["processing_date"]) for r in spark.read.parquet(p).collect())
    assert key(batch) == key(single)


def test_silver_pipeline_rerun_is_idempotent(spark, tmp_dir):
    rows = [(str(i), "u", "m", t, d, s, "IN") for i, (t, d, s) in enumerate(
        [("video_start", "d", 0), ("video_pause", "d", 30), ("video_start", None, 40), ("login", "d", 50)])]
    rows.append(("bad", None, "m", "video_start", "d", 60, "IN"))
    bronze_path, silver, q = (os.path.join(tmp_dir, x) for x in ("b", "s", "q"))
    writers.create_partitioned(bronze_df(spark, rows), bronze_path)
    silver_plan.run(spark, bronze_path, silver, dt.date(2024, 1, 1), quarantine_path=q)
    silver_plan.run(spark, bronze_path, silver, dt.date(2024, 1, 1), quarantine_path=q)
    valid, _ = validate.split(bronze_df(spark, rows))
    expect = sorted((tuple(r) for r in sessionize.user_actions(valid).collect()), key=lambda t: tuple(map(str, t)))
    got = spark.read.parquet(silver).select(*sessionize.USER_ACTION_COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=lambda t: tuple(map(str, t))) == expect
    assert [r["event_id"] for r in spark.read.parquet(q).collect()] == ["bad"]


def test_hourly_ingestion_slice(spark, tmp_dir):
    from clicklake.sources import adapter
    rows = [("1", "u", "m", "video_start", "d", 0, "IN"), ("2", "u", "m", "video_start", "d", 3600, "SG")]
    root, out = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "manual")
    from tests.helpers import raw_df
    writers.write_hive_partitioned(adapter.hourly_layout(raw_df(spark, rows)), root, ("region", "date", "hour"))
    n, sample = bronze_plan.ingest_hourly(spark, root, out, dt.datetime(2024, 1, 1, 11))
    assert n == 1 and sample[0]["event_id"] == "2"
    got = spark.read.parquet(out).first()
    assert (got["year"], got["month"], got["day"], got["hour"]) == (2024, 1, 1, 11)
    assert got["source_file_name"].endswith(".parquet") and "date=2024-01-01/hour=11" in got["source_file_name"]


def test_gated_batch_equals_day_by_day_with_a_failing_day(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    days = [dt.date(2024, 1, d) for d in (2, 3, 4)]
    sizes = {2: 1, 3: 6, 4: 6}            # day 3 jumps by 5 (> bound 2): blocked; day 4 equals day 3
    for d in days:
        base = dt.datetime(d.year, d.month, d.day, 8, tzinfo=dt.timezone.utc)
        _write_drop(src, d, [_event(f"{d.day}-{i}", "u", "video_start", i, base=base) for i in range(sizes[d.day])])
    kw = dict(as_of=AS_OF, on_failure="skip", size_change_bounds=(-2.0, 2.0))
    batch = bronze_plan.land_daily(spark, src, os.path.join(tmp_dir, "b"), days,
                                   metrics_path=os.path.join(tmp_dir, "mb"), **kw)
    single = [bronze_plan.land_daily(spark, src, os.path.join(tmp_dir, "s"), d,
                                     metrics_path=os.path.join(tmp_dir, "ms"), **kw) for d in days]
    assert batch.blocked_days == [dt.date(2024, 1, 3)]
    assert batch.published_days == sorted(d for r in single for d in r.published_days)


def test_drops_parse_like_the_json_reader(spark, tmp_dir):
    """Objects, arrays of objects, blank and broken lines: the rows of the plain reader for any file."""
    src = os.path.join(tmp_dir, "src")
    day = dt.date(2024, 1, 2)
    pair = "[" + ", ".join(json.dumps(_event(x, "u", "video_start", 5)) for x in ("a1", "a2")) + "]"
    broken = ["{bad", "[{bad", "plain text", '"just a string"']
    _write_drop(src, day, [_event(str(i), "u", "video_start", i) for i in range(20)] + [pair, "", "   ", *broken])
    cols = ["event_id", "timestamp", "_corrupt_record"]
    a = readers.read_drops(spark, src, day).select(*cols).collect()
    b = readers.read_jsonl_daily(spark, src, day).select(*cols).collect()
    key = lambda rows: sorted(tuple(map(str, r)) for r in rows)
    assert key(a) == key(b) and len(a) == 22 + len(broken)
    assert {r["_corrupt_record"] for r in a if r["_corrupt_record"]} == set(broken)


def test_landing_keeps_bad_lines_and_new_fields(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "b")
    day = dt.date(2024, 1, 2)
    extra = {**_event("2", "u", "video_start", 1), "new_field": {"x": 1}}
    _write_drop(src, day, [_event("1", "u", "video_start", 0), extra, "{bad"])
    bronze_plan.land_daily(spark, src, out, day, gate=False)
    rows = {r.event_id: r.extra_fields for r in spark.read.parquet(out).collect()}
    assert rows == {"1": None, "2": '{"new_field":{"x":1}}'}
    assert [(r.line, r.process_date) for r in spark.read.parquet(out + "_bad_lines").collect()] == [("{bad", day)]
    # A corrected drop leaves no bad line behind, and no late day of the first run.
    _write_drop(src, day, [_event("1", "u", "video_start", 0)])
    bronze_plan.land_daily(spark, src, out, day, gate=False)
    assert spark.read.parquet(out + "_bad_lines").count() == 0
    assert [r.event_id for r in spark.read.parquet(out).collect()] == ["1"]


def test_two_level_rerun_clears_stale_days(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "b")
    day = dt.date(2024, 1, 2)
    late = _event("late", "u", "video_start", -86400 * 3)
    _write_drop(src, day, [_event("1", "u", "video_start", 0), late])
    bronze_plan.land_daily(spark, src, out, day, gate=False)
    _write_drop(src, day, [_event("1", "u", "video_start", 0)])
    bronze_plan.land_daily(spark, src, out, day, gate=False)
    assert [r.event_id for r in spark.read.parquet(out).collect()] == ["1"]


def test_silver_overwrite_with_no_rows_left(spark, tmp_dir):
    day = dt.date(2024, 1, 1)
    b1, b2, silver, q = (os.path.join(tmp_dir, x) for x in ("b1", "b2", "s", "q"))
    writers.create_partitioned(bronze_df(spark, [("1", "u", "m", "video_start", "d", 0, "IN"), (None, "u", "m", "video_start", "d", 1, "IN")]), b1)
    writers.create_partitioned(bronze_df(spark, [("1", "u", "m", "search", "d", 0, "IN")]), b2)
    silver_plan.run(spark, b1, silver, day, mode="overwrite", quarantine_path=q)
    assert spark.read.parquet(silver).count() == 1 and spark.read.parquet(q).count() == 1
    assert silver_plan.run(spark, b2, silver, day, mode="overwrite", quarantine_path=q) == "empty"
    assert spark.read.parquet(silver).count() == 0 and spark.read.parquet(q).count() == 0


def test_slices_list_only_their_directories(spark, tmp_dir):
    from clicklake.sources import adapter
    from tests.helpers import raw_df
    rows = [(str(i), "u", "m", "video_start", "d", 3600 * i, "IN") for i in range(40)]
    root, bronze = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "bronze")
    writers.write_hive_partitioned(adapter.hourly_layout(raw_df(spark, rows)), root, ("region", "date", "hour"))
    hour = readers.read_directories(spark, root, [f"{root}/region=*/date=2024-01-01/hour={{11,11}}"])
    assert len(hour.inputFiles()) == 1 and hour.count() == 1
    assert readers.read_directories(spark, root, [f"{root}/region=*/date=2030-01-01/hour=1"]).count() == 0
    writers.create_partitioned(bronze_df(spark, rows), bronze)
    one = silver_plan.read_bronze_days(spark, bronze, dt.date(2024, 1, 2))
    assert all("event_date=2024-01-02" in f for f in one.inputFiles()) and one.count() > 0


def test_stages_are_removed_and_cluster_needs_a_shared_folder(spark, tmp_dir, monkeypatch):
    from clicklake import session
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "b")
    day = dt.date(2024, 1, 2)
    _write_drop(src, day, [_event("1", "u", "video_start", 0)])
    monkeypatch.setattr(session, "checkpoint_root", lambda s: os.path.join(tmp_dir, "stage"))
    bronze_plan.land_daily(spark, src, out, day, gate=False)
    silver_plan.run(spark, out, os.path.join(tmp_dir, "silver"), day)
    left = [f for d, _, names in os.walk(os.path.join(tmp_dir, "stage")) for f in names]
    assert left == []
    monkeypatch.undo()

    class Cluster:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: None)})()
        sparkContext = type("X", (), {"master": "spark://host:7077", "getCheckpointDir": staticmethod(lambda: None)})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Cluster())


def test_named_tables(spark):
    day = lambda s: dt.date(2024, 1, s)
    rows = [("1", "u", "m", "video_start", "d", 0, "IN"), ("2", "u", "m", "video_start", "d", 86400, "IN")]
    name = f"named_{os.getpid()}"
    assert not writers.named_table_exists(spark, name)
    assert writers.create_or_overwrite_table(bronze_df(spark, rows), name) == "create"
    again = bronze_df(spark, [("3", "u", "m", "video_start", "d", 5, "IN")])
    assert writers.create_or_overwrite_table(again, name) == "overwrite"
    assert {(r.event_id, r.event_date) for r in spark.table(name).collect()} == {("3", day(1)), ("2", day(2))}
    writers.replace_named_table(again, name)
    assert [r.event_id for r in spark.table(name).collect()] == ["3"]


def test_hourly_ingestion_with_contract(spark, tmp_dir):
    from clicklake.schemas import EVENT_CONTRACT
    from clicklake.sources import adapter
    from tests.helpers import raw_df
    rows = [("1", "u", "m", "video_start", "d", 0, "IN"), ("2", "u", "m", "video_start", "d", 3600, "SG")]
    root, out = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "manual")
    writers.write_hive_partitioned(adapter.hourly_layout(raw_df(spark, rows)), root, ("region", "date", "hour"))
    n, _ = bronze_plan.ingest_hourly(spark, root, out, dt.datetime(2024, 1, 1, 11), contract=EVENT_CONTRACT)
    got = spark.read.parquet(out).first()
    assert n == 1 and got["event_id"] == "2" and got["session_id"] is None and got["hour"] == 11
    assert got["region"] == "SouthEast Asia"


def test_silver_overwrite_mode_drops_stale_runs(spark, tmp_dir):
    day = dt.date(2024, 1, 1)
    first = [("1", "u", "m", "video_start", "d", 0, "IN"), ("2", "u", "m", "video_pause", "d", 30, "IN")]
    # Late data: an earlier start moves the run boundary of the WATCHED run.
    second = first + [("0", "u", "m", "video_start", "d", -10, "IN")]
    b1, b2, silver_m, silver_o = (os.path.join(tmp_dir, x) for x in ("b1", "b2", "sm", "so"))
    writers.create_partitioned(bronze_df(spark, first), b1)
    writers.create_partitioned(bronze_df(spark, second), b2)
    for path, mode in ((silver_m, "merge"), (silver_o, "overwrite")):
        silver_plan.run(spark, b1, path, day, mode=mode)
        silver_plan.run(spark, b2, path, day, mode=mode)
    watched = lambda p: sorted(r["start_time"] for r in spark.read.parquet(p).filter(F.col("action") == "WATCHED").collect())
    assert watched(silver_m) == [ts(-10), ts(0)]      # MERGE keeps the stale run
    assert watched(silver_o) == [ts(-10)]             # overwrite replaces the day


def test_hourly_ingestion_partition_mode_keeps_other_hours(spark, tmp_dir):
    from clicklake.sources import adapter
    from tests.helpers import raw_df
    rows = [("1", "u", "m", "video_start", "d", 0, "IN"), ("2", "u", "m", "video_start", "d", 3600, "SG")]
    root, out = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "manual")
    writers.write_hive_partitioned(adapter.hourly_layout(raw_df(spark, rows)), root, ("region", "date", "hour"))
    for hour in (10, 11, 11):
        bronze_plan.ingest_hourly(spark, root, out, dt.datetime(2024, 1, 1, hour), mode="partitions")
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == ["1", "2"]
    bronze_plan.ingest_hourly(spark, root, out, dt.datetime(2024, 1, 1, 11), mode="replace")
    assert [r["event_id"] for r in spark.read.parquet(out).collect()] == ["2"]


def _fresh_silver(spark, tmp_dir, name, rows):
    bronze, silver = f"{tmp_dir}/bronze-{name}", f"{tmp_dir}/silver-{name}"
    bronze_df(spark, rows).write.partitionBy("event_date").parquet(bronze)
    silver_plan.run(spark, bronze, silver)
    return bronze, silver


def _silver_rows(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(path).select(*merge.COLUMNS).collect()), key=str)


EARLY = [("1", "u", "m", "video_start", "d", 0, "IN"), ("2", "u", "m", "video_progress", "d", 60, "IN"),
         ("3", "u", "m", "video_progress", "d", 120, "IN"), ("4", "v", "m", "video_start", None, 5, "IN"),
         ("5", "w", "m", "video_start", "d", 90_000, "IN"), ("6", "x", "m", "video_pause", "d", 7, "IN")]


@pytest.mark.parametrize("late", [
    [("9", "u", "m", "video_pause", "d", 90, "IN")],                                          # splits a run
    [("9", "v", "m", "video_pause", None, 3, "IN"), ("8", "w", "m", "video_end", "d", 90_030, "SG")],   # NULL device, another day
    [("9", "u", "m", "search", "d", 30, "IN"), ("8", None, "m", "video_pause", "d", 30, "IN")],         # ignored, invalid
])
@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_late_events_give_the_table_of_a_fresh_run(spark, tmp_dir, monkeypatch, late, broadcast):
    monkeypatch.setattr(silver_plan, "MAX_BROADCAST_KEYS", broadcast)
    bronze, silver = _fresh_silver(spark, tmp_dir, "late", EARLY)
    _, fresh = _fresh_silver(spark, tmp_dir, "fresh", EARLY + late)
    arrived = bronze_df(spark, late)
    arrived.write.mode("append").partitionBy("event_date").parquet(bronze)
    for _ in range(2):                                                                        # a replay changes nothing
        silver_plan.correct(spark, bronze, arrived, silver)
        assert _silver_rows(spark, silver) == _silver_rows(spark, fresh)


def test_removed_events_retract_their_runs(spark, tmp_dir):
    bronze, silver = _fresh_silver(spark, tmp_dir, "all", EARLY)
    gone = [EARLY[4], EARLY[1]]
    left = bronze_df(spark, [r for r in EARLY if r not in gone]).write.mode("overwrite").option("partitionOverwriteMode", "static")
    left.partitionBy("event_date").parquet(bronze)
    silver_plan.correct(spark, bronze, bronze_df(spark, gone), silver)
    _, fresh = _fresh_silver(spark, tmp_dir, "left", [r for r in EARLY if r not in gone])
    assert _silver_rows(spark, silver) == _silver_rows(spark, fresh)


def test_rows_of_untouched_keys_are_not_shuffled(spark, tmp_dir):
    _, silver = _fresh_silver(spark, tmp_dir, "plan", EARLY)
    keys = silver_plan.touched_keys(bronze_df(spark, EARLY[:1]))
    kept = silver_plan.of_keys(spark.read.parquet(silver), keys.hint("broadcast"), "left_anti")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    above_target = plan.split("FileScan")[0].split("BroadcastHashJoin")
    assert "LeftAnti" in plan and len(above_target) == 2 and "Exchange" not in above_target[0]
    assert kept.count() == 3


def test_bucketed_merge_does_not_move_the_target(spark, tmp_dir):
    name = "silver_bucketed_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    first = [("u1", None, "WATCHED", 0, 10), ("u2", "d", "WATCHED", 0, 10)]
    second = [("u1", None, "WATCHED", 0, 30), ("u3", "d", "PAUSED", 5, 6)]
    make = lambda rows: ua_rows(spark, [_ua(u, d, a, s, e) for u, d, a, s, e in rows])
    assert merge.merge_into_bucketed(spark, make(first), name, 4) == "create"
    assert merge.merge_into_bucketed(spark, make(second), name, 4) == "merge"
    path = f"{tmp_dir}/plain"
    for rows in (first, second):
        merge.merge_into_path(spark, make(rows), path)
    got = sorted((tuple(r) for r in spark.table(name).select(*merge.COLUMNS).collect()), key=str)
    assert got == _silver_rows(spark, path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merge.bucketed_merge(spark.table(name), make(second), 4)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    target = plan[plan.index("FullOuter"):plan.index("FileScan")]
    assert "Exchange" not in target and "Bucketed: true" in plan
    spark.sql(f"DROP TABLE {name}")


def test_threads_keep_their_own_staging_scopes(spark):
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    from clicklake.session import path_exists

    meet = Barrier(2)

    def job(i):
        with writers.staging_scope(spark):
            staged = writers.stage(spark, spark.range(i + 1), f"thread-{i}")
            meet.wait(60)
            if i:
                meet.wait(60)                                  # the other thread's scope has ended by now
                return staged.count()
        folder = staged.inputFiles()[0].rsplit("/", 1)[0]
        gone = not path_exists(spark, folder)
        meet.wait(60)
        return gone

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(job, range(2))) == [True, 2]


def test_landing_loses_nothing(spark, tmp_dir):
    """Nested unknown fields, values that do not fit, elements of arrays, text behind a line, repeated fields."""
    whole = ['{"event_id":"1","geo_location":{"country":"IN","asn":5,"x":{"y":[1]}},"new":null,"a.b":"q"}',
             '[{"event_id":"2","timestamp":7},{"event_id":"3","metadata":{"revenue":1,"dropout":true,"position":null}}]',
             '{"event_id":4,"metadata":null,"session_id":{"k":1}}', "[]"]
    broken = ['[{"event_id":"2"},{"event_id":"2","timestamp":"oops"}]', '{"event_id":"5","timestamp":"oops"}', '{"event_id":"6","timestamp":1.5}',
              '{"event_id":"7","geo_location":"IN"}', '{"event_id":"8","metadata":{"dropout":"yes"}}', '{"event_id":"9"} tail', '{"event_id":"9"}{"b":1}',
              '{"event_id":"9"},{"event_id":"9"}', '{"event_id":"9","event_id":"10"}', "[1]", "[null]", "null", "7", '{"timestamp":12345678901234567890}']
    lines = spark.createDataFrame([(x,) for x in whole + broken], "value string")
    rows = readers.parse_lines(lines).collect()
    assert sorted(r._corrupt_record for r in rows if r._corrupt_record) == sorted(broken)
    good = {r.event_id: r for r in rows if not r._corrupt_record}
    assert set(good) == {"1", "2", "3", "4"} and good["2"].timestamp == 7 and good["3"].metadata.revenue == 1.0 and good["3"].metadata.dropout
    assert json.loads(good["1"].extra_fields) == {"geo_location": {"asn": 5, "x": {"y": [1]}}, "new": None, "a.b": "q"}
    assert good["1"].geo_location.country == "IN" and good["4"].metadata is None and good["4"].session_id == '{"k":1}'
    assert [good[i].extra_fields for i in "234"] == [None] * 3
    drift = {r.field: (r.rows, r.type) for r in readers.field_drift(readers.parse_lines(lines)).collect()}
    assert drift == {"geo_location.asn": (1, "BIGINT"), "geo_location.x": (1, "OBJECT<y: ARRAY<BIGINT>>"), "new": (1, "VOID"), "a.b": (1, "STRING")}
    plan = readers.parse_lines(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_parse_json") + plan.count("parse_json(") <= 2 and "from_json" not in plan
    # What the plain reader flags is flagged here too.
    folder = f"{tmp_dir}/plain"
    lines.coalesce(1).write.text(folder)
    flagged = {r._corrupt_record for r in spark.read.schema(RAW_EVENT_WITH_CORRUPT).json(folder).collect() if r._corrupt_record}
    assert flagged <= set(broken)


def test_verify_after_write_reads_a_sample(spark):
    out = queries.verify_after_write(spark, "/root/testdata/sf0.001")
    assert "Limit" in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.first().sampled == 5 < out.first().row_count
