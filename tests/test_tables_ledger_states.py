"""Replacement by location swap, registered partitions, type gate, file ledger and mergeable metric states."""

import datetime as dt
import gzip
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from clicklake.operators import metric_states, quality, sessionize
from clicklake.plans import bronze as bronze_plan
from clicklake.plans import silver as silver_plan
from clicklake.sinks import ddl, writers
from clicklake.sources import adapter, ledger, readers
from tests.helpers import bronze_df, ms, raw_df

AS_OF = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
D1 = dt.date(2024, 1, 1)


def _name(kind):
    return f"{kind}_{uuid.uuid4().hex[:10]}"


def _broken(df):
    return df.withColumn("v", F.when(F.col("id") >= 0, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.lit(1)))


def _rows(spark, *ids):
    return spark.createDataFrame([(i, i * 10, "ab"[i % 2]) for i in ids], "id bigint, v bigint, part string")


def _ids(df):
    return sorted(r[0] for r in df.select("id").collect())


# ---------------------------------------------------------------------------- replacement

@pytest.mark.parametrize("parts", [(), ("part",)])
def test_swap_replaces_whole_table_and_failing_write_leaves_it(spark, parts):
    name = _name("swap")
    writers.swap_table(_rows(spark, 1, 2, 3), name, parts)
    with pytest.raises(Exception, match="lost"):
        writers.swap_table(_broken(_rows(spark, 7)), name, parts)
    assert _ids(spark.table(name)) == [1, 2, 3]
    writers.swap_table(_rows(spark, 4), name, parts)
    assert _ids(spark.table(name)) == [4] and spark.table(name).columns == ["id", "v", "part"]


def test_swap_keeps_the_generation_before_for_running_readers(spark):
    name = _name("swap")
    first = writers.swap_table(_rows(spark, 1), name)
    reader = spark.table(name)
    second = writers.swap_table(_rows(spark, 2), name)
    assert _ids(reader) == [1] and _ids(spark.table(name)) == [2]
    writers.swap_table(_rows(spark, 3), name)
    assert not os.path.exists(first.replace("file:", "")) and os.path.exists(second.replace("file:", ""))


def test_swap_may_read_the_table_it_replaces(spark):
    name = _name("swap")
    writers.swap_table(_rows(spark, 1, 2), name, ("part",))
    writers.swap_table(spark.table(name).filter("id = 2"), name, ("part",))
    assert _ids(spark.table(name)) == [2]


def test_swap_adds_columns_and_refuses_other_changes(spark):
    name = _name("swap")
    writers.swap_table(_rows(spark, 1), name, ("part",))
    writers.swap_table(_rows(spark, 2).withColumn("more", F.lit("x")), name, ("part",))
    assert spark.table(name).first().asDict() == {"id": 2, "v": 20, "more": "x", "part": "a"}
    for bad in (_rows(spark, 3).drop("v"), _rows(spark, 3).withColumn("more", F.lit(1))):
        with pytest.raises(ValueError):
            writers.swap_table(bad, name, ("part",))
    assert _ids(spark.table(name)) == [2]


def test_swap_takes_over_a_table_with_tracked_partitions(spark):
    name = _name("tracked")
    writers.create_table(_rows(spark, 1, 2), name, ("part",))
    writers.replace_named_table(_rows(spark, 5), name, ("part",))
    writers.replace_named_table(_rows(spark, 6), name, ("part",))
    assert _ids(spark.table(name)) == [6]


def test_replace_table_failing_write_leaves_the_old_one(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    writers.replace_table(_rows(spark, 1, 2), path, ("part",))
    with pytest.raises(Exception, match="lost"):
        writers.replace_table(_broken(_rows(spark, 7)), path, ("part",))
    assert _ids(spark.read.parquet(path)) == [1, 2] and os.listdir(tmp_dir) == ["t"]
    writers.replace_table(spark.read.parquet(path).filter("id = 2"), path)
    assert _ids(spark.read.parquet(path)) == [2] and os.listdir(tmp_dir) == ["t"]


def test_replace_table_failing_second_move_puts_the_old_one_back(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "t")
    writers.replace_table(_rows(spark, 1), path)
    real = writers.rename_path

    def fails_for_new(session, source, target):
        if "__new_" in source:
            raise OSError("gone")
        real(session, source, target)

    monkeypatch.setattr(writers, "rename_path", fails_for_new)
    with pytest.raises(OSError, match="gone"):
        writers.replace_table(_rows(spark, 2), path)
    assert _ids(spark.read.parquet(path)) == [1]


# ---------------------------------------------------------------------------- silver into the declared table

def test_silver_registers_just_the_touched_partitions(spark, tmp_dir):
    bronze, name = os.path.join(tmp_dir, "bronze"), _name("silver")
    ddl.create_silver_table(spark, name, os.path.join(tmp_dir, "silver"))
    rows = [("1", "u", "m", "video_start", "d", 0, "IN"), ("2", "u", "m", "video_pause", "d", 30, "IN"),
            ("3", "v", "m", "video_start", "d", 86400, "SG")]
    writers.create_partitioned(bronze_df(spark, rows), bronze, ("event_date",))
    parts = lambda: sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect())
    assert silver_plan.run(spark, bronze, name, D1, mode="table") == "merge"
    assert parts() == ["event_date=2024-01-01/country=IN"]
    day_one = os.path.join(tmp_dir, "silver", "event_date=2024-01-01", "country=IN")
    before = sorted(os.listdir(day_one))
    silver_plan.run(spark, bronze, name, dt.date(2024, 1, 2), mode="table")
    assert parts() == ["event_date=2024-01-01/country=IN", "event_date=2024-01-02/country=SG"]
    assert sorted(os.listdir(day_one)) == before                     # another day's files are not rewritten
    silver_plan.run(spark, bronze, name, [D1, dt.date(2024, 1, 2)], mode="table")       # a replay changes nothing
    want = sessionize.user_actions(bronze_plan_valid(spark, bronze))
    cols = ("user_id", "action", "start_time", "country")
    assert sorted(map(tuple, spark.table(name).select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def bronze_plan_valid(spark, bronze):
    from clicklake.operators import validate
    return validate.split(spark.read.parquet(bronze))[0]


# ---------------------------------------------------------------------------- type gate

def _drop(folder, day, lines):
    with gzip.open(os.path.join(folder, f"events_{day}.jsonl.gz"), "wt") as f:
        f.write("\n".join(lines) + "\n")


def _line(i, stamp):
    rest = json.dumps({"event_id": str(i), "user_id": "u", "content_id": "c", "event_type": "video_start"})
    return '{"timestamp":' + stamp + "," + rest[1:]


def test_one_fractional_timestamp_blocks_its_day(spark, tmp_dir):
    src, out, metrics = (os.path.join(tmp_dir, n) for n in ("src", "out", "metrics"))
    os.makedirs(src)
    d2 = dt.date(2024, 1, 2)
    good = [_line(i, str(ms(i))) for i in range(4)]
    _drop(src, D1, good)
    _drop(src, d2, [_line(i, str(ms(86400 + i))) for i in range(3)] + [_line(9, f"{ms(86400)}.5")])
    res = bronze_plan.land_daily(spark, src, out, [D1, d2], as_of=AS_OF, metrics_path=metrics, on_failure="skip")
    assert res.published_days == [D1] and res.blocked_days == [d2]
    seen = {(r["process_date"], r["name"]): r["value"] for r in spark.read.parquet(metrics).collect()}
    assert seen[d2, "Type.fractional"] == 1 and seen[d2, "Type.integral"] == 3 and seen[D1, "Type.fractional"] == 0
    assert readers.RAW_TIMESTAMP not in spark.read.parquet(out).columns
    raw = bronze_plan.with_process_date(readers.read_drops(spark, src, [D1, d2], raw_texts={"timestamp": "_raw_timestamp"}))
    suite = quality.Suite(as_of=AS_OF, batch_cols=("process_date",), raw_timestamp="_raw_timestamp")
    checks = quality.check_rows(quality.profile_wide(raw, suite), suite).filter(F.col("constraint").contains("DataType"))
    got = {r["process_date"]: (r["constraint_status"], r["value"]) for r in checks.collect()}
    assert got == {D1: ("Success", 1.0), d2: ("Failure", 0.75)}


def test_kinds_of_raw_texts(spark):
    texts = ["1", "-7", "1.5", "2.", "1e3", "true", '"12"', '"x"', "null", None, "{}"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["kind"]: r["n"] for r in quality.type_histogram(df, "t", "t").collect()}
    assert got == {"integral": 2, "fractional": 3, "boolean": 1, "string": 3, "unknown": 2}
    assert quality.type_histogram(df.limit(0), "t", "t").agg(F.sum("n")).first()[0] == 0


def test_raw_text_of_arrays_names_the_misfit(spark):
    lines = ['[{"timestamp":1},{"timestamp":"oops"}]', '[{"timestamp":1},{"timestamp":2}]', "broken", "{}"]
    df = spark.createDataFrame([(t,) for t in lines], "value string")
    got = [r[0] for r in readers.parse_lines(df, raw_texts={"timestamp": "t"}).select("t").collect()]
    assert sorted(map(str, got)) == sorted(map(str, ['"oops"', "1", "2", None, None]))


# ---------------------------------------------------------------------------- file ledger

def _hours(spark, root, rows, region=None):
    layout = adapter.hourly_layout(raw_df(spark, rows))
    layout = layout if region is None else layout.withColumn("region", F.lit(region))
    layout.coalesce(1).write.mode("append").partitionBy("region", "date", "hour").parquet(root)


def _events(spark, table):
    return sorted(r[0] for r in spark.read.parquet(table).select("event_id").collect())


@pytest.mark.parametrize("region", ["Middle East", "A+B/C%", None])
def test_ledger_reads_only_new_changed_and_gone_files(spark, tmp_dir, region):
    root, table, book = (os.path.join(tmp_dir, n) for n in ("raw", "table", "ledger"))
    _hours(spark, root, [("1", "u", "m", "video_start", "d", 0, "IN"), ("2", "u", "m", "video_start", "d", 3600, "IN")], region)
    first = bronze_plan.ingest_new_files(spark, root, table, book)
    assert (first.files_read, first.files_gone) == (2, 0) and _events(spark, table) == ["1", "2"]
    assert bronze_plan.ingest_new_files(spark, root, table, book).files_read == 0
    _hours(spark, root, [("3", "u", "m", "video_start", "d", 10, "IN")], region)          # one more file of the first hour
    more = bronze_plan.ingest_new_files(spark, root, table, book)
    assert more.files_read == 1 and len(more.folders) == 1 and _events(spark, table) == ["1", "2", "3"]
    # The second hour's file is written anew: same name, other rows.
    hour = [os.path.join(p, f) for p, _, fs in os.walk(root) for f in fs if "hour=11" in p and f.endswith(".parquet")][0]
    other = os.path.join(tmp_dir, "other")
    raw_df(spark, [("4", "u", "m", "video_start", "d", 3700, "IN"), ("5", "u", "m", "video_start", "d", 3701, "IN")]).coalesce(1).write.parquet(other)
    source = [os.path.join(other, f) for f in os.listdir(other) if f.endswith(".parquet")][0]
    with open(source, "rb") as a, open(hour, "wb") as b:
        b.write(a.read())
    crc = os.path.join(os.path.dirname(hour), f".{os.path.basename(hour)}.crc")
    os.remove(crc)
    changed = bronze_plan.ingest_new_files(spark, root, table, book)
    assert (changed.files_read, changed.files_gone) == (1, 0) and _events(spark, table) == ["1", "3", "4", "5"]
    os.remove(hour)
    gone = bronze_plan.ingest_new_files(spark, root, table, book)
    assert (gone.files_read, gone.files_gone) == (0, 1) and _events(spark, table) == ["1", "3"]
    assert bronze_plan.ingest_new_files(spark, root, table, book) == bronze_plan.IncrementalResult(0, 0, [])


def test_ledger_of_one_hour_leaves_the_others_alone(spark, tmp_dir):
    root, table, book = (os.path.join(tmp_dir, n) for n in ("raw", "table", "ledger"))
    _hours(spark, root, [("1", "u", "m", "video_start", "d", 0, "IN"), ("2", "u", "m", "video_start", "d", 3600, "SG")])
    one = bronze_plan.ingest_new_files(spark, root, table, book, dt.datetime(2024, 1, 1, 11))
    assert one.files_read == 1 and _events(spark, table) == ["2"]
    assert bronze_plan.ingest_new_files(spark, root, table, book, dt.datetime(2024, 1, 1, 11)).files_read == 0
    rest = bronze_plan.ingest_new_files(spark, root, table, book)
    assert rest.files_read == 1 and rest.files_gone == 0 and _events(spark, table) == ["1", "2"]


def test_ledger_is_written_after_the_data(spark, tmp_dir, monkeypatch):
    root, table, book = (os.path.join(tmp_dir, n) for n in ("raw", "table", "ledger"))
    _hours(spark, root, [("1", "u", "m", "video_start", "d", 0, "IN")])
    real = ledger.record
    monkeypatch.setattr(ledger, "record", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        bronze_plan.ingest_new_files(spark, root, table, book)
    monkeypatch.setattr(ledger, "record", real)
    assert bronze_plan.ingest_new_files(spark, root, table, book).files_read == 1
    assert _events(spark, table) == ["1"]


def test_listing_opens_no_file_and_takes_an_empty_root(spark, tmp_dir):
    root = os.path.join(tmp_dir, "raw")
    assert ledger.list_files(spark, [root]).count() == 0
    _hours(spark, root, [("1", "u", "m", "video_start", "d", 0, "IN")])
    plan = ledger.list_files(spark, [root])._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


# ---------------------------------------------------------------------------- metric states

def _dq_rows(spark, rows):
    """rows: (user, content, type, day offset)."""
    data = [(u, c, t, ms(86400 * d), D1 + dt.timedelta(days=d)) for u, c, t, d in rows]
    return spark.createDataFrame(data, "user_id string, content_id string, event_type string, timestamp bigint, process_date date")


def test_merged_states_equal_a_profile_of_the_rows(spark, tmp_dir):
    rows = [("u", "a", "video_start", 0), ("u", "b", "login", 0), ("v", "a", None, 1), (None, None, "login", 1),
            ("w", "a", "video_start", 2), ("w", None, None, 2), ("x", "c", "video_start", 2)]
    df, suite = _dq_rows(spark, rows), quality.Suite(as_of=AS_OF, batch_cols=("process_date",))
    for d in range(3):
        metric_states.save_states(df.filter(F.col("process_date") == D1 + dt.timedelta(days=d)), suite, tmp_dir)
    metric_states.save_states(df.filter(F.col("process_date") == D1), suite, tmp_dir)         # checked again: replaced
    whole = quality.Suite(as_of=AS_OF)
    want = quality.profile_wide(df, whole).first().asDict()
    got = metric_states.range_profile(spark, tmp_dir, suite).first().asDict()
    assert set(want) == set(got)
    assert {k: pytest.approx(v) for k, v in want.items()} == got
    later = F.col("process_date") > F.lit(D1)
    want = quality.profile_wide(df.filter(later), whole).first().asDict()
    got = metric_states.range_profile(spark, tmp_dir, suite, where=later).first().asDict()
    assert {k: pytest.approx(v) for k, v in want.items()} == got
    assert metric_states.range_profile(spark, tmp_dir, suite).drop("x").transform(
        lambda w: quality.check_rows(w, whole)).count() == 8


def test_states_of_values_that_are_all_null(spark, tmp_dir):
    suite = quality.Suite(as_of=AS_OF, batch_cols=("process_date",))
    metric_states.save_states(_dq_rows(spark, [(None, None, None, 0), (None, None, None, 1)]), suite, tmp_dir)
    got = metric_states.range_profile(spark, tmp_dir, suite, {"month": F.trunc("process_date", "month")}).first()
    assert got["size"] == 2 and got["completeness_user_id"] == 0.0 and got["entropy_event_type"] is None
