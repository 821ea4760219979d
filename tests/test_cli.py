"""CLI: date arguments and a full bronze + silver run through main()."""

import datetime as dt
import os

from clicklake import cli
from tests.test_sinks_pipelines import _event, _write_drop


def test_parse_days():
    assert cli.parse_days(["2024-01-03", "2024-01-01..2024-01-02", "2024-01-02T05:00:00"]) == [
        dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)]


def test_bronze_then_silver(spark, tmp_dir, monkeypatch):
    # main() stops its session at the end; keep the shared test session alive.
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    src, bronze, silver = (os.path.join(tmp_dir, x) for x in ("src", "bronze", "silver"))
    _write_drop(src, dt.date(2024, 1, 2), [_event("1", "u", "video_start", 0), _event("2", "u", "video_pause", 9)])
    assert cli.main(["bronze", "--process-datetime", "2024-01-02", "--source", src, "--bronze", bronze,
                     "--metrics", os.path.join(tmp_dir, "m")]) == 0
    assert cli.main(["silver", "--process-datetime", "2024-01-02", "--bronze", bronze, "--silver", silver]) == 0
    rows = spark.read.parquet(silver).collect()
    assert sorted(r["action"] for r in rows) == ["PAUSED", "WATCHED"]


def test_gate_failure_exit_code(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    src = os.path.join(tmp_dir, "src")
    _write_drop(src, dt.date(2024, 1, 2), [_event("1", None, "video_start", 0)])
    assert cli.main(["bronze", "--process-datetime", "2024-01-02", "--source", src,
                     "--bronze", os.path.join(tmp_dir, "b")]) == 1
