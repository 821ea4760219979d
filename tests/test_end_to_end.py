"""A month of daily gzip drops through the bronze and silver jobs, against the SQL definition."""

import gzip
import json
import os

import duckdb

from clicklake import cli, oracle
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"


def _write_drops(folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    res = con.execute(f"""SELECT *, CAST(make_timestamp("timestamp" * 1000) AS DATE) AS d
                          FROM ({oracle.raw_cte('clean')}) r""")
    cols = [c[0] for c in res.description]
    days = {}
    for row in res.fetchall():
        rec = dict(zip(cols, row))
        day, country = rec.pop("d"), rec.pop("country")
        rec["geo_location"] = {"country": country}
        days.setdefault(day, []).append({k: v for k, v in rec.items() if v is not None})
    for day, recs in days.items():
        with gzip.open(os.path.join(folder, f"events_{day:%Y-%m-%d}.jsonl.gz"), "wt") as f:
            f.write("\n".join(json.dumps(r) for r in recs) + "\n")
    return con, sorted(days)


def test_month_of_drops_through_cli(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    src = os.path.join(tmp_dir, "drops")
    os.makedirs(src)
    con, days = _write_drops(src)
    span = f"{days[0]}..{days[-1]}"
    bronze, silver = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "silver")
    assert cli.main(["bronze", "--process-datetime", span, "--source", src, "--bronze", bronze,
                     "--metrics", os.path.join(tmp_dir, "metrics")]) == 0
    assert cli.main(["silver", "--process-datetime", span, "--bronze", bronze, "--silver", silver,
                     "--quarantine", os.path.join(tmp_dir, "quarantine")]) == 0
    got = spark.read.parquet(silver).select("action_id", "user_id", "content_id", "device_id", "country", "action",
                                            "start_time", "end_time", "duration_seconds", "event_date")
    res = con.execute(oracle.user_actions_sql("clean"))
    expect = digest([d[0] for d in res.description], res.fetchall())
    assert digest(got.columns, [tuple(r) for r in got.collect()])[0] == expect[0]
