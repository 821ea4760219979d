"""Incremental landing: each drop is landed exactly once across restarts."""

import datetime as dt
import os

from pyspark.sql import functions as F

from clicklake.streaming import landing
from tests.test_sinks_pipelines import AS_OF, _event, _write_drop


def test_stream_lands_new_drops_once(spark, tmp_dir):
    src, out, ckpt, metrics = (os.path.join(tmp_dir, x) for x in ("src", "bronze", "ckpt", "metrics"))
    d1, d2 = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    _write_drop(src, d1, [_event("1", "u", "video_start", 0), _event("2", "u", "video_pause", 5)])
    landing.start_landing(spark, src, out, ckpt, as_of=AS_OF, metrics_path=metrics).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    base2 = dt.datetime(2024, 1, 3, 8, tzinfo=dt.timezone.utc)
    _write_drop(src, d2, [_event("3", "u", "video_start", 0, base=base2)])
    landing.start_landing(spark, src, out, ckpt, as_of=AS_OF, metrics_path=metrics).awaitTermination()
    got = spark.read.parquet(out)
    assert sorted(r["event_id"] for r in got.collect()) == ["1", "2", "3"]
    assert {r["processing_date"] for r in got.select("processing_date").collect()} == {d1, d2}
    # A restart with nothing new lands nothing twice.
    landing.start_landing(spark, src, out, ckpt, as_of=AS_OF, metrics_path=metrics).awaitTermination()
    assert spark.read.parquet(out).filter(F.col("event_id") == "1").count() == 1


def test_second_file_of_a_day_adds_to_the_first(spark, tmp_dir):
    import json

    from clicklake.sources import readers

    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("src", "bronze", "ckpt"))
    day_dir = os.path.join(src, "drop_date=2024-01-02")
    os.makedirs(day_dir)

    def land(name, ids):
        with open(os.path.join(day_dir, name), "w") as f:
            f.writelines(json.dumps(_event(str(i), "u", "video_start", i)) + "\n" for i in ids)
        landing.start_landing(spark, src, out, ckpt, gate=False, drops=readers.DAILY_DIRS).awaitTermination()
        return sorted(int(r["event_id"]) for r in spark.read.parquet(out).collect())

    assert land("a.json", range(5)) == list(range(5))
    assert land("b.json", range(5, 8)) == list(range(8))
    # A replay of both files (a lost checkpoint) changes nothing.
    landing.start_landing(spark, src, out, ckpt + "-2", gate=False, drops=readers.DAILY_DIRS).awaitTermination()
    assert spark.read.parquet(out).count() == 8
