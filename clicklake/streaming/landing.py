"""Incremental landing of daily drops with Structured Streaming.

The batch job lands the days it is told to; this driver lets the file
source discover new drops instead.  A micro-batch only names the days that
got new files; the complete drop of each of them is read again and goes
through the same landing step (stage, per-day gate, partition overwrite).
So a day's later files add to its earlier ones, the gate judges whole days,
and a replayed batch lands the same rows once more in the same place.  ``availableNow`` processes what has arrived and stops --
the scheduling model of the daily job; drop it for a continuously running
query.  Blocked days are recorded in the metrics history and skipped, since
one bad day must not stop the stream.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession

from ..plans import bronze as bronze_plan
from ..schemas import RAW_EVENT_WITH_CORRUPT
from ..session import ensure_defaults
from ..sources import readers

log = logging.getLogger(__name__)


def drop_stream(spark: SparkSession, source_base: str,
                drops: readers.DropLayout = readers.DAILY_FILES, max_files_per_trigger: int | None = None):
    """Streaming DataFrame of raw events with their ``process_date``."""
    reader = (spark.readStream.schema(RAW_EVENT_WITH_CORRUPT).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", readers.CORRUPT_RECORD))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return bronze_plan.with_process_date(reader.json(drops.glob(source_base)), drops)


def start_landing(spark: SparkSession, source_base: str, bronze_path: str, checkpoint: str, *,
                  layout: str = "processing_date", gate: bool = True, as_of: dt.datetime | None = None,
                  metrics_path: str | None = None, drops: readers.DropLayout = readers.DAILY_FILES,
                  available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the landing query; returns the StreamingQuery."""
    ensure_defaults(spark)

    def land(batch: DataFrame, epoch_id: int) -> None:
        days = sorted(r[0] for r in batch.select(bronze_plan.PROCESS_DATE).distinct().collect() if r[0])   # one row per day
        if not days:
            return
        res = bronze_plan.land_daily(spark, source_base, bronze_path, days, layout=layout, gate=gate, as_of=as_of,
                                     metrics_path=metrics_path, on_failure="skip", drops=drops)
        log.info("epoch %s: %s published=%s blocked=%s", epoch_id, res.status, res.published_days,
                 res.blocked_days)

    writer = (drop_stream(spark, source_base, drops, max_files_per_trigger).writeStream.foreachBatch(land)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 minutes")
    return writer.start()
