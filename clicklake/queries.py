"""Registered queries: one per operator of the inventory, each over the test tables.

Every query reads ``events`` (through the raw-event adapter) or data Spark
derives from it, so its work grows with the table.  Queries that exercise a
sink write to a fresh folder under the shared checkpoint directory and
return what they read back.  ``ORACLES`` holds the DuckDB SQL for each key
with an exact oracle; column names match one to one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .functions import columns as C
from .operators import metric_states, quality, sessionize, validate
from .plans import bronze as bronze_plan
from .plans import silver as silver_plan
from .schemas import SILVER_USER_ACTIONS
from .session import checkpoint_root, ensure_defaults, scratch_path, session_id
from .sinks import ddl, merge, writers
from .sources import adapter, readers

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

# Fixed values of the test scenarios.
AS_OF = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)       # quality checks' time reference
PROCESSING_DATE = dt.date(2024, 2, 1)                         # constant processing_date column
REDELIVERY_FROM = dt.date(2024, 1, 16)                        # first re-delivered partition
SLICE_DATE, SLICE_HOUR = dt.date(2024, 1, 15), 12              # partition slice of the hourly drops
ONE_DAY = dt.date(2024, 1, 2)                                 # event_date slice
HEAD_N = 10
METRIC_DIGITS = 10                                            # rounding of floating metrics


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


# --------------------------------------------------------------------------- inputs

RAW_FLAT = ("event_id", "user_id", "content_id", "event_type", "device_id", "timestamp", "country")


def flat(df: DataFrame, *extra: str) -> DataFrame:
    """Raw columns with the nested country lifted out (plus ``extra`` columns)."""
    return df.select(*RAW_FLAT[:-1], F.col("geo_location.country").alias("country"), *extra)


def raw(spark, sf_dir, variant="base") -> DataFrame:
    ensure_defaults(spark)
    return adapter.load_raw(spark, sf_dir, variant)


def bronze_frame(spark: SparkSession, sf_dir: str, variant: str = "base") -> DataFrame:
    """Raw events plus the bronze ``event_date`` partition column (no write)."""
    return raw(spark, sf_dir, variant).withColumn("event_date", C.event_date("timestamp"))


def valid_events(spark, sf_dir, variant="base") -> DataFrame:
    return validate.split(bronze_frame(spark, sf_dir, variant))[0]


def actionable(spark, sf_dir, variant="base") -> DataFrame:
    return sessionize.actionable(valid_events(spark, sf_dir, variant))


def drop_days(raw_df: DataFrame) -> list[dt.date]:
    """Days covered by the data (one aggregate row)."""
    lo, hi = raw_df.agg(F.min(C.event_date("timestamp")), F.max(C.event_date("timestamp"))).first()
    return [lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)] if lo else []


# Drop fixtures derived from a table are written once per session and folder:
# several queries read the same drops (they are immutable once written).
_FIXTURES: dict = {}


def _fixture_key(spark, kind, sf_dir, variant):
    return (session_id(spark), checkpoint_root(spark), kind, sf_dir, variant)


def daily_drops(spark, sf_dir, variant="base") -> tuple[str, list[dt.date]]:
    """Write the raw events as daily gzip JSON-lines drops; returns (base path, days)."""
    key = _fixture_key(spark, "daily", sf_dir, variant)
    if key not in _FIXTURES:
        r = raw(spark, sf_dir, variant)
        base = scratch_path(spark, "drops")
        adapter.write_daily_drops(r, base)
        _FIXTURES[key] = (base, drop_days(r))
    return _FIXTURES[key]


def hourly_drops(spark, sf_dir, variant="base") -> str:
    """Write the raw events as Hive-partitioned Parquet region=/date=/hour=; returns the root."""
    key = _fixture_key(spark, "hourly", sf_dir, variant)
    if key not in _FIXTURES:
        root = scratch_path(spark, "hourly")
        writers.write_hive_partitioned(adapter.hourly_layout(raw(spark, sf_dir, variant)), root,
                                       ("region", "date", "hour"))
        _FIXTURES[key] = root
    return _FIXTURES[key]


def bronze_table(spark, sf_dir, variant="base") -> str:
    path = scratch_path(spark, "bronze")
    writers.create_partitioned(bronze_frame(spark, sf_dir, variant), path, ("event_date",))
    return path


def bronze_sql(variant="base") -> str:
    return f"""SELECT event_id, user_id, content_id, event_type, device_id, "timestamp", country,
       CAST(make_timestamp("timestamp" * 1000) AS DATE) AS event_date
FROM ({O.raw_cte(variant)}) r"""


RAW_SQL = f"SELECT * FROM ({O.raw_cte('base')}) r"
HOURLY_SQL = f"""SELECT *,
  CASE country WHEN 'IN' THEN 'India' WHEN 'SG' THEN 'SouthEast Asia' WHEN 'AE' THEN 'Middle East'
       ELSE 'Unknown' END AS region,
  CAST(make_timestamp("timestamp" * 1000) AS DATE) AS date,
  CAST(hour(make_timestamp("timestamp" * 1000)) AS INTEGER) AS hour
FROM ({O.raw_cte('base')}) r"""
HOURLY_CLEAN_SQL = HOURLY_SQL.replace(O.raw_cte("base"), O.raw_cte("clean"))


# --------------------------------------------------------------------------- sources

@register("scan_jsonl_daily", f"""SELECT *, CAST(make_timestamp("timestamp" * 1000) AS DATE) AS process_date
FROM ({O.raw_cte('base')}) r""")
def scan_jsonl_daily(spark, sf_dir):
    base, days = daily_drops(spark, sf_dir)
    df = readers.read_jsonl_daily(spark, base, days, layout=readers.DAILY_DIRS)
    return flat(df.withColumn("process_date", readers.drop_date(readers.DAILY_DIRS)), "process_date")


@register("scan_jsonl_glob", RAW_SQL)
def scan_jsonl_glob(spark, sf_dir):
    base, _ = daily_drops(spark, sf_dir)
    return flat(readers.read_jsonl_glob(spark, readers.DAILY_DIRS.glob(base)))


@register("scan_parquet_partitioned", HOURLY_SQL)
def scan_parquet_partitioned(spark, sf_dir):
    root = hourly_drops(spark, sf_dir)
    return flat(readers.read_partitioned_parquet(spark, root), "region", "date", "hour")


@register("scan_schema_enforced", f"""SELECT event_id, user_id, content_id, event_type, "timestamp", device_id,
       CAST(NULL AS VARCHAR) AS session_id, CAST(NULL AS VARCHAR) AS user_agent,
       CAST(NULL AS VARCHAR) AS app_version, CAST(NULL AS VARCHAR) AS os_type
FROM ({O.raw_cte('base')}) r""")
def scan_schema_enforced(spark, sf_dir):
    base, _ = daily_drops(spark, sf_dir)
    df = readers.read_with_contract(spark, readers.DAILY_DIRS.glob(base), "json")
    return df.select("event_id", "user_id", "content_id", "event_type", "timestamp", "device_id", "session_id",
                     "technical_context.user_agent", "technical_context.app_version", "technical_context.os_type")


@register("scan_table", bronze_sql("base"))
def scan_table(spark, sf_dir):
    name = "bronze_events_" + scratch_path(spark, "t").rsplit("/", 1)[-1][:12]
    writers.save_as_table(bronze_frame(spark, sf_dir), name, scratch_path(spark, "tables"), ("event_date",))
    return flat(readers.read_table(spark, name), "event_date")


# --------------------------------------------------------------------------- sinks

@register("sink_create_partitioned", bronze_sql("base"))
def sink_create_partitioned(spark, sf_dir):
    return flat(spark.read.parquet(bronze_table(spark, sf_dir)), "event_date")


@register("sink_create_two_level", f"SELECT *, event_date AS processing_date FROM ({bronze_sql('base')}) b")
def sink_create_two_level(spark, sf_dir):
    path = scratch_path(spark, "bronze2")
    df = bronze_frame(spark, sf_dir).withColumn("processing_date", F.col("event_date"))
    writers.create_partitioned(df, path, ("processing_date", "event_date"))
    return flat(spark.read.parquet(path), "event_date", "processing_date")


@register("sink_overwrite_partitions", f"""SELECT * FROM ({bronze_sql('base')}) b WHERE event_date < DATE '{REDELIVERY_FROM}'
UNION ALL SELECT * FROM ({bronze_sql('clean')}) c WHERE event_date >= DATE '{REDELIVERY_FROM}'""")
def sink_overwrite_partitions(spark, sf_dir):
    """Re-delivery of the days from REDELIVERY_FROM on: only those partitions are replaced."""
    path = bronze_table(spark, sf_dir, "base")
    redelivered = bronze_frame(spark, sf_dir, "clean").filter(F.col("event_date") >= F.lit(REDELIVERY_FROM))
    writers.overwrite_partitions(redelivered, path, ("event_date",))
    return flat(spark.read.parquet(path), "event_date")


@register("sink_replace_table", bronze_sql("clean"))
def sink_replace_table(spark, sf_dir):
    path = bronze_table(spark, sf_dir, "base")
    writers.replace_table(bronze_frame(spark, sf_dir, "clean"), path)
    return flat(spark.read.parquet(path), "event_date")


_UA_COLS = ", ".join(f.name for f in SILVER_USER_ACTIONS.fields)


def _merge_sql() -> str:
    keys = ("user_id", "content_id", "device_id", "action", "start_time")
    on = " AND ".join(f"t.{k} IS NOT DISTINCT FROM s.{k}" for k in keys)
    cols = []
    for f in SILVER_USER_ACTIONS.fields:
        c = f.name
        if c in ("end_time", "duration_seconds"):
            cols.append(f"CASE WHEN s._in THEN s.{c} ELSE t.{c} END AS {c}")
        else:
            cols.append(f"CASE WHEN t._in THEN t.{c} ELSE s.{c} END AS {c}")
    return f"""SELECT {', '.join(cols)}
FROM (SELECT *, TRUE AS _in FROM ({O.user_actions_sql('base')}) x) t
FULL OUTER JOIN (SELECT *, TRUE AS _in FROM ({O.user_actions_sql('clean')}) y) s ON {on}"""


@register("merge_user_actions", _merge_sql())
def merge_user_actions(spark, sf_dir):
    """Silver built from the base delivery, then the corrected (clean) delivery merged in."""
    path = scratch_path(spark, "silver")
    for variant in ("base", "clean"):
        merge.merge_into_path(spark, sessionize.user_actions(valid_events(spark, sf_dir, variant)), path)
    return spark.read.parquet(path).select(*[f.name for f in SILVER_USER_ACTIONS.fields])


@register("silver_registered", f"""SELECT m.*, 'event_date=' || CAST(event_date AS VARCHAR) || '/country=' || country AS folder
FROM ({_merge_sql()}) m""")
def silver_registered(spark, sf_dir):
    """The silver job feeding the declared catalog table, twice; every row with the registered partition that holds it."""
    name = _table_name(spark, "silver")
    ddl.create_silver_table(spark, name, scratch_path(spark, "silver"))
    for variant in ("base", "clean"):
        silver_plan.run(spark, bronze_table(spark, sf_dir, variant), name, mode="table")
    folders = spark.sql(f"SHOW PARTITIONS {name}").select(F.col("partition").alias("folder"))
    rows = spark.table(name).select(*[f.name for f in SILVER_USER_ACTIONS.fields])
    here = F.concat(F.lit("event_date="), F.col("event_date").cast("string"), F.lit("/country="), F.col("country"))
    return rows.withColumn("folder", here).join(folders, "folder")


@register("sink_swap_table", bronze_sql("clean"))
def sink_swap_table(spark, sf_dir):
    """A partitioned named table replaced by a swap of its location."""
    name = _table_name(spark, "swapped")
    for variant in ("base", "ties", "clean"):
        writers.swap_table(flat(bronze_frame(spark, sf_dir, variant), "event_date"), name, ("event_date",))
    return spark.table(name)


@register("merge_bucketed", _merge_sql())
def merge_bucketed(spark, sf_dir):
    """The same merge on a table bucketed on the merge key: only the updates are exchanged."""
    name = _table_name(spark, "silver")
    for variant in ("base", "clean"):
        merge.merge_into_bucketed(spark, sessionize.user_actions(valid_events(spark, sf_dir, variant)), name, buckets=8)
    return spark.table(name).select(*[f.name for f in SILVER_USER_ACTIONS.fields])


QUARANTINE_COLS = ("event_id", "user_id", "content_id", "event_type", "event_date", "device_id", "country",
                   "event_timestamp", "validation_errors")
QUARANTINE_SQL = f"""SELECT {', '.join(QUARANTINE_COLS)} FROM ({O.validated_cte('base')}) v
WHERE len(validation_errors) > 0"""


@register("sink_quarantine", QUARANTINE_SQL)
def sink_quarantine(spark, sf_dir):
    path = scratch_path(spark, "quarantine")
    _, quarantined = validate.split(bronze_frame(spark, sf_dir))
    writers.overwrite_partitions(quarantined, path, ("event_date",))
    return spark.read.parquet(path).select(*QUARANTINE_COLS)


@register("check_action_domain", f"""SELECT count(*) AS rows_checked,
  count(*) FILTER (WHERE action NOT IN ('WATCHED', 'PAUSED')) AS violations
FROM (SELECT {O.ACTION_CASE} AS action FROM ({O.valid_cte('base')}) v WHERE content_id IS NOT NULL) u""")
def check_action_domain(spark, sf_dir):
    """The domain check over classified events before IGNORE is dropped: there are violations to see."""
    rows = sessionize.classified(valid_events(spark, sf_dir))
    return writers.action_domain_counts(rows)


@register("sink_hive_partitioned", f"""SELECT region, date, hour, count(*) AS rows_written
FROM ({HOURLY_SQL}) h GROUP BY region, date, hour""")
def sink_hive_partitioned(spark, sf_dir):
    df = readers.read_partitioned_parquet(spark, hourly_drops(spark, sf_dir))
    return df.groupBy("region", "date", "hour").agg(F.count(F.lit(1)).alias("rows_written"))


@register("verify_after_write", f"SELECT count(*) AS row_count, least(count(*), 5) AS sampled FROM ({RAW_SQL}) r")
def verify_after_write(spark, sf_dir):
    """The written table read back: its rows and how many of the sample came."""
    table = spark.read.parquet(bronze_table(spark, sf_dir))
    sample = table.limit(5).agg(F.count(F.lit(1)).alias("sampled"))
    return table.agg(F.count(F.lit(1)).alias("row_count")).crossJoin(sample)


# --------------------------------------------------------------------------- projections

BASE_COLS = ("event_id", "user_id", "content_id", "event_type", "event_date", "device_id", "timestamp", "country",
             "event_timestamp")


@register("project_nested", f"SELECT * FROM ({O.base_cte('base')}) b")
def project_nested(spark, sf_dir):
    return validate.base_events(bronze_frame(spark, sf_dir)).select(*BASE_COLS)


@register("derive_event_timestamp", f"""SELECT event_id, "timestamp", make_timestamp("timestamp" * 1000) AS event_timestamp
FROM ({RAW_SQL}) r""")
def derive_event_timestamp(spark, sf_dir):
    return raw(spark, sf_dir).select("event_id", "timestamp", C.event_timestamp("timestamp").alias("event_timestamp"))


@register("bronze_event_date", f"""SELECT event_id, "timestamp", CAST(make_timestamp("timestamp" * 1000) AS DATE) AS event_date
FROM ({RAW_SQL}) r""")
def bronze_event_date(spark, sf_dir):
    return raw(spark, sf_dir).select("event_id", "timestamp", C.event_date("timestamp").alias("event_date"))


@register("bronze_processing_date", f"""SELECT event_id, event_date, DATE '{PROCESSING_DATE}' AS processing_date
FROM ({bronze_sql('base')}) b""")
def bronze_processing_date(spark, sf_dir):
    return bronze_frame(spark, sf_dir).select(
        "event_id", "event_date", F.lit(PROCESSING_DATE).cast("date").alias("processing_date"))


@register("derive_ymd", f"""SELECT event_id, region, hour, CAST(year(date) AS INTEGER) AS year,
       CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day FROM ({HOURLY_SQL}) h""")
def derive_ymd(spark, sf_dir):
    df = readers.read_partitioned_parquet(spark, hourly_drops(spark, sf_dir))
    return df.select("event_id", "region", "hour", *C.year_month_day("date"))


# The path's parts as columns; directory names are URL-encoded.
PATH_COLS = ("path_region", "path_date", "path_hour")


def _path_parts(path: str) -> list:
    def part(name):
        return F.url_decode(F.regexp_extract(path, f"/{name}=([^/]*)/", 1))
    return [part("region").alias("path_region"), part("date").cast("date").alias("path_date"), part("hour").cast("int").alias("path_hour")]


_PATHS_SQL = "region AS path_region, date AS path_date, hour AS path_hour"


@register("manual_bronze", f"""SELECT event_id, user_id, event_type, "timestamp", country, region, hour, {_PATHS_SQL}, TRUE AS ingested
FROM ({HOURLY_SQL}) h""")
def manual_bronze(spark, sf_dir):
    """Hourly ingestion: the lineage path's region, date and hour beside the columns, and the wall clock's presence."""
    out = scratch_path(spark, "manual")
    bronze_plan.ingest_hourly(spark, hourly_drops(spark, sf_dir), out)
    df = spark.read.parquet(out).withColumn("ingested", F.col("ingestion_timestamp").isNotNull())
    return flat(df, "region", "hour", "ingested", "source_file_name").select(
        "event_id", "user_id", "event_type", "timestamp", "country", "region", "hour", *_path_parts("source_file_name"), "ingested")


@register("source_file_lineage", f"SELECT event_id, {_PATHS_SQL} FROM ({HOURLY_SQL}) h")
def source_file_lineage(spark, sf_dir):
    df = readers.with_source_file(readers.read_partitioned_parquet(spark, hourly_drops(spark, sf_dir)))
    return df.select("event_id", *_path_parts("source_file_name"))


@register("classify_action", f"SELECT event_id, event_type, {O.ACTION_CASE} AS action FROM ({RAW_SQL}) r")
def classify_action(spark, sf_dir):
    return raw(spark, sf_dir).select("event_id", "event_type", C.classify_action().alias("action"))


@register("action_id_hash", f"""SELECT user_id, content_id, device_id, action, start_time,
  md5(user_id || content_id || device_id || action || CAST(start_time AS VARCHAR)) AS action_id
FROM ({O.runs_sql('base')}) r""")
def action_id_hash(spark, sf_dir):
    runs = sessionize.event_runs(actionable(spark, sf_dir))
    return runs.select("user_id", "content_id", "device_id", "action", "start_time", C.action_id().alias("action_id"))


@register("duration_seconds", f"""SELECT user_id, content_id, device_id, action, start_time, end_time, duration_seconds
FROM ({O.user_actions_sql('base')}) u""")
def duration_seconds(spark, sf_dir):
    return sessionize.user_actions(valid_events(spark, sf_dir)).select(
        "user_id", "content_id", "device_id", "action", "start_time", "end_time", "duration_seconds")


# --------------------------------------------------------------------------- filters

@register("filter_date_hour", f"""SELECT event_id, user_id, event_type, region, date, hour FROM ({HOURLY_SQL}) h
WHERE date = DATE '{SLICE_DATE}' AND hour = {SLICE_HOUR}""")
def filter_date_hour(spark, sf_dir):
    """A partition slice of the hourly drops (pruned at listing time)."""
    df = readers.read_partitioned_parquet(spark, hourly_drops(spark, sf_dir))
    return (df.where((F.col("date") == F.lit(SLICE_DATE)) & (F.col("hour") == SLICE_HOUR))
            .select("event_id", "user_id", "event_type", "region", "date", "hour"))


@register("filter_event_date", f"SELECT * FROM ({bronze_sql('base')}) b WHERE event_date = DATE '{ONE_DAY}'")
def filter_event_date(spark, sf_dir):
    """One day of the bronze table (partition pruning under ``to_date``)."""
    df = spark.read.parquet(bronze_table(spark, sf_dir))
    return flat(df.filter(F.to_date("event_date") == F.lit(ONE_DAY)), "event_date")


@register("filter_null_ids", f"""SELECT event_id, user_id, event_id IS NULL AS event_id_is_null,
  user_id IS NULL AS user_id_is_null, event_timestamp IS NULL AS event_timestamp_is_null
FROM ({O.base_cte('base')}) b""")
def filter_null_ids(spark, sf_dir):
    b = validate.base_events(bronze_frame(spark, sf_dir))
    return b.select("event_id", "user_id", F.col("event_id").isNull().alias("event_id_is_null"),
                    F.col("user_id").isNull().alias("user_id_is_null"),
                    F.col("event_timestamp").isNull().alias("event_timestamp_is_null"))


@register("filter_country_code", f"""SELECT event_id, country, (country IS NULL OR length(country) <> 2) AS invalid_country
FROM ({RAW_SQL}) r""")
def filter_country_code(spark, sf_dir):
    return flat(raw(spark, sf_dir)).select("event_id", "country", C.invalid_country("country").alias("invalid_country"))


@register("filter_ts_range", f"""SELECT event_id, "timestamp",
  "timestamp" BETWEEN {C.START_OF_2020_MS} AND {C.as_of_ms(AS_OF) + C.FUTURE_SKEW_MS} AS in_range
FROM ({RAW_SQL}) r""")
def filter_ts_range(spark, sf_dir):
    return raw(spark, sf_dir).select("event_id", "timestamp", C.timestamp_in_range(AS_OF).alias("in_range"))


@register("filter_conditional_content", f"""SELECT event_id, event_type, content_id,
  (event_type IN ('login', 'logout') OR content_id IS NOT NULL) AS content_ok
FROM ({RAW_SQL}) r""")
def filter_conditional_content(spark, sf_dir):
    return raw(spark, sf_dir).select("event_id", "event_type", "content_id", C.content_required().alias("content_ok"))


# --------------------------------------------------------------------------- validation

@register("validation_errors", f"SELECT event_id, user_id, country, validation_errors FROM ({O.validated_cte('base')}) v")
def validation_errors(spark, sf_dir):
    v = validate.with_validation_errors(validate.base_events(bronze_frame(spark, sf_dir)))
    return v.select("event_id", "user_id", "country", validate.ERRORS)


@register("valid_events", O.valid_cte("base"))
def valid_events_q(spark, sf_dir):
    return valid_events(spark, sf_dir).select(*BASE_COLS)


@register("quarantine_events", QUARANTINE_SQL)
def quarantine_events(spark, sf_dir):
    return validate.split(bronze_frame(spark, sf_dir))[1].select(*QUARANTINE_COLS)


# --------------------------------------------------------------------------- joins, aggregates

RUN_COLS = ("user_id", "content_id", "device_id", "country", "action", "event_date", "start_time", "last_event_time")


@register("run_closing_event", O.closing_sql("ties"))
def run_closing_event(spark, sf_dir):
    """One row per run, over hour-stamped events: many events share the closing time."""
    return sessionize.run_closing_event(actionable(spark, sf_dir, "ties")).select(*RUN_COLS, "closing_event_id", "closing_events")


@register("event_runs", f"SELECT {', '.join(RUN_COLS)} FROM ({O.runs_sql('base')}) r")
def event_runs(spark, sf_dir):
    return sessionize.event_runs(actionable(spark, sf_dir)).select(*RUN_COLS)


@register("row_count", f"SELECT count(*) AS row_count FROM ({RAW_SQL}) r")
def row_count(spark, sf_dir):
    return raw(spark, sf_dir).agg(F.count(F.lit(1)).alias("row_count"))


@register("distinct_event_types", f"SELECT DISTINCT event_type FROM ({RAW_SQL}) r")
def distinct_event_types(spark, sf_dir):
    """DISTINCT over every daily drop (glob read)."""
    base, _ = daily_drops(spark, sf_dir)
    return readers.read_jsonl_glob(spark, readers.DAILY_DIRS.glob(base)).select("event_type").distinct()


@register("json_map_total", """SELECT event_type, count(*) AS events,
  sum(list_sum(map_values(CAST(CAST(props AS JSON) AS MAP(VARCHAR, DOUBLE))))) AS props_total
FROM events GROUP BY event_type""")
def json_map_total(spark, sf_dir):
    ensure_defaults(spark)
    ev = adapter.load_events(spark, sf_dir)
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"),
                                        F.sum(C.json_map_total("props")).alias("props_total"))


# --------------------------------------------------------------------------- windows

@register("rn_all", f"SELECT event_id, rn_all FROM ({O.positions_sql('base')}) n")
def rn_all(spark, sf_dir):
    return sessionize.numbered(actionable(spark, sf_dir)).select("event_id", "rn_all")


@register("rn_action", f"SELECT event_id, action, rn_action FROM ({O.positions_sql('base')}) n")
def rn_action(spark, sf_dir):
    return sessionize.numbered(actionable(spark, sf_dir)).select("event_id", "action", "rn_action")


@register("islands", f"SELECT event_id, action, rn_all - rn_action AS grp FROM ({O.positions_sql('base')}) n")
def islands(spark, sf_dir):
    return sessionize.islands(actionable(spark, sf_dir)).select("event_id", "action", "grp")


@register("next_start", f"SELECT {', '.join(RUN_COLS)}, next_start_time FROM ({O.followed_sql('base')}) r")
def next_start(spark, sf_dir):
    return sessionize.runs_with_next(actionable(spark, sf_dir)).select(*RUN_COLS, "next_start_time")


@register("user_actions", O.user_actions_sql("base"))
def user_actions(spark, sf_dir):
    return sessionize.user_actions(valid_events(spark, sf_dir))


# --------------------------------------------------------------------------- limits, scalar functions

@register("head_events", f"SELECT * FROM ({RAW_SQL}) r ORDER BY event_id NULLS LAST LIMIT {HEAD_N}")
def head_events(spark, sf_dir):
    return flat(raw(spark, sf_dir)).orderBy(F.asc_nulls_last("event_id")).limit(HEAD_N)


@register("scalar_functions", f"""SELECT event_id, CAST(length(country) AS INTEGER) AS country_length,
  CAST(year(event_date) AS INTEGER) AS year, CAST(month(event_date) AS INTEGER) AS month,
  CAST(day(event_date) AS INTEGER) AS day,
  md5(user_id || content_id) AS pair_hash, coalesce(device_id, 'unknown') AS device_or_unknown,
  CAST(event_timestamp AS VARCHAR) AS ts_text, CAST(floor(epoch(event_timestamp)) AS BIGINT) AS epoch_seconds
FROM ({O.base_cte('base')}) b""")
def scalar_functions(spark, sf_dir):
    b = validate.base_events(bronze_frame(spark, sf_dir))
    return b.select("event_id", F.length("country").alias("country_length"), *C.year_month_day("event_date"),
                    F.md5(F.concat("user_id", "content_id")).alias("pair_hash"),
                    F.coalesce("device_id", F.lit("unknown")).alias("device_or_unknown"),
                    F.col("event_timestamp").cast("string").alias("ts_text"),
                    F.col("event_timestamp").cast("long").alias("epoch_seconds"))


# --------------------------------------------------------------------------- data quality

def _suite(**settings) -> quality.Suite:
    return quality.Suite(as_of=AS_OF, batch_cols=("process_date",), **settings)


def _dq_input(spark, sf_dir, variant="base") -> DataFrame:
    """Bronze rows batched by process date (the drop day = the event day here)."""
    return raw(spark, sf_dir, variant).withColumn("process_date", C.event_date("timestamp"))


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.round(c, METRIC_DIGITS).alias(c) if c in cols else F.col(c) for c in df.columns])


def _dq_wide_sql(variant="base") -> str:
    hi = C.as_of_ms(AS_OF) + C.FUTURE_SKEW_MS
    return f"""WITH b AS (SELECT *, CAST(make_timestamp("timestamp" * 1000) AS DATE) AS process_date
                  FROM ({O.raw_cte(variant)}) r),
w AS (SELECT process_date, count(*) AS size,
  CAST(count(user_id) AS DOUBLE) / count(*) AS completeness_user_id,
  CAST(count(content_id) AS DOUBLE) / count(*) AS completeness_content_id,
  CAST(count(event_type) AS DOUBLE) / count(*) AS completeness_event_type,
  CAST(count("timestamp") AS DOUBLE) / count(*) AS completeness_timestamp,
  CAST(sum("timestamp") AS DOUBLE) / count("timestamp") AS mean_timestamp,
  CAST(sum(CASE WHEN coalesce("timestamp", 0) >= 0 THEN 1 ELSE 0 END) AS DOUBLE) / count(*)
    AS compliance_non_negative_timestamp,
  CAST(sum(CASE WHEN regexp_full_match(CAST("timestamp" AS VARCHAR), '{quality.INTEGRAL_PATTERN}') THEN 1 ELSE 0 END)
    AS DOUBLE) / count("timestamp") AS ratio_integral_timestamp,
  CAST(sum(CASE WHEN "timestamp" BETWEEN {C.START_OF_2020_MS} AND {hi} THEN 1 ELSE 0 END) AS DOUBLE) / count(*)
    AS compliance_timestamp_range,
  CAST(sum(CASE WHEN event_type IN ('login', 'logout') OR content_id IS NOT NULL THEN 1 ELSE 0 END) AS DOUBLE)
    / count(*) AS compliance_content_required
  FROM b GROUP BY process_date),
f AS (SELECT process_date, col, val, count(*) AS n FROM (
        SELECT process_date, 'user_id' AS col, user_id AS val FROM b
        UNION ALL SELECT process_date, 'content_id', content_id FROM b
        UNION ALL SELECT process_date, 'event_type', event_type FROM b) x
      WHERE val IS NOT NULL GROUP BY process_date, col, val),
fm AS (SELECT process_date, col,
         CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS DOUBLE) / sum(n) AS uniqueness,
         CAST(count(*) AS DOUBLE) / sum(n) AS distinctness,
         ln(sum(n)) - sum(n * ln(n)) / sum(n) AS entropy
       FROM f GROUP BY process_date, col),
wide AS (SELECT w.*,
  (SELECT uniqueness FROM fm WHERE fm.process_date = w.process_date AND col = 'user_id') AS uniqueness_user_id,
  (SELECT distinctness FROM fm WHERE fm.process_date = w.process_date AND col = 'content_id') AS distinctness_content_id,
  (SELECT distinctness FROM fm WHERE fm.process_date = w.process_date AND col = 'event_type') AS distinctness_event_type,
  (SELECT entropy FROM fm WHERE fm.process_date = w.process_date AND col = 'event_type') AS entropy_event_type
  FROM w)"""


def _r(expr: str) -> str:
    return f"round({expr}, {METRIC_DIGITS})"


_PROFILE_SQL = " UNION ALL ".join(
    f"SELECT process_date, '{'Dataset' if m == 'Size' else 'Column'}' AS entity, '{c}' AS instance, "
    f"'{m}' AS name, {_r(f'CAST({quality._metric_col(m, c)} AS DOUBLE)')} AS value FROM wide"
    for m, c in quality.PROFILE)


@register("dq_profile", _dq_wide_sql() + "\n" + _PROFILE_SQL)
def dq_profile(spark, sf_dir):
    s = _suite()
    return _rounded(quality.profile_rows(quality.profile_wide(_dq_input(spark, sf_dir), s), s), "value")


def _wide_query(key: str, cols: tuple[str, ...]):
    @register(key, _dq_wide_sql() + f"\nSELECT process_date, {', '.join(_r(c) + ' AS ' + c for c in cols)} FROM wide")
    def q(spark, sf_dir):
        w = quality.profile_wide(_dq_input(spark, sf_dir), _suite())
        return _rounded(w.select("process_date", *cols), *cols)
    q.__name__ = key
    return q


dq_completeness = _wide_query("dq_completeness", ("completeness_user_id", "completeness_content_id",
                                                  "completeness_event_type", "completeness_timestamp"))
dq_uniqueness = _wide_query("dq_uniqueness", ("uniqueness_user_id",))
dq_distinctness = _wide_query("dq_distinctness", ("distinctness_content_id", "distinctness_event_type"))
dq_entropy = _wide_query("dq_entropy", ("entropy_event_type",))
dq_mean = _wide_query("dq_mean", ("mean_timestamp",))


@register("dq_type_ratio", f"""SELECT process_date, {_r("CAST(count(*) FILTER (WHERE regexp_full_match(written, '" + quality.INTEGRAL_PATTERN + "')) AS DOUBLE) / count(written)")} AS ratio_integral
FROM (SELECT CAST(make_timestamp("timestamp" * 1000) AS DATE) AS process_date,
             CASE WHEN "timestamp" % 37 = 0 THEN "timestamp" || '.5' ELSE CAST("timestamp" AS VARCHAR) END AS written
      FROM ({RAW_SQL}) r) w GROUP BY process_date""")
def dq_type_ratio(spark, sf_dir):
    """Share of timestamps written as whole numbers, on the text before any cast; every 37th is written as a fraction."""
    ms = F.col("timestamp")
    written = F.when(ms % 37 == 0, F.concat(ms.cast("string"), F.lit(".5"))).otherwise(ms.cast("string"))
    texts = _dq_input(spark, sf_dir).select("process_date", written.alias("written"))
    return _rounded(quality.integral_ratio(texts, "written", ("process_date",)), "ratio_integral")


def _written_timestamp() -> F.Column:
    """JSON text of the timestamp as a faulty producer writes it: as a fraction, a text, a boolean, or not at all."""
    ms, as_text = F.col("timestamp"), F.col("timestamp").cast("string")
    return (F.when(ms % 37 == 0, F.concat(as_text, F.lit(".5"))).when(ms % 41 == 0, F.concat(F.lit('"'), as_text, F.lit('"')))
            .when(ms % 43 == 0, F.lit("true")).when(ms % 47 == 0, F.lit("null")).otherwise(as_text))


_KIND_SQL = """CASE WHEN "timestamp" % 37 = 0 THEN 'fractional' WHEN "timestamp" % 41 = 0 THEN 'string'
  WHEN "timestamp" % 43 = 0 THEN 'boolean' WHEN "timestamp" % 47 = 0 THEN 'unknown' ELSE 'integral' END"""


@register("dq_type_histogram", f"""WITH r AS (SELECT CAST(make_timestamp("timestamp" * 1000) AS DATE) AS process_date, {_KIND_SQL} AS kind
  FROM ({O.raw_cte('clean')}) x),
d AS (SELECT DISTINCT process_date FROM r), k AS (SELECT unnest([{', '.join(repr(k) for k in quality.KINDS)}]) AS kind)
SELECT d.process_date, k.kind, count(r.kind) AS n
FROM d CROSS JOIN k LEFT JOIN r ON r.process_date = d.process_date AND r.kind = k.kind GROUP BY d.process_date, k.kind""")
def dq_type_histogram(spark, sf_dir):
    """Kinds of the delivered timestamps per drop, from the gate's metrics: mistyped lines count with their own kind."""
    base, out, metrics = scratch_path(spark, "drops"), scratch_path(spark, "bronze"), scratch_path(spark, "metrics")
    r = raw(spark, sf_dir, "clean")
    adapter.write_daily_drops_with_timestamps(r, _written_timestamp(), base)
    bronze_plan.land_daily(spark, base, out, drop_days(r), as_of=AS_OF, metrics_path=metrics, on_failure="skip", drops=readers.DAILY_DIRS)
    kinds = spark.read.parquet(metrics).filter(F.startswith(F.col("name"), F.lit("Type.")))
    return kinds.select("process_date", F.substring_index("name", ".", -1).alias("kind"), F.col("value").cast("long").alias("n"))


_DAY_SQL = 'CAST(make_timestamp("timestamp" * 1000) AS DATE) AS process_date'
_WEEK_SQL = _dq_wide_sql().replace(_DAY_SQL, "CAST(date_trunc('week', make_timestamp(\"timestamp\" * 1000)) AS DATE) AS process_date")
_RANGE_COLS = tuple(quality._metric_col(m, c) for m, c in quality.PROFILE if m != "Size") + (
    "compliance_timestamp_range", "compliance_content_required")


@register("dq_range_profile", _WEEK_SQL + f"""
SELECT process_date AS week, size, {', '.join(_r(c) + ' AS ' + c for c in _RANGE_COLS)} FROM wide""")
def dq_range_profile(spark, sf_dir):
    """Weekly profile from daily states alone, written in two batches; it equals a profile over the raw rows."""
    path, s = scratch_path(spark, "states"), _suite()
    rows = _dq_input(spark, sf_dir)
    metric_states.save_states(rows.filter(F.col("process_date") < F.lit(REDELIVERY_FROM) + F.expr("INTERVAL 1 DAY")), s, path)
    metric_states.save_states(rows.filter(F.col("process_date") >= F.lit(REDELIVERY_FROM)), s, path)
    weeks = metric_states.range_profile(spark, path, s, {"week": F.to_date(F.date_trunc("week", "process_date"))})
    return _rounded(weeks.select("week", "size", *_RANGE_COLS), *_RANGE_COLS)


def _anomaly_sql(low=quality.SIZE_MAX_DECREASE, high=quality.SIZE_MAX_INCREASE) -> str:
    return f"""
SELECT process_date, size, previous_size, size_change,
  CASE WHEN previous_size IS NULL THEN 'Success' WHEN size_change BETWEEN {low} AND {high} THEN 'Success'
       ELSE 'Failure' END AS status,
  CASE WHEN previous_size IS NULL THEN '{quality.NO_HISTORY}' WHEN size_change BETWEEN {low} AND {high} THEN ''
       ELSE 'size change outside bounds' END AS message
FROM (SELECT process_date, size, lag(size) OVER (ORDER BY process_date) AS previous_size,
             CAST(size - lag(size) OVER (ORDER BY process_date) AS DOUBLE) AS size_change FROM wide) a"""


_ANOMALY_SQL = _anomaly_sql()
NARROW = (-10.0, 10.0)                                        # bounds that some days of any table exceed


def _constraint_rows_sql() -> str:
    """One row per (process_date, constraint) over the ``wide`` CTE."""
    parts = []
    for name, metric, _passes, hint in quality._constraints(_suite()):
        if metric == "ratio_integral_timestamp":
            ok = f"({metric} IS NULL OR {metric} = 1.0)"
        elif name.startswith("hasCompleteness"):
            ok = f"coalesce({metric} > {quality.USER_ID_MIN_COMPLETENESS}, FALSE)"
        else:
            ok = f"coalesce({metric} = 1.0, FALSE)"
        parts.append(f"""SELECT process_date, '{name}' AS "constraint",
  CASE WHEN {ok} THEN 'Success' ELSE 'Failure' END AS constraint_status,
  CASE WHEN {ok} THEN '' ELSE '{hint}' END AS constraint_message, {_r(f'CAST({metric} AS DOUBLE)')} AS value
FROM wide""")
    return " UNION ALL ".join(parts)


# CTEs appended after the ``wide`` CTE of _dq_wide_sql().
_CHECK_CTES = f""",
c AS ({_constraint_rows_sql()}),
an AS ({{anomaly}}),
g AS (SELECT c.process_date,
        CAST(sum(CASE WHEN constraint_status <> 'Success' THEN 1 ELSE 0 END) AS BIGINT) AS failed_constraints,
        any_value(an.status) AS anomaly_status
      FROM c JOIN an ON c.process_date = an.process_date GROUP BY c.process_date)"""


def _checks_sql() -> str:
    return _CHECK_CTES.format(anomaly=_ANOMALY_SQL) + f"""
SELECT process_date, '{_suite().name}' AS "check", 'Error' AS check_level,
  CASE WHEN max(CASE WHEN constraint_status <> 'Success' THEN 1 ELSE 0 END) OVER (PARTITION BY process_date) = 1
       THEN 'Error' ELSE 'Success' END AS check_status,
  "constraint", constraint_status, constraint_message, value
FROM c"""


@register("dq_checks", _dq_wide_sql() + _checks_sql())
def dq_checks(spark, sf_dir):
    s = _suite()
    return _rounded(quality.check_rows(quality.profile_wide(_dq_input(spark, sf_dir), s), s), "value")





def _staged_profile(spark):
    """Stage the one-row-per-day profile so its several readers do not rescan the data."""
    return lambda df: writers.stage(spark, df, "profile")


@register("dq_size_anomaly", _dq_wide_sql() + _anomaly_sql(*NARROW))
def dq_size_anomaly(spark, sf_dir):
    """Day-to-day size changes against narrow bounds, so that both outcomes occur."""
    _, _, _, anomalies, _ = quality.run_checks(_dq_input(spark, sf_dir), _suite(size_change_bounds=NARROW),
                                               materialize=_staged_profile(spark))
    return anomalies.select("process_date", "size", "previous_size", "size_change", "status", "message")


@register("dq_gate", _dq_wide_sql() + _CHECK_CTES.format(anomaly=_ANOMALY_SQL) + """
SELECT process_date, failed_constraints, anomaly_status,
       failed_constraints = 0 AND anomaly_status = 'Success' AS passed
FROM g""")
def dq_gate(spark, sf_dir):
    _, _, _, _, verdict = quality.run_checks(_dq_input(spark, sf_dir), _suite(),
                                             materialize=_staged_profile(spark))
    return verdict


@register("dq_metrics_history", _dq_wide_sql() + _CHECK_CTES.format(anomaly=_ANOMALY_SQL) + f""",
p AS ({_PROFILE_SQL})
SELECT p.*, g.failed_constraints = 0 AND g.anomaly_status = 'Success' AS passed
FROM p JOIN g ON p.process_date = g.process_date""")
def dq_metrics_history(spark, sf_dir):
    """Metrics appended to the history (one partition per process date) and read back."""
    s = _suite()
    path = scratch_path(spark, "metrics")
    _, metrics, _, _, verdict = quality.run_checks(_dq_input(spark, sf_dir), s, materialize=_staged_profile(spark))
    bronze_plan.append_metrics(metrics, verdict, path)
    return _rounded(spark.read.parquet(path).select("process_date", "entity", "instance", "name", "value", "passed"),
                    "value")


# --------------------------------------------------------------------------- pipelines

@register("pipeline_bronze_daily", bronze_sql("clean"))
def pipeline_bronze_daily(spark, sf_dir):
    """Gated landing of every daily drop (clean delivery: every day passes)."""
    base, days = daily_drops(spark, sf_dir, "clean")
    out, metrics = scratch_path(spark, "bronze"), scratch_path(spark, "metrics")
    bronze_plan.land_daily(spark, base, out, days, layout="event_date", as_of=AS_OF, metrics_path=metrics,
                           drops=readers.DAILY_DIRS)
    return flat(spark.read.parquet(out), "event_date")


@register("pipeline_bronze_processing_date",
          f"SELECT *, event_date AS processing_date FROM ({bronze_sql('base')}) b")
def pipeline_bronze_processing_date(spark, sf_dir):
    """Ungated landing into (processing_date, event_date) partitions."""
    base, days = daily_drops(spark, sf_dir, "base")
    out = scratch_path(spark, "bronze")
    bronze_plan.land_daily(spark, base, out, days, layout="processing_date", gate=False,
                           drops=readers.DAILY_DIRS)
    return flat(spark.read.parquet(out), "event_date", "processing_date")


@register("bronze_bad_lines", f"""SELECT CAST(make_timestamp("timestamp" * 1000) AS DATE) AS process_date,
  CASE CAST(floor("timestamp" / 29) AS BIGINT) % 4
    WHEN 0 THEN 'broken ' || event_type || ' ' || "timestamp"
    WHEN 1 THEN '[{{"event_id":"a"}},{{"event_id":"b","timestamp":"oops ' || "timestamp" || '"}}]'
    WHEN 2 THEN '{{"event_id":"a"}} tail ' || "timestamp"
    ELSE '{{"event_id":"a","geo_location":{{"latitude":"north ' || "timestamp" || '"}}}}' END AS line
FROM ({O.raw_cte('clean')}) r WHERE "timestamp" % 29 = 0""")
def bronze_bad_lines(spark, sf_dir):
    """Daily drops in which every 29th line is broken or mistyped: the lines come out with their text and day."""
    base, out = scratch_path(spark, "drops"), scratch_path(spark, "bronze")
    r = raw(spark, sf_dir, "clean")
    adapter.write_daily_drops_with_bad_lines(r, base, every=29)
    bronze_plan.land_daily(spark, base, out, drop_days(r), layout="event_date", gate=False, drops=readers.DAILY_DIRS)
    return spark.read.parquet(out + "_bad_lines").select("process_date", "line")


# Fixed values of the scenario: (field, rows that hold it, its type).
_DRIFT = (("campaign", 7, "OBJECT<x: BIGINT>"), ("note", 13, "STRING"), ("weight", 17, "DECIMAL(3,2)"), ("geo_location.asn", 11, "BIGINT"))


@register("bronze_drift", " UNION ALL ".join(f"""SELECT '{field}' AS field, count(*) AS "rows", '{kind}' AS type
FROM ({O.raw_cte('clean')}) r WHERE "timestamp" % {every} = 0 HAVING count(*) > 0""" for field, every, kind in _DRIFT))
def bronze_drift(spark, sf_dir):
    """Drops with fields outside the schema, nested ones too: landed with their values, reported by path and type."""
    base, out = scratch_path(spark, "drops"), scratch_path(spark, "bronze")
    r = raw(spark, sf_dir, "clean")
    adapter.write_daily_drops_with_new_fields(r, base)
    bronze_plan.land_daily(spark, base, out, drop_days(r), layout="event_date", gate=False, drops=readers.DAILY_DIRS)
    return readers.field_drift(spark.read.parquet(out))


@register("silver_rerun", f"""SELECT 'silver' AS side, CAST(start_time AS VARCHAR) AS at, user_id, country FROM ({O.user_actions_sql('clean')}) s
UNION ALL SELECT 'quarantine', CAST(event_timestamp AS VARCHAR), user_id, country FROM ({O.validated_cte('clean')}) v
WHERE len(validation_errors) > 0""")
def silver_rerun(spark, sf_dir):
    """The base delivery, then the clean one in overwrite mode: silver and quarantine equal a fresh run on clean."""
    silver, quarantine = scratch_path(spark, "silver"), scratch_path(spark, "quarantine")
    for variant in ("base", "clean"):
        silver_plan.run(spark, bronze_table(spark, sf_dir, variant), silver, None, quarantine_path=quarantine, mode="overwrite")
    kept = spark.read.parquet(silver).select(F.lit("silver").alias("side"), F.col("start_time").cast("string").alias("at"), "user_id", "country")
    return kept.union(spark.read.parquet(quarantine).select(
        F.lit("quarantine"), F.col("event_timestamp").cast("string"), "user_id", "country"))


@register("silver_late_event", f"SELECT {_UA_COLS} FROM ({O.user_actions_sql('clean')}) s")
def silver_late_event(spark, sf_dir):
    """Silver of the events without every 13th, which then arrive late: just their keys are sessionized again."""
    silver, bronze = scratch_path(spark, "silver"), scratch_path(spark, "bronze")
    rows = bronze_frame(spark, sf_dir, "clean")
    is_late = F.pmod(F.crc32(F.coalesce("event_id", F.lit(""))), F.lit(13)) == 0
    writers.create_partitioned(rows.filter(~is_late), bronze, ("event_date",))
    silver_plan.run(spark, bronze, silver)
    writers.overwrite_partitions(rows, bronze, ("event_date",))
    silver_plan.correct(spark, bronze, rows.filter(is_late), silver)
    return spark.read.parquet(silver).select(*[f.name for f in SILVER_USER_ACTIONS.fields])


@register("sink_table_create", bronze_sql("base"))
def sink_table_create(spark, sf_dir):
    name = _table_name(spark)
    writers.create_or_overwrite_table(flat(bronze_frame(spark, sf_dir), "event_date"), name)
    return readers.read_table(spark, name)


@register("sink_table_overwrite", ORACLES["sink_overwrite_partitions"])
def sink_table_overwrite(spark, sf_dir):
    """A named table, then the re-delivery of the days from REDELIVERY_FROM on."""
    name = _table_name(spark)
    writers.create_or_overwrite_table(flat(bronze_frame(spark, sf_dir), "event_date"), name)
    again = flat(bronze_frame(spark, sf_dir, "clean"), "event_date").filter(F.col("event_date") >= F.lit(REDELIVERY_FROM))
    writers.create_or_overwrite_table(again, name)
    return readers.read_table(spark, name)


def _table_name(spark, kind: str = "events") -> str:
    return f"{kind}_" + scratch_path(spark, "t").rsplit("/", 1)[-1][:12]


@register("pipeline_manual_hour", f"""SELECT event_id, user_id, content_id, event_type, device_id, "timestamp", country,
  region, hour, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
  CAST(day(date) AS INTEGER) AS day FROM ({HOURLY_SQL}) h""")
def pipeline_manual_hour(spark, sf_dir):
    """Hourly ingestion over every hour of the drops (wall-clock / lineage columns left out)."""
    out = scratch_path(spark, "manual")
    bronze_plan.ingest_hourly(spark, hourly_drops(spark, sf_dir), out)
    return flat(spark.read.parquet(out), "region", "hour", "year", "month", "day")


_LEDGER_SQL = f"""WITH a AS (SELECT *, CAST(hour AS INTEGER) AS h FROM ({HOURLY_SQL}) x),
b AS (SELECT *, CAST(hour AS INTEGER) AS h FROM ({HOURLY_CLEAN_SQL}) y WHERE CAST(hour AS INTEGER) = {SLICE_HOUR})
SELECT event_id, user_id, content_id, event_type, device_id, "timestamp", country, region, h AS hour,
  CAST(day(date) AS INTEGER) AS day FROM (SELECT * FROM b UNION ALL SELECT * FROM a
  WHERE h <> {SLICE_HOUR} OR (region, date) NOT IN (SELECT (region, date) FROM b)) u"""


@register("manual_ledger", _LEDGER_SQL)
def manual_ledger(spark, sf_dir):
    """Every hour by ledger, then one hour's files delivered again: just those are read, their old rows go; a replay reads none."""
    root, table, ledger = (scratch_path(spark, n) for n in ("hourly", "manual", "ledger"))
    keys = ("region", "date", "hour")
    writers.write_hive_partitioned(adapter.hourly_layout(raw(spark, sf_dir)), root, keys)
    bronze_plan.ingest_new_files(spark, root, table, ledger)
    again = adapter.hourly_layout(raw(spark, sf_dir, "clean")).filter(F.col("hour") == f"{SLICE_HOUR:02d}")
    writers.write_hive_partitioned(again, root, keys)
    bronze_plan.ingest_new_files(spark, root, table, ledger)
    if bronze_plan.ingest_new_files(spark, root, table, ledger).files_read:
        raise RuntimeError("a replay read files again")
    return flat(spark.read.parquet(table), "region", "hour", "day")


@register("pipeline_silver", f"""SELECT * FROM ({_merge_sql()}) m WHERE event_date >= DATE '{REDELIVERY_FROM}'
UNION ALL SELECT {_UA_COLS} FROM ({O.user_actions_sql('base')}) b WHERE event_date < DATE '{REDELIVERY_FROM}'""")
def pipeline_silver(spark, sf_dir):
    """Bronze -> validate / quarantine -> sessionize -> MERGE: all days, then a corrected delivery of the later days."""
    silver_path, q_path = scratch_path(spark, "silver"), scratch_path(spark, "quarantine")
    silver_plan.run(spark, bronze_table(spark, sf_dir), silver_path, None, quarantine_path=q_path)
    clean = bronze_table(spark, sf_dir, "clean")
    days = [REDELIVERY_FROM + dt.timedelta(days=i) for i in range(60)]
    silver_plan.run(spark, clean, silver_path, days, quarantine_path=q_path)
    return spark.read.parquet(silver_path).select(*[f.name for f in SILVER_USER_ACTIONS.fields])


@register("user_actions_backfill", O.user_actions_sql("ties"))
def user_actions_backfill(spark, sf_dir):
    """All days at once on hour-stamped events (ties everywhere), equal to day-by-day runs."""
    return silver_plan.transform(bronze_frame(spark, sf_dir, "ties"))[0]
