"""Scans: daily JSON-lines drops, Hive-partitioned Parquet, catalog tables, schemas.

All readers take an explicit schema by default: no inference job, a stable
column order, and bad lines land in ``_corrupt_record`` instead of failing.
Gzip files are not splittable (one task per file); callers that fan out
heavy work should repartition on their own key after reading.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CORRUPT_RECORD, EVENT_CONTRACT, RAW_EVENT_WITH_CORRUPT

@dataclass(frozen=True)
class DropLayout:
    """Where the drop of a day lives below the base path, and how to read the day back."""

    path_format: str
    date_pattern: str

    def path(self, base_path: str, day: dt.date) -> str:
        return base_path.rstrip("/") + "/" + self.path_format.format(date=day)

    def glob(self, base_path: str) -> str:
        return base_path.rstrip("/") + "/" + self.path_format.split("{")[0] + "*"


# One gzip JSON-lines file per day, named by the day.
DAILY_FILES = DropLayout("events_{date:%Y-%m-%d}.jsonl.gz", r"events_(\d{4}-\d{2}-\d{2})\.jsonl\.gz")
# One directory per day, as a distributed writer emits it (partitionBy("drop_date")).
DAILY_DIRS = DropLayout("drop_date={date:%Y-%m-%d}", r"drop_date=(\d{4}-\d{2}-\d{2})")


def daily_path(base_path: str, day: dt.date, layout: DropLayout = DAILY_FILES) -> str:
    return layout.path(base_path, day)


SOURCE_FILE = "_source_file"


def drop_date(layout: DropLayout = DAILY_FILES, path_col: str = "_metadata.file_path") -> Column:
    """Drop day taken from the file path (captured at scan time)."""
    return F.to_date(F.regexp_extract(F.col(path_col), layout.date_pattern, 1))


def read_jsonl_daily(spark: SparkSession, base_path: str, days: dt.date | Iterable[dt.date],
                     schema: T.StructType | None = RAW_EVENT_WITH_CORRUPT,
                     layout: DropLayout = DAILY_FILES) -> DataFrame:
    """Read the drop of one day, or of several days as one scan.

    ``schema=None`` falls back to inference (an extra pass over the input).
    """
    days = [days] if isinstance(days, dt.date) else list(days)
    paths = [layout.path(base_path, d) for d in days]
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_RECORD)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(paths)


# Fields of a line that the schema does not name, nested ones too, as JSON text.
EXTRA_FIELDS = "extra_fields"
# JSON text of the timestamp as delivered, for the data-type check; not part of bronze.
RAW_TIMESTAMP = "_raw_timestamp"


def read_drops(spark: SparkSession, base_path: str, days: dt.date | Iterable[dt.date],
               schema: T.StructType = RAW_EVENT_WITH_CORRUPT, layout: DropLayout = DAILY_FILES,
               raw_texts: dict[str, str] | None = None) -> DataFrame:
    """Rows of the drops of ``days`` plus ``_source_file`` (taken at the scan), ``extra_fields`` and ``raw_texts``.

    A gzip drop is not splittable: one task must decompress it, but that task only splits lines.  The
    lines are rebalanced (adaptive execution sizes the partitions) and parsed in parallel, so a day that
    holds a third of all rows is parsed by many tasks.  There is one path for any number of files; blank
    lines are no rows, all others go through ``parse_lines``.
    """
    days = [days] if isinstance(days, dt.date) else list(days)
    lines = (spark.read.text([layout.path(base_path, d) for d in days])
             .select("value", F.col("_metadata.file_path").alias(SOURCE_FILE)).filter(F.trim("value") != ""))
    return parse_lines(lines.hint("rebalance"), schema, raw_texts)


_OBJECT, _ARRAY = "map<string,variant>", "array<variant>"


def _typed(value: Column, path: str, kind: T.DataType) -> Column:
    """The value at ``path`` of a VARIANT as ``kind``; NULL where it is missing."""
    if isinstance(kind, T.StructType):
        fields = F.struct(*[_typed(value, f"{path}.{f.name}", f.dataType).alias(f.name) for f in kind.fields])
        return F.when(F.try_variant_get(value, path, _OBJECT).isNotNull(), fields)
    return F.try_variant_get(value, path, kind.simpleString())


# Kinds of JSON values (as ``schema_of_variant`` names them) that a column of a type takes.
_TAKES = {T.LongType: ["BIGINT"], T.IntegerType: ["BIGINT"], T.BooleanType: ["BOOLEAN"], T.DoubleType: ["BIGINT", "DOUBLE"]}


def _mistyped(value: Column, path: str, kind: T.DataType) -> Column:
    """True when the value at ``path`` is there, not null, and no ``kind``: its text would be lost in the column."""
    if isinstance(kind, T.StringType):
        return F.lit(False)
    here = F.try_variant_get(value, path, "variant")
    there = here.isNotNull() & ~F.is_variant_null(here)
    if isinstance(kind, T.StructType):
        bad = F.try_variant_get(value, path, _OBJECT).isNull()
        for f in kind.fields:
            bad = bad | _mistyped(value, f"{path}.{f.name}", f.dataType)
        return there & bad
    takes = _TAKES.get(type(kind))
    if takes is None:
        return there & F.try_variant_get(value, path, kind.simpleString()).isNull()
    name = F.schema_of_variant(here)
    fits = name.isin(takes)
    if isinstance(kind, T.DoubleType):
        fits = fits | name.startswith("DECIMAL")
    if isinstance(kind, T.IntegerType):
        fits = fits & F.try_variant_get(value, path, "int").isNotNull()
    return there & ~fits


def _unknown(value: Column, path: str, kind: T.StructType) -> Column:
    """JSON text of the fields at ``path`` that ``kind`` lacks, nested structs included; NULL without any."""
    fields = F.map_filter(F.try_variant_get(value, path, _OBJECT), lambda k, _: ~k.isin([f.name for f in kind.fields]))
    own = F.when(F.size(fields) > 0, F.regexp_extract(F.to_json(fields), r"(?s)^\{(.*)\}$", 1))
    nested = [F.concat(F.lit(f'"{f.name}":'), _unknown(value, f"{path}.{f.name}", f.dataType))
              for f in kind.fields if isinstance(f.dataType, T.StructType)]
    inner = F.concat_ws(",", own, *nested)
    return F.when(inner != "", F.concat(F.lit("{"), inner, F.lit("}")))


def _raw_text(one: Column, many: Column, field: str) -> Column:
    """JSON text of a top-level field; of a line with several objects the first text that is no whole number, if any."""
    def text(v: Column) -> Column:
        return F.to_json(F.try_variant_get(v, f"$.{field}", "variant"))

    texts = F.filter(F.transform(many, text), lambda t: t.isNotNull())
    odd = F.filter(texts, lambda t: ~t.rlike(r"^-?\d+$"))
    return F.when(many.isNotNull(), F.coalesce(F.try_element_at(odd, F.lit(1)), F.try_element_at(texts, F.lit(1)))).otherwise(text(one))


def parse_lines(lines: DataFrame, schema: T.StructType = RAW_EVENT_WITH_CORRUPT,
                raw_texts: dict[str, str] | None = None) -> DataFrame:
    """(value, ...) text lines -> rows of ``schema``, ``extra_fields`` and the other columns.

    ``raw_texts`` (field -> column) adds the JSON texts of top-level fields as they were delivered, also of lines
    that do not fit the schema; of a misfit array, which stays one row, the first text that is no whole number.

    Each line is parsed once, into a VARIANT, and everything is taken from that.  A line is an object or an
    array of objects (one row each).  Nothing is lost: fields that the schema lacks, at any level, come as
    JSON in ``extra_fields``; a line with a value that does not fit its column, with text behind its JSON or a
    repeated field, and one that is no object, keeps its whole text in ``_corrupt_record`` (as one row).
    JSON is strict: quotes are double, NaN is no number.
    """
    plain = T.StructType([f for f in schema.fields if f.name != CORRUPT_RECORD])
    kept = [c for c in lines.columns if c != "value"]
    # In brackets a line with text behind its value does not parse, and one with two values has two elements.
    parsed = lines.withColumn("_v", F.try_parse_json(F.concat(F.lit("["), "value", F.lit("]"))))
    values = F.try_variant_get("_v", "$", _ARRAY)
    one = F.when(F.size(values) == 1, F.try_variant_get("_v", "$[0]", "variant"))
    split = parsed.select("value", *kept, one.alias("_one"))
    many = F.try_variant_get("_one", "$", _ARRAY)

    def broken(e: Column) -> Column:
        return F.coalesce(F.try_variant_get(e, "$", _OBJECT).isNull(), F.lit(True)) | _mistyped(e, "$", plain)

    split = split.withColumn("_many", many).withColumn(
        "_broken", F.when(F.col("_many").isNotNull(), F.exists("_many", broken)).otherwise(F.col("_one").isNull() | broken(F.col("_one"))))
    elements = F.when(F.col("_many").isNull() | F.col("_broken"), F.array("_one")).otherwise(F.col("_many"))
    rows = split.select("value", *kept, "_broken", F.explode(elements).alias("_e"))
    e = F.col("_e")
    columns = [F.when(F.col("_broken"), F.col("value")).alias(f.name) if f.name == CORRUPT_RECORD else _typed(e, f"$.{f.name}", f.dataType).alias(f.name)
               for f in schema.fields]
    extra = F.when(~F.col("_broken"), _unknown(e, "$", plain))
    none = F.lit(None).cast(_ARRAY)
    texts = [_raw_text(e, F.when(F.col("_broken"), F.try_variant_get(e, "$", _ARRAY)).otherwise(none), field).alias(name)
             for field, name in (raw_texts or {}).items()]
    return rows.select(*columns, extra.alias(EXTRA_FIELDS), *texts, *kept)


def field_drift(rows: DataFrame, schema: T.StructType = RAW_EVENT_WITH_CORRUPT) -> DataFrame:
    """(field, rows, type): fields outside ``schema`` seen in ``extra_fields``, nested ones by their path, with their common type."""
    structs = [f for f in schema.fields if isinstance(f.dataType, T.StructType)]
    value = F.parse_json(EXTRA_FIELDS)

    def entries(path: str, prefix: str, leave_out: list[str]) -> Column:
        found = F.map_filter(F.try_variant_get(value, path, _OBJECT), lambda k, _: ~k.isin(leave_out) if leave_out else F.lit(True))
        listed = F.transform(F.map_entries(found), lambda x: F.struct(F.concat(F.lit(prefix), x["key"]).alias("field"), x["value"].alias("value")))
        return F.coalesce(listed, F.from_json(F.lit("[]"), "array<struct<field:string,value:variant>>"))

    every = F.concat(entries("$", "", [f.name for f in structs]), *[entries(f"$.{f.name}", f"{f.name}.", []) for f in structs])
    listed = rows.filter(F.col(EXTRA_FIELDS).isNotNull()).select(F.inline(every))
    return listed.groupBy("field").agg(F.count(F.lit(1)).alias("rows"), F.schema_of_variant_agg("value").alias("type"))


def read_directories(spark: SparkSession, root: str, patterns: list[str], schema: T.StructType | None = None) -> DataFrame:
    """Partitioned Parquet below ``root``, only the directories that match; none of them: no rows."""
    from pyspark.errors import AnalysisException

    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.option("basePath", root).parquet(*patterns)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return read_partitioned_parquet(spark, root, schema).limit(0)


def read_jsonl_glob(spark: SparkSession, pattern: str,
                    schema: T.StructType | None = RAW_EVENT_WITH_CORRUPT) -> DataFrame:
    """Read every file matching a glob such as ``.../events_*.jsonl.gz``."""
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_RECORD)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(pattern)


def read_partitioned_parquet(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet with partition discovery (``region=/date=/hour=`` -> STRING / DATE / INT)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(root)


def read_with_contract(spark: SparkSession, path: str, fmt: str = "json",
                       contract: T.StructType = EVENT_CONTRACT) -> DataFrame:
    """Schema-enforced read: only contract columns, missing ones as NULL."""
    reader = spark.read.schema(contract)
    if fmt == "json":
        reader = reader.option("mode", "PERMISSIVE")
    return reader.format(fmt).load(path)


def with_source_file(df: DataFrame) -> DataFrame:
    """Lineage column taken at the scan (``_metadata`` survives later shuffles)."""
    return df.withColumn("source_file_name", F.col("_metadata.file_path"))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def describe_schema(df: DataFrame) -> DataFrame:
    """(position, col_name, data_type) of a frame as a DataFrame."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, col_name string, data_type string")


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Catalog introspection (SHOW TABLES) as a DataFrame."""
    tables = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    rows = [(t.catalog, (t.namespace or [None])[0] if t.namespace else t.database, t.name,
             t.tableType, bool(t.isTemporary)) for t in tables]
    return spark.createDataFrame(rows, "catalog string, database string, name string, "
                                       "table_type string, is_temporary boolean")


def list_databases(spark: SparkSession) -> DataFrame:
    rows = [(d.name, d.locationUri) for d in spark.catalog.listDatabases()]
    return spark.createDataFrame(rows, "name string, location string")
