"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup as exact
from . import fingerprints as marks
from . import conversation_repair, license_scan, line_dedup, near_dedup, packing, pattern_packing, piece_codec
from . import sharding, spelling, toxicity, url_filter
from .common import documents, prepare

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


@register("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@register("op2_exact_dedup", r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS h
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER w = 1 AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY length(t) DESC, doc_id NULLS LAST)""")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return exact.exact_dedup(documents(spark, sf_dir))


@register("op3_fingerprints")
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return marks.edited_fingerprints(documents(spark, sf_dir))


@register("op4_near_dedup")
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_dedup.near_duplicates(documents(spark, sf_dir))


@register("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    pieces = packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "padded_length")


@register("op6_piece_codec")
def op6_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = piece_codec.encode_documents(documents(spark, sf_dir), path)
    both = piece_codec.decode_documents(encoded, path).withColumn("decoded_sha256", F.sha2("decoded", 256))
    return both.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "text_sha256", "decoded_sha256",
                       (F.col("text_sha256") == F.col("decoded_sha256")).alias("lossless"))


@register("op7_license_scan")
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return license_scan.scan_licenses(documents(spark, sf_dir))


# The contract's rules.
URL_RULES = [url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"),
             url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/")]


@register("op8_url_filter")
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return url_filter.judge(pages, url_filter.fit(spark), URL_RULES)


@register("op9_line_dedup")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "lines", "dropped_lines", "text")


@register("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    root = sharding.tree(8)
    rows = sharding.shard_rows(documents(spark, sf_dir), root, grown_root=sharding.grown(root, 8))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@register("op11_pattern_packing")
def op11_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    pieces = pattern_packing.pack_patterns(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


# Fixed value: of the (document, run) pairs one in so many loses a code point.
DAMAGED_RUNS = 31


@register("op12_spelling_variants")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    words = spelling.vocabulary(documents(spark, sf_dir), damage_every=DAMAGED_RUNS)
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


@register("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversation_repair.repair(conversation_repair.damaged(rows))
