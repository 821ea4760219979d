"""Corpus pipeline: toxicity filter -> line dedup -> near-duplicate removal -> packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that
is written as Parquet and read again as the next one's ``docs``.  Every stage works on all rows its
predecessor kept; all but the last return the columns of ``documents``.

In every stage NULL text counts as empty (and stays NULL where the text is returned), NULL ids and repeated rows
are rows like any other, an empty table gives an empty result of the same columns, texts may be of any length and
other columns may have any name; what else a stage does with them stands in its docstring.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.llm import line_dedup, near_dedup, packing, toxicity
from clicklake.llm.common import documents, prepare, stage

# Model fits, packing offsets and edit joins have no SQL form: tests hold the stages against brute force.
ORACLE_SQL = None
# Shared 5-word shingles, in percent of all of both texts, from which the near-duplicate stage drops copies.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores under 0.5 (fitted on labelled rows of ``docs``).

    Where nothing was learned (no labels, or one kind only) all rows stay.  Empty texts get the model's bias.
    """
    prepare(spark)
    model = toxicity.fit_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that occur earlier or nearly so; n_chars follows the text."""
    prepare(spark)
    counted = "n_chars" if "n_chars" in docs.columns else None
    return line_dedup.dedup_lines(docs, count_col=counted, with_counts=False)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (the smallest id); texts without words stay."""
    prepare(spark)
    return near_dedup.keep_one(docs, percent=NEAR_PERCENT)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 2048-token sequences with their token ids and the ids' CRC-32."""
    prepare(spark)
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    docs = documents(spark, sf_dir)
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
