"""Exact dedup: two Bloom passes find hashes that may repeat; only those rows shuffle.

1. Every row is reduced to (sha-256 of the normalised text, length, id) and staged: the only scan of
   the texts.
2. Pass one counts, per bit of a blocked Bloom filter, the rows that set it.  Bits set at least twice
   form the filter of *repeated* hashes: one 32,768-bit bitmap per block, ``bits_per_row`` bits a row.
   Counting is pre-aggregated map-side, so a hash shared by a third of all rows sends one row per task.
3. Pass two probes each row against the bitmap of its block.  A row with a bit that nobody else set is
   unique for certain and passes straight through.
4. Only the others are grouped by hash (the exact check, so a false positive costs one shuffled row
   and changes nothing).  A group is reduced to one row before it is joined back; adaptive execution
   splits a hot hash of that join.

The bitmaps total ``bits_per_row / 8`` bytes a row.  They are broadcast up to ``max_broadcast_bytes``
(their size follows from the counted rows); beyond it slim rows (no texts) meet their block in a
shuffled join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITESPACE_CLASS, stage, text_of

# Bits and bytes of one bitmap of bitmap_construct_agg.
BLOCK_BITS, BLOCK_BYTES = 32768, 4096


def normalised(text: str | Column) -> Column:
    """The text without white space; NULL is empty."""
    return F.regexp_replace(text_of(text), WHITESPACE_CLASS + "+", "")


def _positions(hash_col: str, hashes: int) -> Column:
    return F.array_distinct(F.array(*[F.pmod(F.xxhash64(hash_col, F.lit(i + 1)), F.lit(BLOCK_BITS)) for i in range(hashes)]))


def _bit(bitmap: Column, position: Column) -> Column:
    """Bit ``position`` of a bitmap (byte position/8, least significant bit first)."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.shiftright(byte, 0).bitwiseAND(F.pow(F.lit(2), position % 8).cast("int")) > 0


def repeated_blocks(digests: DataFrame, blocks: int, hashes: int) -> DataFrame:
    """Pass one: (block, bitmap) of the bits that two or more rows set."""
    bits = digests.select("_block", F.explode(_positions("_sha", hashes)).alias("_bit"))
    twice = bits.groupBy("_block", "_bit").count().filter("count >= 2")
    return twice.repartition("_block").groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_per_row: int = 16,
                hashes: int = 4, max_broadcast_bytes: int = 32 << 20) -> DataFrame:
    """Groups of equal texts (equal after deleting white space); one row per input row.

    Columns: ``id_col``, keep_id, group_size, kept, text_sha256.  The row with the most code points,
    then the smallest id (NULL ids last) stays; of wholly equal rows exactly one stays.  NULL text is
    the empty text and equals white-space-only texts.  Other columns are not read, so their names
    cannot clash; an empty table gives no rows.
    """
    digests = stage(docs.select(
        F.col(id_col).alias("_id"), F.length(text_of(text_col)).cast("long").alias("_n"),
        F.unhex(F.sha2(normalised(text_col), 256)).alias("_sha"), F.monotonically_increasing_id().alias("_row")), "digests")
    blocks = max(1, -(-digests.count() * bits_per_row // BLOCK_BITS))
    digests = digests.withColumn("_block", F.pmod(F.xxhash64("_sha"), F.lit(blocks)))
    filters = stage(repeated_blocks(digests, blocks, hashes), "repeated-bits")
    if blocks * BLOCK_BYTES <= max_broadcast_bytes:
        filters = F.broadcast(filters)
    probed = digests.join(filters, "_block", "left").withColumn("_maybe", F.coalesce(
        F.forall(_positions("_sha", hashes), lambda p: _bit(F.col("_bitmap"), p)), F.lit(False)))
    single = probed.filter(~F.col("_maybe")).select(
        "_id", F.col("_id").alias("_keep_id"), F.lit(1).cast("long").alias("_size"), F.lit(True).alias("_kept"), "_sha")
    repeat = probed.filter("_maybe").select("_id", "_n", "_sha", "_row")
    groups = repeat.groupBy("_sha").agg(
        F.count(F.lit(1)).alias("_size"),
        F.min(F.struct((-F.col("_n")).alias("n"), F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row"))).alias("_first"))
    checked = repeat.join(groups, "_sha").select(
        "_id", F.col("_first.id").alias("_keep_id"), "_size", (F.col("_row") == F.col("_first.row")).alias("_kept"), "_sha")
    return single.unionByName(checked).select(
        F.col("_id").alias(id_col), F.col("_keep_id").alias("keep_id"), F.col("_size").alias("group_size"),
        F.col("_kept").alias("kept"), F.lower(F.hex("_sha")).alias("text_sha256"))
