"""Document fingerprints by winnowing.

A text is cut into words (runs without white space, at most ``MAX_WORD`` code points each, so a text
without white space still has structure).  Every ``k`` consecutive words give one polynomial hash
(Karp-Rabin) modulo a prime; of every ``w`` consecutive hashes the smallest is selected, the rightmost
one in a tie.  Selected hashes are kept with their position.  Guarantee: two texts that share a run of
``w + k - 1`` words share a selected hash; no shared run under ``k`` words gives a match.

Everything is a built-in function over arrays of one row: no explode, no shuffle for the fingerprint
itself, and a text of any length stays one row.  Hash and position travel in one long
(hash * 2^27 + 2^27 - 1 - position), so the plain minimum is the rightmost smallest hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, text_of

GRAM_WORDS = 5
WINDOW = 8
MAX_WORD = 16
# Prime modulus below 2^36, radix below 2^26 (products stay below 2^62), position bits.
PRIME, RADIX, POSITION_BITS = (1 << 36) - 5, 40_503_197, 27
_LAST_POSITION = (1 << POSITION_BITS) - 1


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, as a lambda variable."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]{1,%d})" % MAX_WORD), F.lit(1))


def _horner(terms: list[Column]) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = (out * F.lit(RADIX) + t) % F.lit(PRIME)
    return out


def gram_hashes(word_array: Column, k: int = GRAM_WORDS) -> Column:
    """Hashes of all runs of ``k`` words; of fewer words, the one hash of them all; of none, none."""
    hashed = F.transform(word_array, lambda x: F.pmod(F.xxhash64(x), F.lit(PRIME)))
    none = F.array().cast("array<bigint>")

    def of(h: Column) -> Column:
        n = F.size(h)
        rolled = F.transform(F.sequence(F.lit(0), n - k), lambda i: _horner([h[i + j] for j in range(k)]))
        whole = F.aggregate(h, F.lit(0).cast("bigint"), lambda a, x: (a * F.lit(RADIX) + x) % F.lit(PRIME))
        return F.when(n >= k, rolled).when(n > 0, F.array(whole)).otherwise(none)

    return _let(hashed, of)


def winnow(hashes: Column, w: int = WINDOW) -> Column:
    """Selected (hash, position) of every window, in order of position, coded in one long each."""
    coded = F.transform(hashes, lambda g, i: g * F.lit(1 << POSITION_BITS) + (F.lit(_LAST_POSITION) - i))

    def of(c: Column) -> Column:
        n = F.size(c)
        windows = F.transform(F.sequence(F.lit(0), n - w), lambda i: F.least(*[c[i + j] for j in range(w)]))
        return F.when(n > w, F.array_distinct(windows)).when(n > 0, F.array(F.array_min(c))).otherwise(c)

    return _let(coded, of)


def selected(text: Column, k: int = GRAM_WORDS, w: int = WINDOW) -> Column:
    return winnow(gram_hashes(words(text), k), w)


def hashes_of(coded: Column) -> Column:
    return F.array_distinct(F.transform(coded, lambda c: F.shiftright(c, POSITION_BITS)))


def shown(coded: Column) -> Column:
    """``hash@position`` (hash in hexadecimal), separated by blanks."""
    return F.array_join(F.transform(coded, lambda c: F.concat(
        F.lower(F.hex(F.shiftright(c, POSITION_BITS))), F.lit("@"),
        (F.lit(_LAST_POSITION) - c.bitwiseAND(F.lit(_LAST_POSITION))).cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of selected hashes; two empty sets are alike."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    union = F.size(a) + F.size(b) - F.size(F.array_intersect(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 k: int = GRAM_WORDS, w: int = WINDOW) -> DataFrame:
    """``id_col``, n_chars, fingerprint of every row (a map).  NULL text: the empty fingerprint."""
    text = text_of(text_col)
    return docs.select(F.col(id_col), F.length(text).cast("long").alias("n_chars"),
                       shown(selected(text, k, w)).alias("fingerprint"))


def _predecessors(ids: DataFrame) -> DataFrame:
    """(_key, _prev, _prev_n): the row before each row in key order, the last one before the first.

    ``ids`` (_key, _n) is range-partitioned and staged; inside a partition a window looks back one row,
    and the partitions' ends (one row per partition) supply the rest.
    """
    ranged = stage(ids.repartitionByRange("_key").sortWithinPartitions("_key")
                   .withColumn("_part", F.spark_partition_id()), "id-order")
    inside = Window.partitionBy("_part").orderBy("_key")
    ends = ranged.groupBy("_part").agg(F.max(F.struct("_key", "_n")).alias("_end"))
    order = Window.orderBy("_part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = ends.select("_part", F.coalesce(F.lag("_end").over(order), F.last("_end").over(whole)).alias("_before"))
    row = F.struct("_key", "_n")
    return (ranged.withColumn("_lag", F.lag(row).over(inside)).join(F.broadcast(before), "_part")
            .withColumn("_p", F.coalesce("_lag", "_before"))
            .select("_key", F.col("_p._key").alias("_prev"), F.col("_p._n").alias("_prev_n")))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        k: int = GRAM_WORDS, w: int = WINDOW) -> DataFrame:
    """Fingerprints of each text, of the text with its last quarter replaced, and their likeness.

    The replacement is the head of the next document in id order (NULL id first; after the last comes
    the first; a single document follows itself).  Columns: ``id_col``, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.  Every row is a document: rows of one id (or
    without id) follow each other by a hash of the text, equal rows directly.  NULL text is empty.  Other
    columns are not read.

    Texts are shuffled once, on the id, with their fingerprint; both readers (the document, and the head
    it lends to its predecessor) share that exchange.  Heads and hash sets are the only other rows moved.
    """
    text = text_of(text_col)
    slim = docs.select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash")).alias("_key"), text.alias("_text"))
    ids = stage(slim.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows"), F.min(F.length("_text").cast("long")).alias("_n")), "ids")
    order = stage(_predecessors(ids.select("_key", "_n")), "predecessors")
    again = ids.filter("_rows > 1")
    if not again.isEmpty():
        # Of equal rows all but the last are followed by themselves.
        slim = slim.groupBy("_key").agg(F.min("_text").alias("_text"))
        order = order.union(again.select("_key", F.col("_key").alias("_prev"), F.col("_n").alias("_prev_n"), F.explode(F.sequence(F.lit(2), F.col("_rows")))).drop("col"))
    rows = slim.withColumn("_fp", selected(F.col("_text"), k, w))
    heads = rows.join(order, "_key").select(
        F.col("_prev").alias("_key"), F.substring(F.col("_text"), F.lit(1), F.floor(F.col("_prev_n") / 4).cast("int")).alias("_head"),
        hashes_of(F.col("_fp")).alias("_next"))
    n = F.length("_text")
    both = (rows.join(heads, "_key")
            .withColumn("_edited", F.concat(F.substring(F.col("_text"), F.lit(1), n - F.floor(n / 4).cast("int")), F.col("_head")))
            .withColumn("_n", n.cast("long")).withColumn("_sha", F.sha2("_edited", 256))
            .withColumn("_efp", selected(F.col("_edited"), k, w)).drop("_text", "_head", "_edited")
            .withColumn("_own", hashes_of(F.col("_fp"))).withColumn("_other", hashes_of(F.col("_efp"))))
    return both.select(
        F.col("_key.id").alias(id_col), F.col("_n").alias("n_chars"), F.col("_sha").alias("edited_sha256"),
        shown(F.col("_fp")).alias("fingerprint"), shown(F.col("_efp")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_other")).alias("near_edited"), likeness(F.col("_own"), F.col("_next")).alias("near_next"))
