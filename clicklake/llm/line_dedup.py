"""Line dedup by a segment-partition edit join over words.

A line of at least ``MIN_CHARS`` code points is dropped when an equal line, or one within ``allowed(words)``
word edits, occurs earlier in the corpus (by id, then line number).  Blank and shorter lines stay.  The
threshold grows with the shorter line: one inserted, deleted or replaced word from ``MIN_FUZZY_WORDS`` words on,
one more for every ``EDIT_EVERY``, at most ``MAX_EDITS``; lines of fewer words must be equal.

1. Every line is reduced to a 128-bit hash; the first occurrence of each distinct line is an aggregate
   (pre-aggregated, so a line that a third of all documents share costs one row a task).
2. A line of ``m`` words is split into ``allowed(m) + 1`` segments.  Two lines within the threshold share a
   segment of the shorter one at nearly the same place: its segments are its *index* rows, and the longer one
   probes the substrings that its own length, the shorter length and the edits left on either side allow
   (the multi-match-aware window).  Keys of all substrings come from prefix sums of word hashes, a whole batch at a
   time.  Rows are (64-bit key, line hash, packed counts); texts stay where they are.  Copies of a line with
   over ``HOT_COPIES`` occurrences send only the first one's rows.
3. The rows are exchanged by key once.  Keys that a single line holds are dropped; the others are staged.  The key's
   *hub* is, the line of most copies.  A line needs one earlier match, not all: hub rounds pair every
   line still kept with the hubs of its keys (one pair a row), which settles families of copies of one line.  The
   last round pairs the lines that are kept after that with all lines of their keys, so nothing is missed.
4. Pairs must agree in length and in a parity sketch of their words (40 bits, of which an edit flips two at
   most); the texts of what is left are fetched and verified by banded bit-parallel edit distance over words.
5. The line numbers that stay are gathered per document (from first occurrences, so without a hot key)
   and applied in one map.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from .common import broadcast_if_small, fresh, slices, stage, text_of
from .edit_distance import within
from .shingles import _mixed

MIN_CHARS = 12
MIN_FUZZY_WORDS = 4
EDIT_EVERY = 48
MAX_EDITS = 3
HOT_COPIES = 64
# Rounds that pair lines with the hubs of their keys before the lines still kept meet all others.
HUB_ROUNDS = 2
# Bits of a line's sketch: bit ``hash % SKETCH_BITS`` is the parity of the words that fall on it.
SKETCH_BITS = 40
_RADIX = 0x9E3779B97F4A7C15
_INVERSE = pow(_RADIX, -1, 1 << 64)


def allowed(words: int) -> int:
    """Word edits within which a line of so many words counts as a copy of one with as many or more."""
    return min(1 + words // EDIT_EVERY, MAX_EDITS) if words >= MIN_FUZZY_WORDS else 0


def words_of(line: str) -> list[bytes]:
    """Words as the runs without ``[\\x20\\x09-\\x0D]``."""
    return line.encode("utf-8", "surrogatepass").split()


def _doc_key(id_col: str, text_col: str) -> Column:
    """Orders documents: rows with an id first, by id, then by text (rows of one id may differ)."""
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("salt"))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_doc, _no, _line, _h1, _h2) of the lines that may be dropped."""
    split = docs.select(_doc_key(id_col, text_col).alias("_doc"), F.posexplode(F.split(text_of(text_col), "\n", -1)).alias("_no", "_line"))
    return (split.filter((F.length("_line") >= MIN_CHARS) & F.col("_line").rlike(r"[^\x20\x09-\x0D]"))
            .withColumns({"_h1": F.xxhash64("_line"), "_h2": F.xxhash64("_line", F.lit(1))}))


def _segments(n: int, parts: int) -> list[tuple[int, int]]:
    """(start, length) of the even parts of ``n`` words, longer ones last."""
    size, longer = divmod(n, parts)
    out, at = [], 0
    for i in range(parts):
        length = size + (i >= parts - longer)
        out.append((at, length))
        at += length
    return out


@lru_cache(maxsize=20_000)
def _template(n: int) -> np.ndarray:
    """Columns (start, size, segment and shorter length, is index) of all rows of a line of ``n`` words.

    For a line ``gap`` shorter and its segment ``i``, at most ``i`` edits lie before the segment and the others
    after it, which bounds where the segment can start here.  A probe that equals the own index row is left out.
    """
    rows = [(start, size, n * 8 + i, 1) for i, (start, size) in enumerate(_segments(n, allowed(n) + 1))] if allowed(n) else []
    for gap in range(MAX_EDITS + 1):
        m, most = n - gap, allowed(max(n - gap, 0))
        if not most or gap > most:
            continue
        for i, (start, size) in enumerate(_segments(m, most + 1)):
            lo, hi = max(start - i, start + gap - (most - i), 0), min(start + i, start + gap + most - i, n - size)
            rows += [(at, size, m * 8 + i, 0) for at in range(lo, hi + 1) if gap or at != start]
    return np.array(rows, np.int64).reshape(-1, 4)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.multiply.accumulate(out)


def key_rows(lines: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(line number, key, is index, word sketch per line) of all index and probe rows of some lines.

    The hash of a substring is a difference of prefix sums over word hashes, moved to the origin by a power
    of the inverse radix, so that all substrings of a batch cost a few array operations.
    """
    counts = np.array([len(w) for w in lines], np.int64)
    hashes = np.fromiter((xxh3_64_intdigest(w) for line in lines for w in line), np.uint64, int(counts.sum()))
    owner = np.repeat(np.arange(len(lines)), counts)
    odd = np.bincount(owner * SKETCH_BITS + (hashes % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS * len(lines)) & 1
    sketches = (odd.reshape(-1, SKETCH_BITS) << np.arange(SKETCH_BITS)).sum(1)
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_RADIX, len(hashes)), dtype=np.uint64)]
    back = _powers(_INVERSE, len(hashes) + 1)
    base = np.cumsum(counts) - counts
    number, key, index = [], [], []
    for n in np.unique(counts).tolist():
        form = _template(n)
        if not len(form):
            continue
        rows = np.flatnonzero(counts == n)
        at = base[rows][:, None] + form[:, 0]
        found = (sums[at + form[:, 1]] - sums[at]) * back[at]
        key.append(_mixed(found ^ _mixed((form[:, 2] * 2 + 1).astype(np.uint64))).ravel())
        number.append(np.repeat(rows, len(form)))
        index.append(np.tile(form[:, 3], len(rows)))
    if not key:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), sketches
    return np.concatenate(number), np.concatenate(key), np.concatenate(index), sketches


# What a row packs into 64 bits: sketch (40), log of the copies (6), words (17) and whether it is an index row (1).
_MOST_WORDS = (1 << 17) - 1


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 4096):
        lines = [words_of(x) for x in batch.column(1).to_pylist()]
        number, key, index, sketches = key_rows(lines)
        copies = np.log2(np.maximum(batch.column(2).to_numpy(), 1)).astype(np.int64)
        counts = np.minimum([len(x) for x in lines], _MOST_WORDS).astype(np.int64)
        packed = ((sketches << 24) | (copies << 18) | (counts << 1))[number] | index
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(batch.column(0).to_numpy()[number]), pa.array(packed)],
                                         ["_key", "_h", "_packed"])


def _words(packed: Column) -> Column:
    return F.shiftright(packed, 1).bitwiseAND(F.lit(_MOST_WORDS))


def _near_counts(a: Column, b: Column) -> Column:
    """True when word counts and sketches (an edit flips 2 bits at most) are as close as the edits allow."""
    most = F.least(1 + F.floor(F.least(_words(a), _words(b)) / EDIT_EVERY), F.lit(MAX_EDITS))
    flipped = F.bit_count(F.shiftrightunsigned(a.bitwiseXOR(b), 24))
    return (F.abs(_words(a) - _words(b)) <= most) & (flipped <= 2 * most)


def first_lines(lines: DataFrame) -> DataFrame:
    """(_h1, _h2, _first, _copies): a row per distinct line."""
    return lines.groupBy("_h1", "_h2").agg(F.min(F.struct("_doc", "_no")).alias("_first"), F.count(F.lit(1)).alias("_copies"))


def shared_keys(lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """Staged rows (_key, _h, _packed, _hub, _hub_packed) of the keys that two lines or more hold."""
    hot = stage(firsts.filter(F.col("_copies") > HOT_COPIES).select("_h1", "_first", "_copies"), "hot-lines")
    sent = (lines.join(broadcast_if_small(hot), "_h1", "left")
            .filter(F.col("_first").isNull() | (F.col("_first") == F.struct("_doc", "_no"))))
    rows = sent.select("_h1", "_line", F.coalesce("_copies", F.lit(1)).alias("_copies")).mapInArrow(_keyed, "_key long, _h long, _packed long")
    w = Window.partitionBy("_key")
    grouped = rows.withColumns({"_low": F.min("_h").over(w), "_high": F.max("_h").over(w), "_indexed": F.max(F.col("_packed").bitwiseAND(F.lit(1))).over(w)})
    return stage(grouped.filter((F.col("_low") < F.col("_high")) & (F.col("_indexed") == 1)).select("_key", "_h", "_packed"), "line-keys")


def _without(shared: DataFrame, dropped: DataFrame | None) -> DataFrame:
    if dropped is None:
        return shared
    dropped = broadcast_if_small(dropped)
    return shared.join(dropped, F.col("_h") == dropped["_h1"], "left_anti")


def hub_pairs(shared: DataFrame, dropped: DataFrame | None = None) -> DataFrame:
    """(a, b), a < b: every line that is not ``dropped`` (_h1) with the hubs of its keys."""
    copies = F.shiftrightunsigned("_packed", 18).bitwiseAND(F.lit(63))
    best = F.max(F.struct(copies.alias("c"), "_h", "_packed")).over(Window.partitionBy("_key"))
    hubs = _without(shared, dropped).withColumn("_best", best).select("_h", "_packed", F.col("_best._h").alias("_hub"), F.col("_best._packed").alias("_hub_packed"))
    near = hubs.filter((F.col("_h") != F.col("_hub")) & _near_counts(F.col("_packed"), F.col("_hub_packed")))
    return near.select(F.least("_h", "_hub").alias("a"), F.greatest("_h", "_hub").alias("b")).distinct()


def kept_pairs(shared: DataFrame, dropped: DataFrame) -> DataFrame:
    """(a, b), a < b: every line that is not ``dropped`` (_h1) with all lines that share a key, one of them as index."""
    left = _without(shared, dropped).select("_key", F.col("_h").alias("_a"), F.col("_packed").alias("_pa"))
    right = shared.select("_key", F.col("_h").alias("_b"), F.col("_packed").alias("_pb"))
    met = left.join(right, (left["_key"] == right["_key"]) & (F.col("_a") != F.col("_b"))
                    & (F.col("_pa").bitwiseOR(F.col("_pb")).bitwiseAND(F.lit(1)) == 1) & _near_counts(F.col("_pa"), F.col("_pb")))
    return met.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct()


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            x, y = words_of(x), words_of(y)
            most = allowed(min(len(x), len(y)))
            ok.append(most > 0 and within(x, y, most))
        kept = batch.filter(pa.array(ok, pa.bool_()))
        yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], ["a", "b"])


def line_texts(lines: DataFrame, shared: DataFrame) -> DataFrame:
    """Staged (_h1, _line) of the lines that share a key with another: the only texts that are fetched, once."""
    wanted = stage(shared.select(F.col("_h").alias("_h1")).distinct(), "line-hashes")
    texts = lines.select("_h1", "_line").join(broadcast_if_small(wanted), "_h1", "left_semi")
    return stage(texts.groupBy("_h1").agg(F.min("_line").alias("_line")), "line-texts")


def similar_lines(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b): those of ``pairs`` whose texts are within the threshold."""
    both = (pairs.join(texts.select(F.col("_h1").alias("a"), F.col("_line").alias("_x")), "a")
            .join(texts.select(F.col("_h1").alias("b"), F.col("_line").alias("_y")), "b").select("a", "b", "_x", "_y"))
    return both.mapInArrow(_verify, "a long, b long")


def _later(similar: DataFrame, firsts: DataFrame) -> DataFrame:
    """(_h1): of each pair the line that occurs first at the later place."""
    place = firsts.select("_h1", "_first")
    placed = (similar.join(place.select(F.col("_h1").alias("a"), F.col("_first").alias("_at_a")), "a")
              .join(place.select(F.col("_h1").alias("b"), F.col("_first").alias("_at_b")), "b"))
    return stage(placed.select(F.when(F.col("_at_a") < F.col("_at_b"), F.col("b")).otherwise(F.col("a")).alias("_h1")).distinct(), "later-lines")


def kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_doc, _kept): numbers of the lines that stay, of those that may be dropped."""
    lines = _lines(docs, id_col, text_col)
    firsts = stage(first_lines(lines), "first-lines")
    shared = shared_keys(lines, firsts)
    texts = line_texts(lines, shared)
    dropped = None
    for _ in range(HUB_ROUNDS):
        found = _later(similar_lines(texts, hub_pairs(shared, dropped)), firsts)
        dropped = found if dropped is None else stage(dropped.union(found).distinct(), "dropped-lines")
    others = _later(similar_lines(texts, kept_pairs(shared, dropped)), firsts)
    stay = firsts.join(dropped.union(others).distinct(), "_h1", "left_anti")
    return stay.select("_first._doc", "_first._no").groupBy("_doc").agg(F.collect_list("_no").alias("_kept"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                count_col: str | None = None, with_counts: bool = True) -> DataFrame:
    """``docs`` with the dropped lines cut out of ``text_col``, plus lines and dropped_lines counts.

    All rows and columns stay; a text may become empty, NULL stays NULL, an empty table stays empty, texts and
    lines may be of any length.  Of lines at one place of the order (rows of one id and one text) none counts
    as the earlier one.  Rows of one id and one text
    are one document and keep the same lines.  ``count_col`` names a column to set to the new length;
    the counts are left out without ``with_counts``, and get underscores before a name already taken.
    """
    kept = stage(kept_lines(docs, id_col, text_col), "kept-lines")
    at = docs.columns.index(text_col)
    counted = docs.columns.index(count_col) if count_col else -1
    width, key, numbers_col = len(docs.columns), fresh(docs, "_key"), fresh(docs, "_kept")
    added = [fresh(docs, "lines"), fresh(docs, "dropped_lines")] if with_counts else []
    names = [*docs.columns, *added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, totals, dropped = [], [], []
            for text, numbers in zip(batch.column(at).to_pylist(), batch.column(width).to_pylist(), strict=True):
                lines = [] if text is None else text.split("\n")
                stay = set(numbers or ())
                left = [x for i, x in enumerate(lines) if i in stay or len(x) < MIN_CHARS or not x.strip(" \t\n\r\x0b\x0c")]
                texts.append(None if text is None else "\n".join(left))
                totals.append(len(lines))
                dropped.append(len(lines) - len(left))
            columns = [batch.column(i) for i in range(width)]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if counted >= 0:
                columns[counted] = pa.array([len(t or "") for t in texts], batch.schema.field(counted).type)
            counts = [pa.array(totals, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *(counts if added else [])], names)

    joined = (docs.withColumn(key, _doc_key(id_col, text_col))
              .join(kept.select(F.col("_doc").alias(key), F.col("_kept").alias(numbers_col)), key, "left").drop(key))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in added)])
    return joined.mapInArrow(run, schema)
