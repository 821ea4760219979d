"""Spelling variant grouping: near words through blocked Gram matrices of letter counts.

Words are maximal letter runs, A-Z lower-cased.  Two words are near when exactly one code point is
inserted, deleted or replaced.  The near words of a whole vocabulary are found without comparing all of it:

1. One map counts the words of every text (pre-aggregated in the task, then summed by a shuffle).
2. A word of ``m`` code points is cut into parts of at most ``PART`` code points.  One edit lies inside one
   part, so near words agree outside it: a *block* is (m, part, all the rest of the word).  Words of ``m``
   and of ``m + 1`` code points meet in the blocks of ``m`` (adjacent lengths).
3. Blocks are sorted together; a tile of blocks is a matrix of letter counts, and one NumPy product of it
   with itself (a Gram matrix) gives all squared distances ``|x|^2 + |y|^2 - 2 xy``.  Pairs of one block
   at most two apart are verified by comparing what follows their common prefix.  A pair is taken in
   the block whose part holds its first difference, so that it comes out once.
4. A block of over ``HOT_BLOCK`` words is split by single positions of its part, which leaves groups
   bounded by the alphabet: exact, and no task meets an unbounded group.

A word's *form* is its near word of largest count, if that is ``FORM_RATIO`` times its own; the *root* is
found by pointer doubling, as counts grow by that ratio along a chain the rounds are few.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import broadcast_if_small, slices, stage, text_of

MIN_CHARS = 7
MIN_COUNT = 2
FORM_RATIO = 10
PART = 3
HOT_BLOCK = 4096
TILE = 256
# Distinct words that a counting task holds before it hands them on.
HELD_WORDS = 400_000
# The letters of a word.
LETTERS = "A-Za-zÀ-ÿ"


def _runs(text: str, least: int) -> Counter:
    """Counts of the maximal letter runs of at least ``least`` code points, A-Z lower-cased."""
    low = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return Counter(re.findall(f"[{LETTERS}]{{{least},}}", low))


def misspelt(row_id, run: str, every: int) -> str:
    """The run without one code point, for a fixed share of the (id, run) pairs (a NULL id reads as empty)."""
    h = zlib.crc32(f"{'' if row_id is None else row_id}:{run}".encode("utf-8", "surrogatepass"))
    at = h % len(run)
    return run[:at] + run[at + 1:] if h % every == 0 else run


def _count(least: int, every: int):
    def flush(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in slices(batches, 256):
            for row_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word, n in _runs(text, least).items():
                    if every:
                        word = misspelt(row_id, word, every)
                        if len(word) < least:
                            continue
                    held[word] += n
                if len(held) >= HELD_WORDS:
                    yield flush(held)
                    held.clear()
        yield flush(held)

    return run


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
               min_count: int = MIN_COUNT, damage_every: int = 0) -> DataFrame:
    """(word, n): words of at least ``min_chars`` code points that occur ``min_count`` times or more.

    NULL texts hold no words.  ``damage_every`` takes one code point out of that share of (id, word) pairs.
    """
    slim = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    counted = slim.mapInArrow(_count(min_chars, damage_every), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def parts(m: int, size: int = PART) -> list[tuple[int, int]]:
    """(start, end) of the parts of ``m`` code points, each at most ``size`` long."""
    count = -(-m // size)
    return [(m * i // count, m * (i + 1) // count) for i in range(count)]


def _block_rows(size: int):
    """A row per block of a word: as a word of the block's length m, and as one of m + 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            keys, lengths, indexes, rows = [], [], [], []
            for row, word in enumerate(batch.column(0).to_pylist()):
                for longer in (0, 1):
                    m = len(word) - longer
                    for i, (start, end) in enumerate(parts(m, size)):
                        rest = word[:start] + "\0" + word[end + longer:]
                        keys.append(xxh3_64_intdigest(rest.encode("utf-8", "surrogatepass"), seed=m * 4096 + i) - (1 << 63))
                        lengths.append(m)
                        indexes.append(i)
                        rows.append(row)
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(lengths, pa.int32()), pa.array(indexes, pa.int32()),
                 batch.column(0).take(taken), batch.column(1).take(taken)], ["_key", "_m", "_part", "word", "n"])

    return run


def _position_rows(size: int):
    """The rows of hot blocks again, a key per position of the part: groups are bounded by the alphabet.

    A replaced code point leaves the two words equal without that position; an inserted one, taken out
    of the longer word, leaves the shorter.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            keys, rows = [], []
            columns = (batch.column(c).to_pylist() for c in range(4))
            for row, (key, m, i, word) in enumerate(zip(*columns, strict=True)):
                start, end = parts(m, size)[i]
                if len(word) == m:
                    own = {f"i{word}", *(f"{at}:{word[:at]}{word[at + 1:]}" for at in range(start, end))}
                else:
                    own = {f"i{word[:at]}{word[at + 1:]}" for at in range(start, end + 1)}
                for k in own:
                    keys.append(xxh3_64_intdigest(k.encode("utf-8", "surrogatepass"), seed=key + (1 << 63)) - (1 << 63))
                    rows.append(row)
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *(batch.column(c).take(taken) for c in range(1, 5))],
                                             ["_key", "_m", "_part", "word", "n"])

    return run


def letter_counts(words: list[str]) -> np.ndarray:
    """A row per word: how often each of a-z and of U+00C0 to U+00FF occurs, in 90 columns."""
    wide = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    letter = np.where(wide < 128, wide - 97, wide - 0xC0 + 26)
    return np.bincount(owner * 90 + letter, minlength=90 * len(words)).reshape(-1, 90).astype(np.float32)


def one_edit_at(a: str, b: str) -> int:
    """First difference if one inserted, deleted or replaced code point turns ``a`` into ``b``, else -1."""
    if len(a) > len(b):
        a, b = b, a
    at = 0
    while at < len(a) and a[at] == b[at]:
        at += 1
    if len(a) == len(b):
        return at if at < len(a) and a[at + 1:] == b[at + 1:] else -1
    return at if len(b) == len(a) + 1 and a[at:] == b[at + 1:] else -1


def _tile_pairs(left: tuple, right: tuple | None) -> list[tuple[int, int]]:
    """(i, j) of a Gram product: rows of one block, of adjacent lengths, counts at most two apart (squared)."""
    block_a, counts_a, longer_a = left
    block_b, counts_b, longer_b = right or left
    norm_a, norm_b = (counts_a * counts_a).sum(1), (counts_b * counts_b).sum(1)
    close = norm_a[:, None] + norm_b[None, :] - 2 * (counts_a @ counts_b.T) <= 2
    close &= block_a[:, None] == block_b[None, :]
    close &= ~(longer_a[:, None] & longer_b[None, :])
    if right is None:
        close = np.triu(close, 1)
    return list(zip(*(x.tolist() for x in np.nonzero(close)), strict=True))


def _tiles(starts: list[int], size: int) -> Iterator[tuple[int, int]]:
    """Tiles of whole blocks with at most ``size`` rows, a larger block by itself."""
    first = 0
    for at in range(1, len(starts)):
        if starts[at] - starts[first] > size and at - 1 > first:
            yield starts[first], starts[at - 1]
            first = at - 1
    if len(starts) > 1:
        yield starts[first], starts[-1]


def near_in_blocks(key: np.ndarray, m: np.ndarray, part: np.ndarray, words: list[str], size: int = PART, tile: int = TILE) -> list[tuple[int, int]]:
    """Pairs of row numbers of near words, rows being sorted so that the rows of a block follow each other."""
    if not words:
        return []
    new = np.r_[True, (key[1:] != key[:-1]) | (m[1:] != m[:-1]) | (part[1:] != part[:-1])]
    starts, block = [*np.flatnonzero(new).tolist(), len(words)], np.cumsum(new)
    found = []

    def side(a: int, b: int) -> tuple:
        chunk = words[a:b]
        return block[a:b], letter_counts(chunk), np.array([len(w) for w in chunk]) > m[a:b]

    for lo, hi in _tiles(starts, tile):
        cuts = list(range(lo, hi, tile))
        sides = [(a, side(a, min(a + tile, hi))) for a in cuts]
        for x, (a, left) in enumerate(sides):
            for b, right in sides[x:]:
                for i, j in _tile_pairs(left, None if a == b else right):
                    at = one_edit_at(words[a + i], words[b + j])
                    if at >= 0:
                        start, end = parts(int(m[a + i]), size)[part[a + i]]
                        if start <= at < end or at == end == m[a + i]:
                            found.append((a + i, b + j))
    return found


def _near(size: int):
    """Sorted block rows -> both directions of every near pair; the last block of a batch waits for the next."""
    names = ["_key", "_m", "_part", "word", "n"]

    def solve(rows: pa.RecordBatch) -> pa.RecordBatch:
        key, m, part = (rows.column(i).to_numpy() for i in range(3))
        pairs = near_in_blocks(key, m, part, rows.column(3).to_pylist(), size)
        a = pa.array([p[0] for p in pairs], pa.int64())
        b = pa.array([p[1] for p in pairs], pa.int64())
        here, there = pa.concat_arrays([a, b]), pa.concat_arrays([b, a])
        word, n = rows.column(3), rows.column(4)
        return pa.RecordBatch.from_arrays([word.take(here), word.take(there), n.take(there)], ["word", "near", "near_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if waiting is None else [waiting, batch.rename_columns(names)]).combine_chunks()
            rows = table.to_batches()[0].rename_columns(names)
            key = rows.column(0).to_numpy()
            last = int(np.searchsorted(key, key[-1]))
            waiting = rows.slice(last)
            if last:
                yield solve(rows.slice(0, last))
        if waiting is not None:
            yield solve(waiting)

    return run


def near_words(words: DataFrame, part: int = PART, hot: int = HOT_BLOCK) -> DataFrame:
    """(word, near, near_n): both directions of every pair of near words of ``words`` (word, n)."""
    schema = "_key long, _m int, _part int, word string, n long"
    rows = words.select("word", "n").mapInArrow(_block_rows(part), schema)
    large = stage(rows.groupBy("_key", "_m", "_part").count().filter(F.col("count") > hot).select("_key", "_m", "_part"), "hot-blocks")
    block = ["_key", "_m", "_part"]
    if not large.isEmpty():
        large = broadcast_if_small(large)
        split = rows.join(large, block, "left_semi").select(*rows.columns).mapInArrow(_position_rows(part), schema)
        rows = rows.join(large, block, "left_anti").select(*rows.columns).unionByName(split)
    ordered = rows.repartition(*block).sortWithinPartitions(*block)
    return ordered.mapInArrow(_near(part), "word string, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): ends of the chains of ``forms`` (word, form), by pointer doubling."""
    now = stage(forms.select("word", F.col("form").alias("root")), "spelling-chains")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        if now.join(further, "root", "left_semi").isEmpty():
            return now
        now = stage(now.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "spelling-chains")


def variants(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """``words`` (word, n) with form, root, n_near and form_n.

    ``form`` is the near word of largest n (ties: smallest in code-point order) if its n is at least
    ``ratio`` times the word's, else NULL; ``root`` follows the forms to the last, the word itself without
    one.  No words, no rows.
    """
    words = stage(words, "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("neg"), F.col("near"))).alias("_best")
    links = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    linked = stage(words.join(links, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                   F.when(-F.col("_best.neg") >= ratio * F.col("n"), F.col("_best")).alias("_form")), "spelling-links")
    roots = _roots(linked.filter(F.col("_form").isNotNull()).select("word", F.col("_form.near").alias("form")))
    return linked.join(roots, "word", "left").select(
        "word", F.col("_form.near").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near",
        (-F.col("_form.neg")).alias("form_n"))
