"""Best-fit packing by non-negative least squares over length patterns.

A document of more tokens than a sequence holds is cut into whole sequences after a first piece with the
rest; every other document is one piece.  What has to be packed is then a histogram of piece lengths, whose
size is the sequence length, whatever the number of documents:

1. One map tokenises every text and stages the ids with the rank of the piece among its task's pieces of
   the same length.  The histogram comes from the staged table.
2. The patterns of two or three lengths that fill a sequence exactly are enumerated, and their repeat
   counts are fitted to the histogram by non-negative least squares (an active-set method that
   takes in several patterns a round).  A share of the counts is rounded and held to what the histogram has.
3. The lengths left over are packed largest first, each with the best filling of its free space (a subset
   sum over the lengths left); a filling is repeated as often as the counts allow, so the work does not
   grow with the corpus.
4. A piece's global rank among its length (task offset plus rank in the task) falls into the range of one
   pattern slot, which gives its sequence and offset by arithmetic.  No document moves.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, offsets_by_part, slices, stage, text_of

SEQUENCE_TOKENS = 1024
END_ID = 2
ID_BYTES = 4
# Documents of an enumerated pattern, and rounds and patterns a round of the fit.
PATTERN_DOCUMENTS = 3
FIT_ROUNDS = 24
FIT_BATCH = 64
# Shares of the fitted repeats that are tried: what stays is a mix of all lengths that packs well.
FIT_SHARES = (1.0, 0.8, 0.6, 0.4, 0.2)


# ---------------------------------------------------------------------------- token ids

class ByteEncoder:
    """Ids of a byte-level BPE file, merged by tiktoken (ids are merge ranks in such a file).

    Texts that hold one of the file's special tokens go through the tokenizer itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        byte = {c: b for b, c in enumerate(_byte_alphabet())}
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.encoding = tiktoken.Encoding("byte_bpe", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def text(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a text."""
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


# Fixed value: how the byte-level tokenizer cuts a text before merging.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_alphabet() -> list[str]:
    """The printable stand-in of every byte: itself if printable, else the next code point from 256 on (by rule)."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


_ENCODERS: dict[str, ByteEncoder] = {}


def encoder(path: str) -> ByteEncoder:
    """One encoder per Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteEncoder(path)
    return _ENCODERS[path]


def _tokenise(path: str, end_id: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end, part = encoder(path), np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId()
        seen, whole = [0] * (length + 1), 0
        for batch in slices(batches, 512):
            ids = [enc.text(t) + end for t in batch.column(1).to_pylist()]
            rests, ranks, wholes, before = [], [], [], []
            for x in ids:
                full, rest = divmod(len(x) // ID_BYTES, length)
                rests.append(rest)
                ranks.append(seen[rest])
                wholes.append(full)
                before.append(whole)
                seen[rest] += 1
                whole += full
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(ids), pa.int32()), pa.array(rests, pa.int32()), pa.array(ranks, pa.int64()),
                 pa.array(wholes, pa.int64()), pa.array(before, pa.int64()), pa.array(ids, pa.binary())],
                ["_id", "_part", "_rest", "_rank", "_wholes", "_wholes_before", "_ids"])

    return run


# ---------------------------------------------------------------------------- patterns

def patterns(lengths: list[int], length: int, most: int = PATTERN_DOCUMENTS) -> np.ndarray:
    """Patterns of 2 to ``most`` (at most 3) of ``lengths`` that sum up to ``length``, padded by 0, longest first."""
    have = np.zeros(length + 1, bool)
    have[lengths] = True
    out = []
    for a in sorted(lengths, reverse=True):
        rest = length - a
        if 0 < rest <= a and have[rest]:
            out.append(np.array([[a, rest, 0]]))
        if most >= 3:
            b = np.arange((rest + 1) // 2, min(a, rest - 1) + 1)
            b = b[have[b] & have[rest - b]]
            out.append(np.stack([np.full(len(b), a), b, rest - b], 1))
    return np.concatenate(out) if out else np.empty((0, 3), np.int64)


def fit(shapes: np.ndarray, counts: np.ndarray, rounds: int = FIT_ROUNDS, batch: int = FIT_BATCH) -> dict[int, float]:
    """{pattern: repeats >= 0} that bring the lengths used close to ``counts`` (least squares).

    Active-set NNLS: each round takes in up to ``batch`` patterns of steepest descent without a common
    length, solves the passive set and drops the patterns whose repeats turn negative.
    """
    if not len(shapes):
        return {}
    scale = max(int(counts.max()), 1)
    target = counts / scale
    target[0] = 0
    passive, x = np.empty(0, np.int64), np.empty(0)

    def columns(chosen: np.ndarray) -> np.ndarray:
        a = np.zeros((len(counts), len(chosen)))
        for slot in range(shapes.shape[1]):
            a[shapes[chosen, slot], np.arange(len(chosen))] += 1
        a[0] = 0
        return a

    for _ in range(rounds):
        pull = (target - columns(passive) @ x)[shapes].sum(1)
        pull[passive] = 0
        taken, used = [], np.zeros(len(counts), bool)
        for p in np.argsort(-pull, kind="stable")[:40 * batch]:
            if pull[p] <= 1e-9 or len(taken) == batch:
                break
            own = shapes[p][shapes[p] > 0]
            if not used[own].any():
                used[own] = True
                taken.append(p)
        if not taken:
            break
        passive = np.r_[passive, np.array(taken, np.int64)]
        x = np.zeros(len(passive))
        while len(passive):
            a = columns(passive)
            x = np.linalg.solve(a.T @ a + 1e-9 * np.eye(len(passive)), a.T @ target)
            if x.min() > 0:
                break
            passive, x = passive[x > 0], x[x > 0]
    return {int(p): float(v) * scale for p, v in zip(passive, x, strict=True)}


def _filling(left: np.ndarray, space: int) -> list[int]:
    """Lengths, longest first, that fill ``space`` best (largest possible sum) with the pieces ``left``."""
    reach, before = 1, []
    for size in range(min(space, len(left) - 1), 0, -1):
        times = min(int(left[size]), space // size)
        for _ in range(times):
            before.append((size, reach))
            reach = (reach | reach << size) & ((1 << space + 1) - 1)
            if reach >> space & 1:
                break
        if reach >> space & 1:
            break
    at, out = reach.bit_length() - 1, []
    for size, earlier in reversed(before):
        if not earlier >> at & 1:
            out.append(size)
            at -= size
    return sorted(out, reverse=True)


def _packed(counts: np.ndarray, fitted: list[tuple[list[int], float]], share: float) -> list[tuple[tuple[int, ...], int]]:
    """The given share of the fitted repeats, rounded and held to ``counts``; then the lengths left over."""
    left, out = counts.copy(), []
    for shape, repeats in fitted:
        times = min(round(repeats * share), *(int(left[v]) // shape.count(v) for v in shape))
        if times > 0:
            for v in shape:
                left[v] -= times
            out.append((tuple(shape), times))
    for size in range(len(counts) - 1, 0, -1):
        while left[size] > 0:
            left[size] -= 1
            shape = [size, *_filling(left, len(counts) - 1 - size)]
            left[size] += 1
            times = min(int(left[v]) // shape.count(v) for v in set(shape))
            for v in shape:
                left[v] -= times
            out.append((tuple(shape), times))
    return out


def plan(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """[(pattern, repeats)] that use exactly ``counts`` (index: length) and fill as few sequences as they can.

    Taking all fitted repeats leaves lengths that pack badly among themselves; of the ``FIT_SHARES`` tried,
    the one with the fewest sequences stays.
    """
    length = len(counts) - 1
    shapes = patterns(np.flatnonzero(counts[:length]).tolist(), length)
    fitted = sorted(fit(shapes, counts).items(), key=lambda x: (-x[1], x[0]))
    rows = [([int(v) for v in shapes[p] if v], repeats) for p, repeats in fitted]
    return min((_packed(counts, rows, share) for share in FIT_SHARES), key=lambda packs: sum(times for _, times in packs))


def slots(packs: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """{length: (first rank, first sequence, offset) of every slot}, slots in the order of their ranks."""
    out: dict[int, tuple[list, list, list]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for shape, times in packs:
        offset = 0
        for size in shape:
            rows = out.setdefault(size, ([], [], []))
            rows[0].append(ranks.get(size, 0))
            rows[1].append(sequence)
            rows[2].append(offset)
            ranks[size] = ranks.get(size, 0) + times
            offset += size
        sequence += times
    return {size: tuple(np.array(v, np.int64) for v in rows) for size, rows in out.items()}


def _placing(table: dict):
    @F.pandas_udf("sequence long, offset long")
    def place(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sizes, ranks = size.to_numpy(), rank.to_numpy()
        sequence, offset = np.full(len(sizes), -1, np.int64), np.zeros(len(sizes), np.int64)
        for s in np.unique(sizes).tolist():
            if s:
                first, base, at = table[s]
                rows = np.flatnonzero(sizes == s)
                slot = np.searchsorted(first, ranks[rows], "right") - 1
                sequence[rows] = base[slot] + ranks[rows] - first[slot]
                offset[rows] = at[slot]
        return pd.DataFrame({"sequence": sequence, "offset": offset})

    return place


# ---------------------------------------------------------------------------- operator

def pack_patterns(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  length: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Pieces: ``id_col``, piece, start, length, ids (little-endian unsigned 32-bit), sequence_id, offset.

    Every row is a document of its own, rows with equal or NULL ids too; NULL and empty texts are the end
    id alone.  Sequences are numbered without gaps, packed ones first, then the whole pieces of long
    documents.  An empty table gives no pieces.  Other columns are not read.
    """
    slim = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    kind = slim.schema["_id"].dataType.simpleString()
    rows = stage(slim.mapInArrow(_tokenise(tokenizer_path, end_id, length),
                                 f"_id {kind}, _part int, _rest int, _rank long, _wholes long, _wholes_before long, _ids binary"), "pattern-ids")
    per_task = stage(rows.filter("_rest > 0").groupBy("_part", "_rest").agg(F.count(F.lit(1)).alias("_n")), "pattern-histogram")
    counts = np.zeros(length + 1, np.int64)
    for size, n in per_task.groupBy("_rest").agg(F.sum("_n")).collect():   # at most a row per length
        counts[size] = n
    packs = plan(counts)
    packed = sum(times for _, times in packs)
    ranks = broadcast_if_small(offsets_by_part(per_task, "_part", "_n", "_base", "_rest").select("_part", "_rest", "_base"))
    tasks = rows.groupBy("_part").agg(F.sum("_wholes").alias("_w"))           # one row per task
    wholes = F.broadcast(offsets_by_part(tasks, "_part", "_w", "_whole_base").select("_part", "_whole_base"))
    size = F.lit(length).cast("long")
    placed = (rows.join(ranks, ["_part", "_rest"], "left").join(wholes, "_part")
              .withColumn("_at", _placing(slots(packs))("_rest", F.coalesce("_base", F.lit(0).cast("long")) + F.col("_rank")))
              .withColumn("_first", (F.col("_rest") > 0).cast("int")))

    def piece(i):
        partial = (i == 0) & (F.col("_first") == 1)
        start = F.when(partial, F.lit(0).cast("long")).otherwise(F.col("_rest") + (i - F.col("_first")) * size)
        n = F.when(partial, F.col("_rest").cast("long")).otherwise(size)
        whole = F.lit(packed).cast("long") + F.col("_whole_base") + F.col("_wholes_before") + i - F.col("_first")
        return F.struct(i.cast("int").alias("piece"), start.alias("start"), n.alias("length"),
                        F.substring(F.col("_ids"), (start * ID_BYTES + 1).cast("int"), (n * ID_BYTES).cast("int")).alias("ids"),
                        F.when(partial, F.col("_at.sequence")).otherwise(whole).alias("sequence_id"),
                        F.when(partial, F.col("_at.offset")).otherwise(F.lit(0).cast("long")).alias("offset"))

    pieces = placed.select("_id", F.explode(F.transform(F.sequence(F.lit(0), (F.col("_first") + F.col("_wholes") - 1).cast("int")), piece)).alias("p"))
    return pieces.select(F.col("_id").alias(id_col), "p.*")
