"""SentencePiece encoding with seeded merge-dropout, and decoding.

Encoding follows the model's merge rules: the agenda holds every neighbouring pair that forms a piece,
the best score (then the leftmost) is merged first.  With ``dropout`` a candidate merge taken from the
agenda is skipped when a keyed hash of (seed, text, place, span) falls under the rate, so every occurrence
of a word draws on its own, the same seed always gives the same segmentation and other seeds give others;
every segmentation consists of pieces of the model and decodes to the very text.

No piece holds a space mark after another character nor a line break, so a text is cut into chunks
(space marks with the word after them) that are encoded alone.  Short chunks are merged many at a time, a merge of
each a step, by arrays.  A chunk's encoding with nothing skipped is remembered with the spans of its merges: an
occurrence takes it where its hashes skip none of these spans and is merged anew where they skip one.
Longer chunks are encoded one by one.
Both directions are maps: no shuffle, and a worker's memory is bounded by its cache.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from hashlib import blake2b
from heapq import heapify, heappop, heappush
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_of

DROPOUT = 0.1
SEED = 17
# Longer chunks are encoded one by one.
MAX_REMEMBERED = 16
# Chunks that a worker remembers; a full cache starts afresh.
MAX_NODES = 200_000
# Chunks merged and drawn at once.
STEP = 16_384

# The space mark of the piece format.
MARK = "▁"
_CHUNK = re.compile(r" *[^ \n▁]+| +|\n|▁")
_MASK = (1 << 64) - 1
_SPAN, _PLACE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
# Rank of a pair that forms no piece: more than any other, and times 32 within 32 bits.
NO_RANK = (1 << 26) - 1


class PieceModel:
    """Pieces, scores and byte pieces of a SentencePiece model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.ids: dict[str, int] = {}
        self.cost: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.text: list[bytes] = [b""] * size
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value], self.text[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i)):
                self.ids[piece], self.cost[piece] = i, -model.get_score(i)
                self.text[i] = piece.replace(MARK, " ").encode()

    def symbols(self, symbol: str) -> list[int]:
        """Id of a piece, or the byte pieces of a symbol that is none."""
        found = self.ids.get(symbol)
        return [found] if found is not None else [self.bytes[b] for b in symbol.replace(MARK, " ").encode()]


def segment(chunk: str, cost: dict[str, float], skip=None) -> list[str]:
    """Symbols of a chunk after all merges; ``skip(start, size)`` may refuse a candidate merge."""
    part, n = list(chunk), len(chunk)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda = [(c, i, i + 1, 2) for i in range(n - 1) if (c := cost.get(part[i] + part[i + 1])) is not None]
    heapify(agenda)
    while agenda:
        _, i, j, size = heappop(agenda)
        if not part[i] or j >= n or not part[j] or after[i] != j or len(part[i]) + len(part[j]) != size:
            continue  # one of the two has been merged since
        if skip is not None and skip(i, size):
            continue
        part[i], part[j] = part[i] + part[j], ""
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y < n and (c := cost.get(part[x] + part[y])) is not None:
                heappush(agenda, (c, x, y, len(part[x]) + len(part[y])))
    return [p for p in part if p]


def chunks_of(text: str) -> list[str]:
    """The chunks of a text with a space put before it: what ``_CHUNK`` finds, by plain splits where words are one space apart."""
    out: list[str] = []
    for n, line in enumerate((" " + text).split("\n") if text else ()):
        if n:
            out.append("\n")
        if "  " in line or MARK in line:
            out += _CHUNK.findall(line)
        else:
            first, *words = line.split(" ")
            if first:
                out.append(first)
            out += [" " + w for w in words]
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer of the values of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mixed_one(x: int) -> int:
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
    return x ^ (x >> 31)


class Symbols:
    """Codes of a model's symbols (pieces, and characters as they are met) and the merges between them, as arrays.

    Code 0 is no symbol, code 1 stands for a chunk that is encoded alone.
    """

    def __init__(self, model: PieceModel):
        self.model, self.count = model, 0
        self.known: dict[str, int] = {}
        self.ids, self.width = np.zeros((1 << 16, 4), np.int32), np.ones(1 << 16, np.int64)
        self.of_char = np.zeros(0x110000, np.int32)
        self._add([0]), self._add([0])
        for piece in model.ids:
            self.code(piece)
        rank = {c: r for r, c in enumerate(sorted(set(model.cost.values())))}
        pairs = [(a << 32 | b, rank[cost], self.known[piece]) for piece, cost in model.cost.items() for cut in range(1, len(piece))
                 if (a := self._part(piece[:cut])) and (b := self._part(piece[cut:]))]
        self.of_char[ord(" ")] = self.code(MARK)
        # The mark as a character of the text: bytes, so that it isn't read as a space.
        self.of_char[ord(MARK)] = self._add([model.bytes[b] for b in MARK.encode()])
        self._table(*(np.array(x, kind) for x, kind in zip(zip(*pairs), (np.uint64, np.int32, np.int32))) if pairs
                    else (np.empty(0, kind) for kind in (np.uint64, np.int32, np.int32)))

    def _add(self, ids: list[int]) -> int:
        if self.count == len(self.width):
            self.ids, self.width = np.concatenate([self.ids, np.zeros_like(self.ids)]), np.concatenate([self.width, np.ones_like(self.width)])
        self.ids[self.count, :len(ids)], self.width[self.count] = ids, len(ids)
        self.count += 1
        return self.count - 1

    def code(self, symbol: str) -> int:
        if symbol not in self.known:
            self.known[symbol] = self._add(self.model.symbols(symbol))
        return self.known[symbol]

    def _part(self, symbol: str) -> int:
        return self.code(symbol) if len(symbol) == 1 else self.known.get(symbol, 0)

    def _table(self, keys: np.ndarray, ranks: np.ndarray, codes: np.ndarray) -> None:
        """Open addressing over the pairs, at most a quarter full."""
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.key = np.zeros(1 << bits, np.uint64)
        self.rank, self.merged = np.full(1 << bits, NO_RANK, np.int32), np.zeros(1 << bits, np.int32)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = left[self.key[at[left]] == 0]
            slot, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.key[slot], self.rank[slot], self.merged[slot] = keys[placed], ranks[placed], codes[placed]
            left = np.setdiff1d(left, placed)
            at[left] = (at[left] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(_SPAN)) >> self.shift).astype(np.int64)

    def merge(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, code) of what neighbouring symbols form; ``NO_RANK`` where that is no piece."""
        key = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        at = self._slot(key)
        found = self.key[at]
        hit = found == key
        on = np.flatnonzero(~hit & (found != 0))
        while len(on):
            at[on] = (at[on] + 1) & self.mask
            found = self.key[at[on]]
            hit[on] = found == key[on]
            on = on[(found != key[on]) & (found != 0)]
        return np.where(hit, self.rank[at], np.int32(NO_RANK)), self.merged[at]

    def of_text(self, text: str) -> np.ndarray:
        """Codes of the text's characters."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.of_char[points]
        if not codes.all():
            for point in np.unique(points[codes == 0]).tolist():
                self.of_char[point] = self.code(chr(point))
            codes = self.of_char[points]
        return codes


def merged_chunks(chunks: list[str], symbols: Symbols, bases: np.ndarray | None = None, limit: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """``segment`` of many short chunks at once, a merge of each a step: (chunk, place) codes of the symbols left (0: none
    there) and, in the order of the merges, their spans (start * 32 + size; 0: no more).

    With ``bases`` a candidate merge is skipped when its hash falls under ``limit``.
    """
    n, places = len(chunks), MAX_REMEMBERED + 2  # no symbol stands before the first character or after the last
    lengths = np.fromiter(map(len, chunks), np.int64, n)
    codes = symbols.of_text("".join(chunks))
    owner = np.repeat(np.arange(n), lengths)
    at = (np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + 1) * n + owner
    part, form = np.zeros(places * n, np.int32), np.zeros(places * n, np.int32)
    cost = np.full(places * n, NO_RANK * 32, np.int32)  # rank * 32 + place: the least is the best, then the leftmost
    after, before = np.repeat(np.arange(1, places + 1), n), np.repeat(np.arange(-1, places - 1), n)
    part[at] = codes
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    ranks, made = symbols.merge(codes[inner], codes[inner + 1])
    cost[at[inner]], form[at[inner]] = ranks * 32 + at[inner] // n, made
    spans, step = np.zeros((n, MAX_REMEMBERED), np.uint16), 0
    while True:
        least = cost.reshape(places, n).min(0)
        rows = np.flatnonzero(least < NO_RANK * 32)
        if not len(rows):
            break
        place = (least[rows] & 31).astype(np.int64)
        x = place * n + rows
        y = after[x] * n + rows
        end = after[y]
        span = (place - 1) * 32 + end - place
        if bases is None:
            spans[rows, step] = span
        else:
            skipped = mixed(bases[rows] + span.astype(np.uint64) * np.uint64(_SPAN)) >> np.uint64(32) < limit
            cost[x[skipped]] = NO_RANK * 32
            go = ~skipped
            rows, place, x, y, end = rows[go], place[go], x[go], y[go], end[go]
        joined = form[x]
        part[x], part[y], cost[y], after[x] = joined, 0, NO_RANK * 32, end
        z, first = end * n + rows, before[x]
        before[z] = place
        w = first * n + rows
        ranks, made = symbols.merge(np.concatenate([part[w], joined]), np.concatenate([joined, part[z]]))
        both = np.concatenate([w, x])
        cost[both], form[both] = ranks * 32 + np.concatenate([first, place]), made
        step += 1
    return part.reshape(places, n)[1:-1].T, spans


class Encoder:
    """Encodes texts under one seed and dropout rate; remembers its chunks."""

    def __init__(self, model: PieceModel, seed: int, dropout: float):
        self.model, self.dropout = model, dropout
        self.limit = int(dropout * (1 << 32))
        self.key = blake2b(str(seed).encode(), digest_size=16).digest()
        self.symbols = Symbols(model)
        self.known: dict[str, int] = {}
        # Of every remembered chunk, and in row 0 of one that is encoded alone: ``merged_chunks`` with nothing skipped.
        size = MAX_NODES + 2 * STEP + 1
        self.parts, self.spans = np.zeros((size, MAX_REMEMBERED), np.int32), np.zeros((size, MAX_REMEMBERED), np.uint16)
        self.parts[0, 0] = 1

    def bases(self, text: str, n: int) -> np.ndarray:
        """What the skips of each of the text's ``n`` chunks are drawn from: a keyed hash of (seed, text, place)."""
        own = blake2b(text.encode("utf-8", "surrogatepass"), key=self.key, digest_size=8).digest()
        return mixed(np.frombuffer(own, "<u8") + np.arange(n, dtype=np.uint64) * np.uint64(_PLACE))

    def drawn(self, chunk: str, base: int) -> bytes:
        """Ids of one occurrence of a chunk, encoded alone."""
        if chunk == MARK:
            return array("i", [self.model.bytes[b] for b in MARK.encode()]).tobytes()
        unit = 32 if len(chunk) <= MAX_REMEMBERED else 1 << 32
        parts = segment(chunk.replace(" ", MARK), self.model.cost,
                        lambda start, size: mixed_one((base + (start * unit + size) * _SPAN) & _MASK) >> 32 < self.limit)
        return array("i", [i for p in parts for i in self.model.symbols(p)]).tobytes()

    def _rows(self, chunks: list[str]) -> np.ndarray:
        """Rows of the chunks in the cache, which gets those it lacks; 0 for long ones."""
        if len(self.known) >= MAX_NODES:
            self.known.clear()
        rows = np.fromiter(map(self.known.get, chunks, repeat(-1)), np.int64, len(chunks))
        absent = np.flatnonzero(rows < 0).tolist()
        new = list(dict.fromkeys([c for i in absent if len(c := chunks[i]) <= MAX_REMEMBERED]))
        if new:
            first = len(self.known) + 1
            self.parts[first:first + len(new)], self.spans[first:first + len(new)] = merged_chunks(new, self.symbols)
            self.known.update(zip(new, range(first, first + len(new))))
        rows[absent] = [self.known.get(chunks[i], 0) for i in absent]
        return rows

    def _resolve(self, chunks: list[str], rows: np.ndarray, bases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the occurrences, one after another, and where each one's begin (and the last one's end).

        What the cache holds stands where none of its merges is skipped; the others are merged anew.
        """
        parts = self.parts[rows]
        if self.limit:
            spans = self.spans[rows]
            owner, place = np.nonzero(spans)
            skipped = mixed(bases[owner] + spans[owner, place] * np.uint64(_SPAN)) >> np.uint64(32) < self.limit
            again = np.zeros(len(rows), bool)
            again[owner[skipped]] = True
            again = np.flatnonzero(again)
            if len(again):
                parts[again] = merged_chunks([chunks[i] for i in again.tolist()], self.symbols, bases[again], self.limit)[0]
        there = parts > 0
        codes, ends = parts[there], np.cumsum(there.sum(1))
        width = self.symbols.width[codes]
        alone = [np.frombuffer(self.drawn(chunks[i], int(bases[i])), "<i4") for i in np.flatnonzero(rows == 0).tolist()]
        places = np.flatnonzero(codes == 1)
        width[places] = [len(x) for x in alone]
        starts = np.concatenate([[0], np.cumsum(width)])
        ids = np.repeat(self.symbols.ids[codes, 0], width)
        for k in range(1, 4):
            more = np.flatnonzero((width > k) & (codes != 1))
            ids[starts[more] + k] = self.symbols.ids[codes[more], k]
        for i, own in zip(places.tolist(), alone, strict=True):
            ids[starts[i]:starts[i + 1]] = own
        return ids, starts[np.concatenate([[0], ends])]

    def texts(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of every text; the empty text has none."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting, bases, owners = [], [], []

        def flush() -> None:
            if waiting:
                at, (ids, starts) = 0, self._resolve(waiting, self._rows(waiting), np.concatenate(bases))
                for t, n in owners:
                    out[t].append(ids[starts[at]:starts[at + n]].astype("<i4").tobytes())
                    at += n
            waiting.clear(), bases.clear(), owners.clear()

        for t, text in enumerate(texts):
            chunks = chunks_of(text)
            own = self.bases(text, len(chunks))
            for lo in range(0, len(chunks), STEP):
                part = chunks[lo:lo + STEP]
                waiting += part
                bases.append(own[lo:lo + STEP])
                owners.append((t, len(part)))
                if len(waiting) >= STEP:
                    flush()
        flush()
        return [b"".join(x) for x in out]


_MODELS: dict[str, PieceModel] = {}
_ENCODERS: dict[tuple, Encoder] = {}


def model(path: str) -> PieceModel:
    """One model per Python worker and file."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encoder(path: str, seed: int, dropout: float) -> Encoder:
    key = (path, seed, dropout)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(model(path), seed, dropout)
    return _ENCODERS[key]


def decode(ids, own: PieceModel) -> str:
    """The text of the ids: pieces and bytes joined, without the one space put before the text."""
    return b"".join(map(own.text.__getitem__, ids))[1:].decode("utf-8", "surrogatepass")


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     seed: int = SEED, dropout: float = DROPOUT) -> DataFrame:
    """``id_col``, ids (array of int), text_sha256 of every row's whole text.

    NULL and empty texts have no ids.  Equal texts get equal ids under one seed, whatever their id, so
    repeated rows agree.  ``dropout=0`` gives the model's own segmentation.  Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model_path, seed, dropout)
        for batch in slices(batches):
            ids = enc.texts(batch.column(1).to_pylist())
            ends = np.cumsum([0] + [len(x) // 4 for x in ids], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, batch.column(2)], ["_id", "ids", "text_sha256"])

    text = text_of(text_col)
    slim = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.sha2(text, 256).alias("_sha"))
    kind = slim.schema["_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"_id {kind}, ids array<int>, text_sha256 string").withColumnRenamed("_id", id_col)


def decode_documents(encoded: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the decoded text as ``text_col``; NULL ids give NULL."""
    at, kinds = encoded.columns.index(ids_col), [(f.name, f.dataType.simpleString()) for f in encoded.schema.fields]
    names = [n for n, _ in kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(model_path)
        for batch in slices(batches):
            texts = [decode(x.values.to_numpy(zero_copy_only=False).tolist(), own) if x.is_valid else None for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, text_col])

    return encoded.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in kinds) + f", `{text_col}` string")
