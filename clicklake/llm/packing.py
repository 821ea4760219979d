"""Packing by concatenate and cut: every token gets a global offset, fixed windows cut the stream.

1. Pass one tokenises every text once and stages (task, running token count inside the task, ids).
2. The per-task totals -- one row per task -- are turned into prefix sums.
3. Pass two adds the two numbers, which gives each document its global offset, and cuts it where the
   offset crosses a multiple of the sequence length.  A document on a boundary becomes several
   boundary records; no token is padding except after the very last one.

Both passes are maps over the documents; nothing but the totals is shuffled, so neither a hot source
nor a very long text meets a single task.  The staged table fixes the order, so a lost executor
re-reads it and gets the same offsets.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import offsets_by_part, slices, stage, text_of

SEQUENCE_TOKENS = 2048
END_ID = 1
# Entries that a worker keeps of encoded words and of encoded letter runs; a full cache starts afresh.
MAX_CACHED = 100_000
ID_BYTES = 4

# Characters of a plain word's tail that are one unit of their own.
_TAIL = ".,!?;:"


class WordEncoder:
    """Ids of a word-level BPE file, word by word with a bounded cache.

    The tokenizer normalises (NFC, lower case), drops white space and splits the rest into units that
    never span white space, so a text's ids are the concatenation of its words' ids; each unit is
    encoded by the tokenizer's own model.  A word outside the plain form goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.byte_chars = {ord(c): self._byte_char(c) for c in map(chr, range(256))}
        self.words: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}

    def _byte_char(self, latin: str) -> str:
        """Printable stand-in of a byte, as the byte-level alphabet has it (by rule)."""
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = ord(latin)
        return latin if byte in shown else chr(256 + byte - sum(b < byte for b in shown))

    def _unit(self, unit: str) -> bytes:
        ids = self.units.get(unit)
        if ids is None:
            if len(self.units) >= MAX_CACHED:
                self.units.clear()
            shown = unit.encode().decode("latin-1").translate(self.byte_chars)
            ids = self.units[unit] = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        return ids

    def word(self, word: str) -> bytes:
        low = unicodedata.normalize("NFC", word).replace("Σ", "σ").lower()
        core = low.rstrip(_TAIL)
        if core.isalpha():
            return self._unit(core) + (self._unit(low[len(core):]) if len(core) < len(low) else b"")
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def text(self, text: str) -> bytes:
        """Little-endian 32-bit ids of a text."""
        known, out = self.words, []
        if len(known) >= MAX_CACHED:
            known.clear()
        for w in _words(text):
            ids = known.get(w)
            if ids is None:
                ids = known[w] = self.word(w)
            out.append(ids)
        return b"".join(out)


def _words(text: str) -> list[str]:
    """The text cut at white space; U+001C to U+001F are none to the tokenizer, though Python says so."""
    return re.split(r"[ \t-\r]+", text) if re.search(r"[\x1c-\x1f]", text) else text.split()


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _tokenise(path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end, part, done = encoder(path), array("I", [end_id]).tobytes(), TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            ids = [enc.text(t) + end for t in batch.column(1).to_pylist()]
            counts = [len(x) // ID_BYTES for x in ids]
            before = []
            for n in counts:
                before.append(done)
                done += n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(ids), pa.int32()), pa.array(before, pa.int64()),
                 pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                ["_id", "_part", "_before", "_tokens", "_ids"])

    return run


def tokenised(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = END_ID) -> DataFrame:
    """Pass one, staged: (_id, _part, _before, _tokens, _ids) with ids as little-endian 32-bit words."""
    slim = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    kind = slim.schema["_id"].dataType.simpleString()
    return stage(slim.mapInArrow(_tokenise(tokenizer_path, end_id),
                                 f"_id {kind}, _part int, _before long, _tokens long, _ids binary"), "token-ids")


def _padded(tokens: Column, length: int) -> Column:
    """Length of a sequence once padded: a power of two needs no padding, all others go up to ``length``."""
    return F.when(F.bit_count(tokens) == 1, tokens).otherwise(F.lit(length).cast("long"))


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         length: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Pieces of fixed-length sequences: ``id_col``, start, length, ids, doc_tokens, sequence_id, offset, padded_length.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit words.  Every row is a document
    of its own, rows with equal or NULL ids too; NULL and empty texts are the end id alone.  An empty
    table gives no pieces.  Other columns are not read.
    """
    rows = tokenised(docs, tokenizer_path, id_col, text_col, end_id)
    totals = rows.groupBy("_part").agg(F.sum("_tokens").alias("_total"))  # one row per task of pass one
    base = offsets_by_part(totals, "_part", "_total", "_base")
    whole = totals.agg(F.sum("_total").alias("_all"))
    base = base.select("_part", "_base").join(F.broadcast(whole))
    first = F.col("_base") + F.col("_before")
    size = F.lit(length).cast("long")

    def piece(seq: Column) -> Column:
        start = F.greatest(seq * size - F.col("_first"), F.lit(0).cast("long"))
        end = F.least((seq + 1) * size - F.col("_first"), F.col("_tokens"))
        ids = F.substring(F.col("_ids"), (start * ID_BYTES + 1).cast("int"), ((end - start) * ID_BYTES).cast("int"))
        return F.struct(seq.alias("sequence_id"), start.alias("start"), (end - start).alias("length"), ids.alias("ids"))

    cut = (rows.join(F.broadcast(base), "_part").withColumn("_first", first)
           .withColumn("_last", F.floor((F.col("_first") + F.col("_tokens") - 1) / size))
           .select("_id", "_tokens", "_first", "_all", F.explode(F.transform(
               F.sequence(F.floor(F.col("_first") / size), "_last"), piece)).alias("p")))
    used = F.least(size, F.col("_all") - F.col("p.sequence_id") * size)
    return cut.select(
        F.col("_id").alias(id_col), F.col("p.start").alias("start"), F.col("p.length").alias("length"),
        F.col("p.ids").alias("ids"), F.col("_tokens").alias("doc_tokens"), F.col("p.sequence_id").alias("sequence_id"),
        F.pmod(F.col("_first") + F.col("p.start"), size).alias("offset"), _padded(used, length).alias("padded_length"))
