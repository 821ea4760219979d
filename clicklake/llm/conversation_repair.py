"""Conversation structure repair: square-root checkpointed dynamic program over cheapest edits.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``.  Cheapest edits make it so:
keep, rerole, delete or insert rows; of equally cheap ones the edits whose initials (D, I, K, R) are least
in ASCII order.  The cost to finish from a row is a vector over the four states of that grammar.

* Walking forward needs those vectors in reverse order.  ``walk`` stores them only at every square root of
  the rows, and recomputes one stretch at a time while it emits the tight edits.
* Rows are range-partitioned by (conversation, turn), so that a conversation of any size is cut into
  *blocks* of at most ``BLOCK_ROWS`` rows.  A conversation inside one block is solved where it lies.
* The blocks of the others are summed up as 4 x 4 min-plus matrices, computed in parallel.  A
  backward scan of the matrices gives the cost vector at every block's end, the checkpoints; a forward
  scan of "state in -> state out" gives the state each block starts in; then all blocks are walked in parallel.
  Scans stream in the order of the blocks and hold one vector.  Repeated rows are found by an aggregate over
  128-bit digests, the hash of the repaired text is fed block by block.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

BLOCK_ROWS = 1024
BLOCK_CHARS = 4_000_000
# Costs of the edits, and of a truncated row that stays.
DELETE, INSERT, REROLE, KEPT_TRUNCATED = 4, 3, 3, 3
# States: 0 start, 1 after a system row, 2 after a user row, 3 after an assistant row (0 and 3 may end).
STATES = range(4)
NEXT = (2, 2, 3, 2)
EXPECTED = ("user", "user", "assistant", "user")
KEEPS = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
AT_END = (0, 2 * INSERT, INSERT, 0)
LEGAL_PAIRS = {"su", "ua", "au"}
FINE, TRUNCATED, DOOMED = range(3)
_CLASSES = "sua"
STATS = ["blank", "duplicate", "truncated", "illegal"]


# ---------------------------------------------------------------------------- the dynamic program

def symbol(role: str, kind: int) -> int:
    """All the program needs of a row: the class of its role's initial and its kind."""
    return (_CLASSES.find(role[0]) % 4 if role else 3) * 3 + kind


def _choices(sym: int, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, state after) of the edits that use up a row, in ASCII order."""
    initial, kind = "sua-"[sym // 3], sym % 3
    out = [("D", DELETE, state)]
    if kind != DOOMED:
        extra = KEPT_TRUNCATED if kind == TRUNCATED else 0
        if (initial, state) in KEEPS:
            out.append(("K", extra, KEEPS[initial, state]))
        out.append(("R", REROLE + extra, NEXT[state]))
    return out


CHOICES = [[_choices(sym, q) for q in STATES] for sym in range(12)]
_STEPS: dict[tuple[int, tuple], tuple] = {}


def backward(sym: int, after: tuple) -> tuple:
    """Costs to finish before a row, from those after it; inserts may come first.

    Vectors less their least value are few, so the steps between them are remembered.
    """
    base = min(after)
    key = (sym, tuple(v - base for v in after))
    step = _STEPS.get(key)
    if step is None:
        use = [min(cost + key[1][q] for _, cost, q in CHOICES[sym][state]) for state in STATES]
        step = tuple(min(use[q], INSERT + use[NEXT[q]], 2 * INSERT + use[NEXT[NEXT[q]]]) for q in STATES)
        _STEPS[key] = step
    return tuple(v + base for v in step)


def walk(symbols: bytes, after: tuple, state: int, emit=None) -> int:
    """State after the rows, walking the tight edits of least initials; ``emit(initial, row, state before, cost)``.

    ``after`` is the cost vector behind the last row.  Backward vectors are kept at every square root of
    the rows only; the stretch between two of them is recomputed when the walk comes to it.
    """
    n = len(symbols)
    width = math.isqrt(n) + 1
    checkpoints, now = {n: after}, after
    for at in range(n - 1, -1, -1):
        now = backward(symbols[at], now)
        if at % width == 0:
            checkpoints[at] = now
    for first in range(0, n, width):
        last = min(first + width, n)
        vectors = [checkpoints[last]]
        for at in range(last - 1, first - 1, -1):
            vectors.append(backward(symbols[at], vectors[-1]))
        vectors.reverse()
        for at in range(first, last):
            here, there = vectors[at - first], vectors[at - first + 1]
            while True:
                goal, choices = here[state], CHOICES[symbols[at]][state]
                if choices[0][1] + there[state] == goal:
                    edit, cost, then = choices[0]
                elif INSERT + here[NEXT[state]] == goal:
                    if emit:
                        emit("I", -1, state, INSERT)
                    state = NEXT[state]
                    continue
                else:
                    edit, cost, then = next(c for c in choices[1:] if c[1] + there[c[2]] == goal)
                if emit:
                    emit(edit, at, state, cost)
                state = then
                break
    return state


def matrix(symbols: bytes) -> list[int]:
    """Least cost from each state before the rows to each state after them, row by row (16 numbers)."""
    far = 1 << 40
    out = []
    for goal in STATES:
        now = tuple(0 if q == goal else far for q in STATES)
        for sym in reversed(symbols):
            now = backward(sym, now)
        out.append(now)
    return [out[goal][q] for q in STATES for goal in STATES]


class Repair:
    """Edits of a block: audit, cost, and the repaired rows as ``role:text``."""

    def __init__(self, roles: list[str], texts: list[str]):
        self.roles, self.texts = roles, texts
        self.audit: list[str] = []
        self.rows: list[str] = []
        self.cost = 0

    def __call__(self, edit: str, at: int, state: int, cost: int) -> None:
        self.audit.append(edit)
        self.cost += cost
        if edit == "I":
            self.rows.append(f"{EXPECTED[state]}:")
        elif edit != "D":
            self.rows.append(f"{EXPECTED[state] if edit == 'R' else self.roles[at]}:{self.texts[at]}")

    def finish(self, state: int) -> None:
        """The inserts that a legal end still needs."""
        while AT_END[state]:
            self("I", -1, state, INSERT)
            state = NEXT[state]


# ---------------------------------------------------------------------------- rows

def _is_blank(text: str) -> bool:
    return not text.strip(" \t\n\x0b\x0c\r")


def _digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{role}\0{text}".encode("utf-8", "surrogatepass"), digest_size=16, person=len(role).to_bytes(8, "big")).digest()


def faults(roles: list[str], texts: list[str], seen_before: list[bool]) -> tuple[bytes, list[int]]:
    """Symbols of the rows, and how many are blank, duplicate and truncated (the first of these that applies)."""
    symbols, counts = bytearray(), [0, 0, 0]
    for role, text, seen in zip(roles, texts, seen_before, strict=True):
        kind = FINE
        if _is_blank(text):
            kind, counts[0] = DOOMED, counts[0] + 1
        elif seen:
            kind, counts[1] = DOOMED, counts[1] + 1
        elif text.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?":
            kind, counts[2] = TRUNCATED, counts[2] + 1
        symbols.append(symbol(role, kind))
    return bytes(symbols), counts


def _illegal(roles: list[str], before: str | None = None) -> int:
    firsts = [*([] if before is None else [before]), *(r[:1] for r in roles)]
    return sum(a + b not in LEGAL_PAIRS for a, b in zip(firsts, firsts[1:]))


def _gaps(low, high, distinct: int) -> int:
    return 0 if low is None else high - low + 1 - distinct


def damaged(conversations: DataFrame, every: int = 20) -> DataFrame:
    """(_conv, _turn, _role, _text, _gone, _copy): faults put in by crc32(``conv_id:turn``) modulo ``every``.

    0 marks the row as gone, 1 empties the text, 2 takes out its ``[.!?]``, 3 repeats the row, 4 makes it a
    user row.  NULL fields read as one space.
    """
    def read(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    h = F.crc32(F.concat(read("conv_id"), F.lit(":"), read("turn"))) % every
    text = F.when(h == 1, F.lit("")).when(h == 2, F.regexp_replace(read("text"), "[.!?]", "")).otherwise(read("text"))
    return conversations.select(
        F.col("conv_id").alias("_conv"), F.col("turn").cast("long").alias("_turn"), F.when(h == 4, F.lit("user")).otherwise(read("role")).alias("_role"),
        text.alias("_text"), (h == 0).alias("_gone"), F.explode(F.sequence(F.lit(1), F.when(h == 3, 2).otherwise(1))).alias("_copy"))


def as_rows(conversations: DataFrame) -> DataFrame:
    """The rows as they are, in the columns of ``damaged``."""
    return conversations.select(
        F.col("conv_id").alias("_conv"), F.col("turn").cast("long").alias("_turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("_role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("_text"), F.lit(False).alias("_gone"), F.lit(1).alias("_copy"))


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_RESULT_NAMES = ["gaps", *STATS, "cost", "audit", "repaired_sha256"]
_RAW_NAMES = ["_turns", "_roles", "_texts"]


def _solved(turns: list, roles: list[str], texts: list[str]) -> tuple:
    """The result of a conversation that lies in one block."""
    seen: set[bytes] = set()
    before = []
    for role, text in zip(roles, texts, strict=True):
        d = _digest(role, text)
        before.append(d in seen)
        seen.add(d)
    symbols, counts = faults(roles, texts, before)
    done = Repair(roles, texts)
    done.finish(walk(symbols, AT_END, 0, done))
    known = [t for t in turns if t is not None]
    gaps = _gaps(min(known), max(known), len(set(known))) if known else 0
    sha = hashlib.sha256("\n".join(done.rows).encode("utf-8", "surrogatepass")).hexdigest()
    return gaps, *counts, _illegal(roles), done.cost, "".join(done.audit), sha


def _cut(conv_type: pa.DataType):
    """Sorted rows -> blocks: solved ones with their result, the parts of a longer conversation with their rows."""
    kinds = {**dict.fromkeys(_RESULT_NAMES[:6], pa.int64()), "audit": pa.string(), "repaired_sha256": pa.string(),
             "_turns": pa.list_(pa.int64()), "_roles": pa.list_(pa.string()), "_texts": pa.list_(pa.string())}

    def pack(blocks: list[dict]) -> pa.RecordBatch:
        columns = [pa.array([b["conv"] for b in blocks], conv_type), pa.array([b["part"] for b in blocks], pa.int32()),
                   pa.array([b["block"] for b in blocks], pa.int64()), pa.array([b["whole"] for b in blocks], pa.bool_())]
        solved = [_solved(b["turns"], b["roles"], b["texts"]) if b["whole"] else (None,) * 8 for b in blocks]
        columns += [pa.array([s[i] for s in solved], kinds[c]) for i, c in enumerate(_RESULT_NAMES)]
        columns += [pa.array([None if b["whole"] else b[c[1:]] for b in blocks], kinds[c]) for c in _RAW_NAMES]
        return pa.RecordBatch.from_arrays(columns, ["_conv", "_part", "_block", "_whole", *_RESULT_NAMES, *_RAW_NAMES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ready: list[dict] = []
        open_block: dict | None = None
        first, held = True, 0

        def close(ends: bool) -> None:
            nonlocal number
            open_block.update(part=part, block=number, whole=open_block["starts"] and ends)
            number += 1
            ready.append(open_block)

        def begin(conv, starts: bool) -> dict:
            return {"conv": conv, "starts": starts, "turns": [], "roles": [], "texts": [], "chars": 0}

        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(5))
            for conv, turn, role, text, gone in zip(*columns, strict=True):
                if open_block is None or conv != open_block["conv"]:
                    if open_block is not None:
                        close(True)
                    open_block = begin(conv, not first)
                    first = False
                elif len(open_block["roles"]) >= BLOCK_ROWS or open_block["chars"] >= BLOCK_CHARS:
                    close(False)
                    open_block = begin(conv, False)
                if not gone:
                    open_block["turns"].append(turn)
                    open_block["roles"].append(role)
                    open_block["texts"].append(text)
                    open_block["chars"] += len(text)
                    held += len(text)
                if len(ready) >= 512 or held >= 2 * BLOCK_CHARS and ready:
                    yield pack(ready)
                    ready, held = [], 0
        if open_block is not None:
            close(False)
            yield pack(ready)

    return run


# ---------------------------------------------------------------------------- conversations of more than one block

_BLOCK = ["_part", "_block"]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["_conv", "_part", "_block", "_at", "_digest"]
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            roles, texts = one.column(3)[0].as_py(), one.column(4)[0].as_py()
            n = len(roles)
            again = pa.array([0] * n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(one.column(i).take(again) for i in range(3)), pa.array(range(n), pa.int32()),
                 pa.array([_digest(r, t) for r, t in zip(roles, texts, strict=True)], pa.binary())], names)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the places of their first occurrences -> symbols, matrices and what counts need at the borders."""
    for batch in batches:
        out: list[list] = [[] for _ in range(10)]
        for row in batch.to_pylist():
            new = set(row["_new"] or ())
            roles, known = row["_roles"], [t for t in row["_turns"] if t is not None]
            symbols, counts = faults(roles, row["_texts"], [i not in new for i in range(len(roles))])
            values = (symbols, matrix(symbols), *counts, _illegal(roles), [roles[0][:1], roles[-1][:1]] if roles else None,
                      min(known, default=None), max(known, default=None), len(set(known)))
            for column, value in zip(out, values, strict=True):
                column.append(value)
        kinds = [pa.binary(), pa.list_(pa.int64()), *[pa.int64()] * 4, pa.list_(pa.string()), *[pa.int64()] * 3]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *(pa.array(v, k) for v, k in zip(out, kinds, strict=True))],
                                         ["_conv", *_BLOCK, "_symbols", "_matrix", *STATS, "_ends", "_low", "_high", "_turns"])


def _scan(step, start, out_type: pa.DataType, name: str):
    """Streams (conv, part, block, value): each block gets the carried value, which ``step`` then moves on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, carried, begun = None, start, False
        for batch in batches:
            out = []
            for c, value in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if not begun or c != conv:
                    conv, carried, begun = c, start, True
                out.append(carried)
                carried = step(value, carried)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(out, out_type)], [*_BLOCK, name])

    return run


def _through(costs: list[int], after) -> list[int]:
    return [min(costs[4 * q + r] + after[r] for r in STATES) for q in STATES]


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [[walk(symbols, tuple(after), q) for q in STATES]
               for symbols, after in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(out, pa.list_(pa.int64()))], ["_conv", *_BLOCK, "_exits"])


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            done = Repair(row["_roles"], row["_texts"])
            state = walk(row["_symbols"], tuple(row["_after"]), row["_state"], done)
            if row["_is_last"]:
                done.finish(state)
            rows.append(("".join(done.audit), "\n".join(done.rows), len(done.rows), done.cost))
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))],
                                         ["_conv", *_BLOCK, "_audit", "_repaired", "_n", "_cost"])


def _combined(conv_type: pa.DataType):
    """Streams the blocks of each conversation in order into one result; the hash is fed block by block."""
    kinds = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None

        def close() -> pa.RecordBatch:
            values = (now["conv"], _gaps(now["low"], now["high"], now["turns"]), *now["stats"], now["cost"], "".join(now["audit"]), now["sha"].hexdigest())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["_conv", *_RESULT_NAMES])

        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["_conv"] != now["conv"]:
                    if now is not None:
                        yield close()
                    now = {"conv": row["_conv"], "low": None, "high": None, "turns": 0, "stats": [0] * 4, "cost": 0, "audit": [],
                           "sha": hashlib.sha256(), "rows": 0, "role": None}
                now["stats"] = [a + row[c] for a, c in zip(now["stats"], STATS, strict=True)]
                if row["_ends"] is not None:
                    if now["role"] is not None:
                        now["stats"][3] += now["role"] + row["_ends"][0] not in LEGAL_PAIRS
                    now["role"] = row["_ends"][1]
                if row["_low"] is not None:
                    now["turns"] += row["_turns"] - (now["high"] == row["_low"])
                    now["low"] = row["_low"] if now["low"] is None else now["low"]
                    now["high"] = row["_high"]
                now["cost"] += row["_cost"]
                now["audit"].append(row["_audit"])
                if row["_n"]:
                    now["sha"].update((("\n" if now["rows"] else "") + row["_repaired"]).encode("utf-8", "surrogatepass"))
                    now["rows"] += row["_n"]
        if now is not None:
            yield close()

    return run


def _in_order(df: DataFrame, descending: bool = False) -> DataFrame:
    places = [F.col(c).desc() if descending else F.col(c) for c in _BLOCK]
    return df.repartition("_conv").sortWithinPartitions("_conv", *places)


def _long(blocks: DataFrame, kind: str, conv_type: pa.DataType) -> DataFrame:
    """Results of the conversations whose rows lie in more than one block, or at the edge of a partition."""
    key = f"_conv {kind}, _part int, _block long"
    found = blocks.select("_conv", *_BLOCK, "_roles", "_texts").mapInArrow(_digests, f"{key}, _at int, _digest binary")
    firsts = found.groupBy("_conv", "_digest").agg(F.min(F.struct(*_BLOCK, "_at")).alias("_first"))
    new = firsts.groupBy(F.col("_first._part").alias("_part"), F.col("_first._block").alias("_block")).agg(F.collect_list("_first._at").alias("_new"))
    stats = "_symbols binary, _matrix array<long>, " + "".join(f"{c} long, " for c in STATS) + "_ends array<string>, _low long, _high long, _turns long"
    sums = stage(blocks.select("_conv", *_BLOCK, "_roles", "_texts", "_turns").join(new, _BLOCK, "left")
                 .select("_conv", *_BLOCK, "_roles", "_texts", "_turns", "_new").mapInArrow(_summaries, f"{key}, {stats}"), "conversation-blocks")
    ends = stage(_in_order(sums.select("_conv", *_BLOCK, "_matrix"), True)
                 .mapInArrow(_scan(_through, list(AT_END), pa.list_(pa.int64()), "_after"), "_part int, _block long, _after array<long>"), "conversation-ends")
    exits = (sums.join(ends, _BLOCK).select("_conv", *_BLOCK, "_symbols", "_after").mapInArrow(_exits, f"{key}, _exits array<long>"))
    states = (_in_order(exits).mapInArrow(_scan(lambda leads, q: leads[q], 0, pa.int32(), "_state"), "_part int, _block long, _state int"))
    last = sums.groupBy("_conv").agg(F.max(F.struct(*_BLOCK)).alias("_last")).select("_last.*", F.lit(True).alias("_is_last"))
    walked = (blocks.select("_conv", *_BLOCK, "_roles", "_texts").join(sums.select(*_BLOCK, "_symbols"), _BLOCK).join(ends, _BLOCK)
              .join(states, _BLOCK).join(last, _BLOCK, "left")
              .select("_conv", *_BLOCK, "_roles", "_texts", "_symbols", "_after", "_state", F.coalesce("_is_last", F.lit(False)).alias("_is_last"))
              .mapInArrow(_edited, f"{key}, _audit string, _repaired string, _n long, _cost long"))
    both = walked.join(sums.drop("_conv", "_symbols", "_matrix"), _BLOCK)
    return _in_order(both).mapInArrow(_combined(conv_type), f"_conv {kind}, {RESULT}")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (``as_rows`` or ``damaged``): conv_id, gaps, faults, cost, audit, repaired_sha256.

    Rows of a conversation are taken by turn, NULL turns first; rows of one turn by role, then by a hash of
    the text, repeated rows next to each other.  Rows with a NULL conv_id are one conversation.  A
    conversation without rows (all gone) has zeros, an empty audit and the hash of an empty text.  An empty
    table gives no rows.  Other columns are not read.
    """
    field = rows.schema["_conv"]
    kind = field.dataType.simpleString()
    conv_type = pa.string() if kind == "string" else pa.int64() if kind == "bigint" else pa.int32()
    placed = rows.withColumn("_h", F.xxhash64("_text")).withColumn("_row", F.monotonically_increasing_id())
    order = [F.col("_conv"), F.col("_turn").asc_nulls_first(), F.col("_role"), F.col("_h"), F.col("_row")]
    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    raw = "_turns array<long>, _roles array<string>, _texts array<string>"
    blocks = stage(ranged.select("_conv", "_turn", "_role", "_text", "_gone").mapInArrow(
        _cut(conv_type), f"_conv {kind}, _part int, _block long, _whole boolean, {RESULT}, {raw}"), "conversation-cuts")
    whole = blocks.filter("_whole").select("_conv", *_RESULT_NAMES)
    return whole.unionByName(_long(blocks.filter("NOT _whole"), kind, conv_type)).withColumnRenamed("_conv", "conv_id")
