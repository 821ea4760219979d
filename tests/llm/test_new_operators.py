"""Pattern packing, spelling variants and conversation repair against brute force."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from xxhash import xxh64_intdigest

from clicklake.llm import conversation_repair, pattern_packing, spelling
from clicklake.llm.common import prepare
from clicklake.llm.queries import QUERIES
from test_edges import CLASHING, LONG, ROWS

SF_SMALL = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")


# ---------------------------------------------------------------------------- op11

def _check_pieces(pieces, texts, length, end_id=2):
    """Every id of every document in one piece, sequences gapless and not over full; returns the sequences."""
    tokenizer = Tokenizer.from_file(BYTES)
    expected = Counter()
    for doc, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]
        first = len(ids) % length or length
        cuts = [0, *range(min(first, len(ids)), len(ids) + 1, length)]
        for i, (a, b) in enumerate(itertools.pairwise(cuts)):
            expected[doc, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    got = Counter((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces)
    assert got == expected
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return len(sequences), sum(p["length"] for p in pieces)


def test_op11_pattern_packing(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    pieces = QUERIES["op11_pattern_packing"](spark, SF_SMALL).collect()
    used, tokens = _check_pieces(pieces, [tuple(r) for r in docs.select("doc_id", "text").collect()], 1024)
    assert used <= 1.05 * -(-tokens // 1024)


def test_op11_edges(spark):
    prepare(spark)
    df = spark.createDataFrame(ROWS, "doc_id long, text string").select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])
    out = pattern_packing.pack_patterns(df, BYTES, length=64).withColumn("ids_crc32", F.crc32("ids"))
    _check_pieces(out.collect(), ROWS, 64)
    assert pattern_packing.pack_patterns(df.limit(0), BYTES).count() == 0


@pytest.mark.parametrize("sizes", [[600] * 10, [512] * 7, [1] * 5000, [1023, 1, 700, 324, 300, 24], list(range(1, 1024))])
def test_op11_plans_use_every_piece_once(sizes):
    counts = np.bincount(sizes, minlength=1025)
    packs = pattern_packing.plan(counts)
    used = Counter()
    for shape, times in packs:
        assert sum(shape) <= 1024 and times > 0
        for v in shape:
            used[v] += times
    assert used == Counter(sizes)
    large = sum(s > 512 for s in sizes)
    assert sum(t for _, t in packs) <= max(-(-sum(sizes) // 1024), large) + 1


def test_op11_long_special_and_odd_texts():
    enc, tokenizer = pattern_packing.encoder(BYTES), Tokenizer.from_file(BYTES)
    for text in ["", "<|endoftext|> x", "\0  it's\n\n  9.5", "日本語 ñandú \U0001f600", "a" * 3000, LONG[:5000]]:
        assert np.frombuffer(enc.text(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


# ---------------------------------------------------------------------------- op12

def _words(rows, least=7, every=31):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{low}".encode())
            if h % every == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            counts[low] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= 2}


def _variants(words):
    by_gap = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            by_gap[i, w[:i] + w[i + 1:]].add(w)
    near = defaultdict(set)
    for (_, rest), group in by_gap.items():
        for a in group:
            near[a] |= group - {a}
            if rest in words:
                near[a].add(rest)
                near[rest].add(a)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 10 * n:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def test_op12_spelling_variants(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_spelling_variants"](spark, SF_SMALL)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == _variants(_words(rows)) and got.count() == len(_words(rows))


def test_op12_chains_ties_and_hot_blocks(spark):
    prepare(spark)
    words = {"abcdefg": 2, "abcdefgh": 20, "abcdefgi": 20, "abcdefghj": 400, "xbcdefghj": 4000, "zzzzzzz": 2, "ÿÿÿÿÿÿÿ": 3, "ÿÿÿÿÿÿÿÿ": 30}
    words |= {f"pre{a}{b}{c}fixed": 2 + ord(a) % 3 for a in "abcdefgh" for b in "abcdefgh" for c in "abcd"}
    words |= {f"pre{a}{b}fixed": 30 for a in "abc" for b in "abc"}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {tuple(r) for r in spelling.variants(df).collect()} == _variants(words)
    near = spelling.near_words(df, hot=4).collect()
    expected = {(r[0], r[1]) for r in spelling.near_words(df).collect()}
    assert len(near) == len({(r[0], r[1]) for r in near}) and {(r[0], r[1]) for r in near} == expected


def test_op12_edges(spark):
    prepare(spark)
    rows = [*ROWS, (20, "Señalización señalizacion SEÑALIZACION"), (21, "señalización, señalizacion"), (None, "letters letters lettrs letterss ×÷×÷×÷×÷")]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(i).alias(c) for i, c in enumerate(["word", "n", *CLASHING])])
    got = spelling.variants(spelling.vocabulary(df, damage_every=31))
    assert {tuple(r) for r in got.collect()} == {(w, f, r, n, k, m) for w, f, r, n, k, m in _variants(_words(rows))}
    assert spelling.variants(spelling.vocabulary(df.limit(0))).count() == 0


# ---------------------------------------------------------------------------- op13

def _damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        kept = out[conv]
        if h == 1:
            text = ""
        elif h == 2:
            text = re.sub("[.!?]", "", text)
        elif h == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return {c: _ordered(r) for c, r in out.items()}


def _ordered(rows):
    def signed(text):
        h = xxh64_intdigest(text.encode(), seed=42)
        return h - (1 << 64) if h >> 63 else h
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), signed(r[2])))


def _brute(rows):
    """Plain forward program over (row, state): least (cost, audit) with the repaired rows."""
    kinds, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        kinds.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    names = {"s": "system", "u": "user", "a": "assistant"}
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def relax(found, key, value):
        if key not in found or value < found[key]:
            found[key] = value

    def inserts(found):
        for _ in range(4):
            for last, (cost, audit, out) in list(found.items()):
                for role in follows[last].replace("s", ""):
                    relax(found, role, (cost + 3, audit + "I", (*out, f"{names[role]}:")))

    inserts(best)
    for (_, role, text), kind in zip(rows, kinds, strict=True):
        found = {}
        for last, (cost, audit, out) in best.items():
            relax(found, last, (cost + 4, audit + "D", out))
            if kind in ("", "truncated"):
                extra = 3 if kind else 0
                if role[:1] and role[0] in follows[last]:
                    relax(found, role[0], (cost + extra, audit + "K", (*out, f"{role}:{text}")))
                for other in follows[last].replace("s", ""):
                    relax(found, other, (cost + 3 + extra, audit + "R", (*out, f"{names[other]}:{text}")))
        inserts(found)
        best = found
    cost, audit, out = min(best[k] for k in ("", "a") if k in best)
    turns = [t for t, _, _ in rows if t is not None]
    firsts = [r[1][:1] for r in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:])), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def _results(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_op13_conversation_repair(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = sorted(((c, *_brute(r)) for c, r in _damage(rows).items()), key=str)
    assert _results(QUERIES["op13_conversation_repair"](spark, SF_SMALL)) == expected


def _random_rows(n, convs, seed):
    rng = np.random.default_rng(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No!", "cut off", " \t", "", None, "What? ", "Fine\n."]
    return [(None if c == 0 else int(c), None if t == 0 else int(t), roles[r], texts[x])
            for c, t, r, x in zip(rng.integers(0, convs, n), rng.integers(0, n, n), rng.integers(0, len(roles), n), rng.integers(0, len(texts), n))]


@pytest.mark.parametrize(("n", "convs", "block"), [(400, 60, 1024), (600, 4, 7), (300, 1, 16)])
def test_op13_random_conversations_in_any_cut(spark, monkeypatch, n, convs, block):
    prepare(spark)
    monkeypatch.setattr(conversation_repair, "BLOCK_ROWS", block)
    rows = _random_rows(n, convs, n)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select("*", F.lit(1).alias("_conv"), F.lit("x").alias("audit"))
    expected = sorted(((c, *_brute(r)) for c, r in _damage(rows).items()), key=str)
    assert _results(conversation_repair.repair(conversation_repair.damaged(df))) == expected


def test_op13_edges(spark):
    prepare(spark)
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 5, "system", LONG), (2, None, None, None), (2, None, None, None), (3, 1, "user", "Hi."), (3, 2, "assistant", LONG + "."), (4, 7, "tool", "x")]
    plain = conversation_repair.repair(conversation_repair.as_rows(spark.createDataFrame(rows, schema)))
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((t, " " if r is None else r, " " if x is None else x))
    assert _results(plain) == sorted(((c, *_brute(_ordered(r))) for c, r in convs.items()), key=str)
    assert conversation_repair.repair(conversation_repair.damaged(spark.createDataFrame([], schema))).count() == 0


def test_op13_walk_keeps_the_least_initials():
    rng = np.random.default_rng(5)
    for n in [0, 1, 2, 3, 10, 50]:
        for _ in range(40):
            roles = [["system", "user", "assistant", "x"][i] for i in rng.integers(0, 4, n)]
            texts = [["a.", "b!", "c", " "][i] + "!" * int(k) for i, k in zip(rng.integers(0, 4, n), rng.integers(0, 50, n))]
            rows = [(i, r, t) for i, (r, t) in enumerate(zip(roles, texts, strict=True))]
            assert conversation_repair._solved([r[0] for r in rows], roles, texts) == _brute(rows)
