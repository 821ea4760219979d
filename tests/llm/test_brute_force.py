"""Operators against brute force, exact round trips and held-out accuracy over the small tables."""

import collections
import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest

from clicklake.llm import fingerprints, license_scan, line_dedup, near_dedup, packing, piece_codec, queries, sharding, toxicity
from clicklake.llm.common import prepare
from clicklake.llm.edit_distance import within
from clicklake.llm.shingles import shingle_set

SF = "/root/testdata/sf0.001"
SF_LABELS = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_toxicity_on_the_held_out_fold(spark):
    rows = queries.op1_toxicity(spark, SF_LABELS)
    labels = spark.read.parquet(f"{SF_LABELS}/labels.parquet")
    held = rows.join(labels, "doc_id").filter("held_out").collect()
    assert held and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert all((r.score >= 0.5) == bool(r.predicted) and 0 <= r.score <= 1 for r in held)
    hit = sum(r.predicted and r.toxic for r in held)
    assert hit / sum(r.toxic for r in held) > 0.8 and hit / sum(r.predicted for r in held) > 0.95


def test_factors_learn_an_interaction():
    """A pair of words is toxic, each alone is not: only the pairwise part can tell."""
    rng = random.Random(3)
    texts, labels = [], []
    for _ in range(3000):
        words = [f"filler{rng.randrange(40)}" for _ in range(12)]
        a, b = rng.random() < 0.5, rng.random() < 0.5
        texts.append(" ".join(words + ["xqgroup"] * a + ["zvslur"] * b))
        labels.append(int(a and b))
    model = toxicity.fit(texts[:2400], labels[:2400], epochs=30)
    rows = toxicity._Rows(model.terms)
    right = 0
    for t, y in zip(texts[2400:], labels[2400:], strict=True):
        hit = {r for w in toxicity.words_of(t) for r in rows[w]}
        right += (model.raw(np.array(sorted(hit), dtype=int)) >= 0) == bool(y)
    assert right / 600 > 0.97


def test_fingerprint_selection_and_guarantee(spark, docs):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(i, t) for i, t in docs.items()], "doc_id long, text string")
    grams = {r.doc_id: r.g for r in df.select("doc_id", fingerprints.gram_hashes(fingerprints.words(F.col("text"))).alias("g")).collect()}
    w = fingerprints.WINDOW
    for r in fingerprints.fingerprints(df).collect():
        g = grams[r.doc_id]
        want = []
        for i in range(max(1, len(g) - w + 1)) if g else ():
            window = g[i:i + w]
            at = max(j for j, x in enumerate(window) if x == min(window)) + i
            if not want or want[-1] != at:
                want.append(at)
        assert r.fingerprint == " ".join(f"{g[p]:x}@{p}" for p in want), r.doc_id
    # A shared run of w + k - 1 words always shares a selected hash.
    run = " ".join(f"shared{i}" for i in range(w + fingerprints.GRAM_WORDS - 1))
    two = spark.createDataFrame([(1, "left one two " + run + " x y z p q"), (2, "other words before it " + run + " and other words after")], "doc_id long, text string")
    a, b = ({m.split("@")[0] for m in r.fingerprint.split()} for r in fingerprints.fingerprints(two).collect())
    assert a & b


def test_edited_texts(spark, docs):
    rows = queries.op3_fingerprints(spark, SF).collect()
    order = sorted(docs)
    following = dict(zip(order, order[1:] + order[:1], strict=True))
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r.doc_id]
        q = len(text) // 4
        edited = text[:len(text) - q] + docs[following[r.doc_id]][:q]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = ({m.split("@")[0] for m in f.split()} for f in (r.fingerprint, r.edited_fingerprint))
        assert abs(r.near_edited - (len(a & b) / len(a | b) if a | b else 1.0)) < 1e-12
    assert np.mean([r.near_edited for r in rows]) > 0.4 > 10 * np.mean([r.near_next for r in rows])


def _components(texts, percent=85):
    sets = {d: (lambda w: frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())(t.encode().lower().split())
            for d, t in texts.items()}
    parent = {d: d for d in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in texts}


def _star(seed=5, copies=60, size=120):
    """An original and edited copies that are near it but mostly not near each other, plus pairs and chains."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(10**6)}"
    base = [word() for _ in range(size)]
    texts = {0: " ".join(base)}
    for i in range(1, copies):
        w = list(base)
        at = rng.randrange(size - 3)
        for j in range(rng.choice((1, 2, 3))):
            w[at + j] = word()
        texts[i] = " ".join(w)
    chain = [word() for _ in range(size)]
    for i in range(copies, copies + 12):
        chain[rng.randrange(size)] = word()
        texts[i] = " ".join(chain)
    for i in range(copies + 12, copies + 40):
        texts[i] = " ".join(word() for _ in range(rng.randrange(0, 60)))
    return texts


def test_near_duplicates_against_all_pairs(spark, docs):
    for texts in (docs, _star()):
        want = _components(texts)
        df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect()}
        assert got == {d: (n, c, c == d) for d, (n, c) in want.items()}


def test_chunked_blobs_give_the_same_components(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOB_MEMBERS", 7)
    texts = _star(seed=9)
    want = _components(texts)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df).collect()}
    assert got == {d: c for d, (_, c) in want.items()}


def test_exact_links_against_all_pairs():
    texts = _star(seed=21, copies=40)
    sets = [shingle_set(t) for t in texts.values()]
    sets = [s for s in sets if len(s)]
    roots = near_dedup.Sets(len(sets))
    for i, j in near_dedup.exact_links(sets):
        shared = len(np.intersect1d(sets[i], sets[j]))
        assert 100 * shared >= 85 * (len(sets[i]) + len(sets[j]) - shared)
        roots.join(i, j)
    for i in range(len(sets)):
        for j in range(i):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if 100 * shared >= 85 * (len(sets[i]) + len(sets[j]) - shared):
                assert roots.root(i) == roots.root(j)


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer

    texts = dict(docs)
    texts[10**6] = "It's <|endoftext|> a\x1cb ÀÉ Σας… 12,5 don't"
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {d: tok.encode(t, add_special_tokens=False).ids + [1] for d, t in texts.items()}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    rows = packing.pack(df, public_tokenizers.path("word_bpe_49k.json")).collect()
    got, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: r.start):
        ids = list(struct.unpack(f"<{r.length}I", bytes(r.ids)))
        assert r.doc_tokens == len(want[r.doc_id]) and r.start == len(got[r.doc_id])
        got[r.doc_id] += ids
        sequences[r.sequence_id].append((r.offset, r.length, r.padded_length))
    assert got == want
    total = sum(map(len, want.values()))
    assert sorted(sequences) == list(range(-(-total // 2048)))
    for s, pieces in sequences.items():
        end = 0
        for offset, length, _ in sorted(pieces):
            assert offset == end
            end += length
        assert end == (2048 if s < max(sequences) else (total - 1) % 2048 + 1)
        assert {p for _, _, p in pieces} == {end if end & (end - 1) == 0 else 2048}


def test_piece_codec(spark, docs):
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = SentencePieceProcessor(model_file=path)
    texts = [*docs.values(), "  two  spaces\n\nand lines ", "▁ mark ▁▁", "日本 😀", "", "<s> <0x41>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plain = {r.doc_id: r.ids for r in piece_codec.encode_documents(df, path, dropout=0.0).collect()}
    assert all(plain[i] == sp.encode(t) for i, t in enumerate(texts) if "▁" not in t)
    seen = []
    for seed in (1, 2):
        enc = piece_codec.encode_documents(df, path, seed=seed, dropout=0.2)
        rows = piece_codec.decode_documents(enc, path).collect()
        assert {r.doc_id: r.decoded for r in rows} == dict(enumerate(texts))
        again = {r.doc_id: r.ids for r in piece_codec.encode_documents(df.repartition(3), path, seed=seed, dropout=0.2).collect()}
        seen.append(again)
        assert again == {r.doc_id: r.ids for r in rows}
    assert sum(a != b for a, b in zip(seen[0].values(), [seen[1][k] for k in seen[0]], strict=True)) > len(docs) * 0.9
    assert sum(map(len, seen[0].values())) > 1.05 * sum(map(len, plain.values()))


def test_license_alignment():
    t = license_scan.TEMPLATES["mit-permission"]
    words = t.split()
    scanner = license_scan.Scanner(license_scan.TEMPLATES, 0.8)
    edited = " ".join(words[:20] + ["inserted", "words"] + words[24:60] + ["CHANGED"] + words[61:])
    text = "some code before\n" + t + "\n" + "x = 1 # filler words here\n" * 30 + edited + " the end"
    found = [m for m in scanner.scan(text) if m[0] == "mit-permission"]
    assert len(found) == 2 and found[0][4] == 1.0 and 0.9 < found[1][4] < 1.0
    assert found[0][1] == 3 and found[0][2] == 3 + len(license_scan.words_of(t)) - 1
    assert scanner.scan("the license of this work is the work of the version") == []
    a, b = list("abcXdefYgh"), list("abQcdZefgh")
    pairs = license_scan.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs) and pairs == sorted(set(pairs)) and len(pairs) == 8
    assert len(license_scan.longest_increasing([3, 1, 4, 1, 5, 9, 2, 6])) == 4


def test_license_lines_are_found(spark, docs):
    names = {r.doc_id: r.license for r in queries.op7_license_scan(spark, SF).collect()}
    lines = {d for d, t in docs.items() if "Licensed under the Apache License, Version 2.0." in t or "Released under the MIT License." in t}
    assert lines and lines <= set(names)


def _line_edits(words):
    """Stated on its own: one word edit from 4 words on, one more every 48 words, at most 3."""
    return 0 if words < 4 else min(1 + words // 48, 3)


def _plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _near_lines(x, y):
    a, b = x.encode().split(), y.encode().split()
    most = _line_edits(min(len(a), len(b)))
    if not most or abs(len(a) - len(b)) > most or sum(((collections.Counter(a) - collections.Counter(b)) | (collections.Counter(b) - collections.Counter(a))).values()) > 2 * most:
        return False
    return _plain_distance(a, b) <= most


def _kept_text(docs):
    earlier, out = {}, {}
    for d in sorted(docs):
        left = []
        for line in docs[d].split("\n"):
            if len(line) >= line_dedup.MIN_CHARS and line.strip(" \t\n\r\x0b\x0c"):
                stays = line not in earlier and not any(_near_lines(x, line) for x in earlier)
                earlier[line] = True
                if not stays:
                    continue
            left.append(line)
        out[d] = "\n".join(left)
    return out


def test_one_word_edits_are_found(spark, docs):
    """One word replaced, dropped or added in lines of over 60 characters: recall at least 0.9."""
    rng = random.Random(7)
    lines = sorted({x for t in docs.values() for x in t.split("\n") if 60 < len(x) < 400 and len(x.split()) >= 6})[:300]
    edited = []
    for line in lines:
        words = line.split(" ")
        at = rng.randrange(len(words))
        words[at:at + 1] = rng.choice(([], ["replaced"], [words[at], "added"]))
        edited.append(" ".join(words))
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(edited))], "doc_id long, text string")
    kept = {r.doc_id: r for r in line_dedup.dedup_lines(df).collect()}
    assert kept[2].dropped_lines >= 0.9 * len(lines)


def test_key_rows_equal_plain_segments():
    """Two word lists within the threshold always share a key, one side as index; lists that differ everywhere do not."""
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randrange(4, 130)
        a = [str(rng.randrange(50)).encode() for _ in range(n)]
        b = list(a)
        for _ in range(rng.randrange(1, 5)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randrange(2)] = rng.choice(([], [b"new"]))
        most = _line_edits(min(len(a), len(b)))
        number, key, index, _ = line_dedup.key_rows([a, b])
        first, second = ({int(k): int(i) for k, i, x in zip(key, index, number) if x == w} for w in (0, 1))
        if 0 < _plain_distance(a, b) <= most:
            assert any(first[k] or second[k] for k in first.keys() & second.keys())
    number, key, _, _ = line_dedup.key_rows([[b"a"] * 30, [b"b"] * 30])
    assert not set(key[number == 0]) & set(key[number == 1])


def test_a_family_makes_rows_in_proportion(spark):
    """Pairs of a large family of edited copies grow with the family, not with its square."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(40)]

    def pairs(n):
        texts = {0: " ".join(base)}
        for i in range(1, n):
            words = list(base)
            words[rng.randrange(40)] = f"x{i}"
            texts[i] = " ".join(words)
        df = spark.createDataFrame([(i, f"{t}\n" * (99 if not i else 1)) for i, t in texts.items()], "doc_id long, text string")
        lines = line_dedup._lines(df, "doc_id", "text")
        firsts = line_dedup.stage(line_dedup.first_lines(lines), "f")
        shared = line_dedup.shared_keys(lines, firsts)
        similar = line_dedup.similar_lines(line_dedup.line_texts(lines, shared), line_dedup.hub_pairs(shared))
        later = line_dedup._later(similar, firsts)
        assert later.count() == n - 1
        return similar.count() + line_dedup.kept_pairs(shared, later).count()

    assert pairs(400) <= 2.5 * pairs(200)


def test_line_dedup_against_all_pairs(spark, docs):
    rng = random.Random(4)
    texts = {d: docs[d] for d in sorted(docs)[:60]}
    for i, t in enumerate(list(texts.values())[:40]):
        lines = t.split("\n")
        at = rng.randrange(len(lines))
        line = list(lines[at])
        for _ in range(rng.choice((1, 2, 3, 5))):
            if line:
                p = rng.randrange(len(line))
                rng.choice((lambda: line.insert(p, "#"), lambda: line.pop(p), lambda: line.__setitem__(p, " ")))()
        texts[10_000 + i] = "".join(line) + "\nshort\n\n" + lines[0]
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got == _kept_text(texts)


def test_hot_lines_send_one_copy(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_COPIES", 2)
    base = "a common line that everybody repeats word by word"
    texts = {i: f"{base}\nown line number {i} of many with some length {i * i}" for i in range(9)}
    texts[9] = base + "!!"
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()} == _kept_text(texts)


def test_within_against_dynamic_programming():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(2)
    for _ in range(4000):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(12)))
        b = list(a)
        for _ in range(rng.randrange(5)):
            p = rng.randrange(len(b) + 1)
            b[p:p + rng.randrange(2)] = rng.choice(("", "a", "b", "c"))
        b = "".join(b)
        for most in (1, 2, 3):
            assert within(a, b, most) == (distance(a, b) <= most), (a, b, most)


def test_sharding_laws(spark, docs):
    rows = queries.op10_sharding(spark, SF_LABELS).collect()
    shards = collections.defaultdict(list)
    for r in rows:
        shards[r.shard].append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, 8)
    assert sorted(shards) == list(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert max(map(len, shards.values())) < 1.15 * min(map(len, shards.values()))
    assert abs(sum(r.grown_shard == 8 for r in rows) / len(rows) - 1 / 9) < 0.02


def test_weights_move_only_their_subtree(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "'x' AS text")
    before = {r.doc_id: r.shard for r in sharding.shard_rows(df, sharding.tree(8)).collect()}
    after = {r.doc_id: r.shard for r in sharding.shard_rows(df, sharding.tree(8, weights={5: 3.0})).collect()}
    moved = [(before[d], after[d]) for d in before if before[d] != after[d]]
    # Shard 5 sits in region 1, rack 0: racks of region 0 trade nothing, rows only enter the heavier subtree.
    assert moved and all(b in (4, 5, 6, 7) for _, b in moved)
    assert not any(a == 5 for a, b in moved if b in (0, 1, 2, 3))


def test_exact_dedup_filter_has_no_false_negative(spark):
    from clicklake.llm.exact_dedup import exact_dedup

    df = spark.range(3000).selectExpr("id AS doc_id", "concat('t ', cast(id % 1000 AS string)) AS text")
    rows = exact_dedup(df, bits_per_row=1, hashes=2).collect()
    assert {r.group_size for r in rows} == {3} and sum(r.kept for r in rows) == 1000


# ---------------------------------------------------------------------------- op1: interactions and plain scores

def _pairs(n, rng):
    """Texts whose label is known only from two words together; each word alone is neutral."""
    filler = [f"{a}{b}" for a in ("stone", "river", "cloud", "maple", "amber") for b in ("ton", "ley", "wick", "mere", "dale", "ford")]
    texts, labels = [], []
    for _ in range(n):
        a, b = rng.randrange(2), rng.randrange(2)
        words = rng.sample(filler, 8) + [("northers", "southers")[a], ("lovely", "awful")[b]]
        rng.shuffle(words)
        texts.append(" ".join(words))
        labels.append(int(a == b))
    return texts, labels


def test_words_that_are_neutral_alone_are_learned():
    rng = random.Random(3)
    model = toxicity.fit(*_pairs(1500, rng))
    texts, labels = _pairs(600, rng)
    right = sum((model.raw(toxicity.rows_of(toxicity.term_array(t), model.terms).astype(int)) > 0) == bool(y) for t, y in zip(texts, labels))
    assert right > 0.95 * len(texts)


def test_noise_alone_makes_no_pair_telling():
    rng = random.Random(4)
    texts, labels = _pairs(400, rng)
    labels = [rng.randrange(2) for _ in labels]
    model = toxicity.fit(texts, labels)
    assert len(model.terms) <= 8


def test_pair_scan_equals_plain_sums():
    rng = np.random.default_rng(2)
    found = [np.flatnonzero(rng.random(7) < 0.5) for _ in range(90)]
    y, raw = rng.integers(0, 2, 90), rng.normal(0, 1, 90)
    y = np.array([int(2 in f and 5 in f) if i % 9 else v for i, (f, v) in enumerate(zip(found, y))])
    p = 1 / (1 + np.exp(-raw))
    want = np.zeros(7, bool)
    for i in range(7):
        for j in range(7):
            both = [k for k, f in enumerate(found) if i in f and j in f]
            if i != j and sum(y[k] - p[k] for k in both) ** 2 / (sum(p[k] * (1 - p[k]) for k in both) + 1) >= toxicity.MIN_PAIR_CHI_SQUARE:
                want[i] = want[j] = True
    assert (toxicity.pair_terms(found, y, raw, 7, block=16) == want).all()


def test_op1_scores_equal_the_plain_sum_of_pairs(spark):
    rng = np.random.default_rng(1)
    words = ["bad", "good", "people", "there", "walking"]
    terms = np.unique(np.concatenate([toxicity.term_array(w) for w in words]))
    model = toxicity.Model(terms, 0.3, rng.normal(size=len(terms)), rng.normal(size=(len(terms), 4)))
    texts = ["bad people", "", None, "walking there GOOD good", "unknown", "people walk"]
    got = toxicity.score_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), model)
    for row in got.collect():
        hit = [i for i, t in enumerate(terms) if t in set(toxicity.term_array(texts[row["doc_id"]] or "").tolist())]
        z = 0.3 + sum(model.weights[i] for i in hit) + sum(float(model.factors[i] @ model.factors[j]) for i in hit for j in hit if i < j)
        assert abs(row["score"] - 1 / (1 + np.exp(-z))) < 1e-9


def test_op1_fit_on_spark_equals_the_fit_in_memory(spark):
    texts, labels = _pairs(300, random.Random(8))
    texts = [t + (" dreadful" if y else " pleasant") for t, y in zip(texts, labels)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    marks = spark.createDataFrame(list(enumerate(labels)), "doc_id bigint, toxic int")
    got = toxicity.fit_model(docs.union(docs), marks)
    used = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5]
    want = toxicity.fit([texts[i] for i in used], [labels[i] for i in used])
    assert (got.terms == want.terms).all() and np.allclose(got.weights, want.weights) and np.allclose(got.factors, want.factors)
