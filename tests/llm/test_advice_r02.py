"""Cases of the second review: each failed before its finding was settled."""

import random

import public_tokenizers

import corpus_pipeline
from clicklake.llm import license_scan, near_dedup, piece_codec
from clicklake.llm.common import prepare
from test_brute_force import _components


def _band(rng, pairs=40, size=200):
    """Pairs of texts that differ in 3 to 9 words: similarities from about 0.6 to 0.9."""
    word = lambda: f"w{rng.randrange(10**6)}"
    texts = {}
    for i in range(pairs):
        base = [word() for _ in range(size)]
        edited = list(base)
        for at in range(3 + i % 7):
            edited[at * 20 + 5] = word()
        texts[2 * i], texts[2 * i + 1] = " ".join(base), " ".join(edited)
    return texts


def test_near_dedup_stage_drops_from_80_percent(spark):
    prepare(spark)
    texts = _band(random.Random(7))
    at_80, at_85 = ({d for d, (_, c) in _components(texts, p).items() if c == d} for p in (80, 85))
    assert len(at_80) < len(at_85)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()} == at_80


def test_keep_one_keeps_one_row_of_a_group(spark):
    prepare(spark)
    base = " ".join(f"word{i}" for i in range(120))
    other = " ".join(f"other{i}" for i in range(120))
    rows = [(1, base), (1, base), (1, base + " end"), (2, base), (None, other), (None, other + " end"), (None, other), (3, ""), (3, ""), (None, None), (4, "alone")]
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n long")
    got = near_dedup.keep_one(df).collect()
    assert sorted((r.doc_id or 0, (r.text or "")[:5]) for r in got) == [(0, ""), (0, "other"), (1, "word0"), (3, ""), (3, ""), (4, "alone")]


def test_dropout_is_drawn_per_occurrence(monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    text = " ".join(["international"] * 2000)
    enc = piece_codec.Encoder(piece_codec.model(path), 3, 0.2)
    chunks = piece_codec._CHUNK.findall(" " + text)
    ways = [enc.drawn(c, int(b)) for c, b in zip(chunks, enc.bases(text, len(chunks)), strict=True)]
    assert len(set(ways)) > 50
    # The cache changes nothing, whatever its size and the number of chunks drawn at once.
    others = ["It's  an\nextraordinarily-long-hyphenated-and-endless word ▁ 日本 😀 " * 50, "", "a"]
    want = [b"".join(ways), *[b"".join(enc.drawn(c, int(b)) for c, b in zip(x, enc.bases(t, len(x)), strict=True))
                              for t in others for x in [piece_codec._CHUNK.findall(" " + t) if t else []]]]
    assert piece_codec.Encoder(enc.model, 3, 0.2).texts([text, *others]) == want
    monkeypatch.setattr(piece_codec, "MAX_NODES", 5)
    monkeypatch.setattr(piece_codec, "STEP", 7)
    assert piece_codec.Encoder(enc.model, 3, 0.2).texts([text, *others]) == want


def test_licenses_are_told_apart():
    scanner = license_scan.Scanner(license_scan.TEMPLATES, license_scan.COVERAGE, license_scan.MARKS)

    def names(text):
        return {m[0] for m in scanner.scan("some words before it\n" + text + "\nand some after")}

    assert names("Released under the BSD License.") == {"bsd-line"}
    assert names("Licensed under CC BY-SA 4.0.") == {"cc-by-sa-4.0-short"}
    assert names("Licensed under CC BY-NC 3.0.") == set() and names("Released under the Foo License.") == set()
    assert names("This work is licensed under the GNU General Public License, version 2.") == {"gpl-2.0-line"}
    assert names("Licensed under the Apache License, Version 1.1.") == set()
    parts = {"bsd-2-clause": {"bsd-redistribution"}, "bsd-3-clause": {"bsd-redistribution"}, "mit-notice": {"mit-permission"},
             "mit-permission": set(), "apache-2.0-notice": {"apache-2.0-line"}, "cc-by-4.0-line": set()}
    for name, text in license_scan.TEMPLATES.items():
        assert name in names(text) and names(text) <= {name} | parts.get(name, set()), (name, names(text))
    lax = license_scan.Scanner(license_scan.TEMPLATES, license_scan.COVERAGE)
    assert "mit-line" in {m[0] for m in lax.scan("Released under the BSD License.")}
