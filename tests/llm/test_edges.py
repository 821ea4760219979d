"""Every operator over nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from clicklake.llm import (exact_dedup, fingerprints, license_scan, line_dedup, near_dedup, packing, piece_codec,
                           sharding, toxicity, url_filter)
from clicklake.llm.common import prepare

LONG = " ".join(f"word{i % 977} tail{i % 13}" for i in range(20_000))
CLASHING = ["_id", "_text", "_key", "_kept", "_doc", "_line", "_node", "_row", "kept", "shard", "score", "ids", "lines", "key", "root"]
ROWS = [(1, "a b c d e f g"), (2, None), (3, ""), (4, " \t\n"), (5, "a b c d e f g"), (5, "a b c d e f g"), (6, LONG), (None, "no id here at all, sir"),
        (7, "one"), (8, "\0nul\0 bytes"), (9, "lone   spaces\n\n\n"), (None, None)]


@pytest.fixture(scope="module")
def messy(spark):
    prepare(spark)
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])


@pytest.fixture(scope="module")
def empty(messy):
    return messy.limit(0)


def _labels(spark):
    return spark.createDataFrame([(1, 1), (5, 0), (6, 0), (7, 1), (None, 1), (8, None)], "doc_id long, toxic int")


def _operators(spark):
    path, pieces = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
    labels = _labels(spark)
    return {
        "toxicity": lambda d: toxicity.toxicity(d, labels),
        "exact": exact_dedup.exact_dedup,
        "fingerprints": fingerprints.fingerprints,
        "near": near_dedup.near_duplicates,
        "packing": lambda d: packing.pack(d, path),
        "codec": lambda d: piece_codec.decode_documents(piece_codec.encode_documents(d, pieces), pieces),
        "licenses": license_scan.scan_licenses,
        "lines": line_dedup.dedup_lines,
        "sharding": lambda d: sharding.shard_rows(d, sharding.tree(8)),
    }


@pytest.mark.parametrize("name", ["toxicity", "exact", "fingerprints", "near", "codec", "lines", "sharding"])
def test_one_row_per_row(spark, messy, empty, name):
    apply = _operators(spark)[name]
    out = apply(messy)
    assert out.count() == len(ROWS)
    assert sorted(x[0] is None for x in out.select("doc_id").collect()) == [False] * 10 + [True] * 2
    assert apply(empty).columns == out.columns and apply(empty).count() == 0


@pytest.mark.parametrize("name", ["packing", "licenses"])
def test_many_rows_per_row(spark, messy, empty, name):
    apply = _operators(spark)[name]
    out = apply(messy)
    assert apply(empty).columns == out.columns and apply(empty).count() == 0
    if name == "packing":
        assert out.select("doc_id").distinct().count() == 10


def test_edited_fingerprints_are_one_row_per_row(spark, messy, empty):
    """Rows that share an id, repeated rows and rows without id all stay, each followed by the next row."""
    out = fingerprints.edited_fingerprints(messy)
    assert out.count() == len(ROWS) and fingerprints.edited_fingerprints(empty).count() == 0
    assert {r.near_next for r in out.filter("doc_id in (2, 3)").collect()} == {1.0}
    assert sorted(r.near_next for r in out.filter("doc_id = 5").collect())[-1] == 1.0 and out.filter("doc_id is null").count() == 2
    twice = spark.createDataFrame([(1, "a b c d e f g h"), (1, "a b c d e f g h"), (1, "x y"), (2, "z")], "doc_id long, text string")
    rows = fingerprints.edited_fingerprints(twice).collect()
    assert sorted((r.doc_id, r.n_chars) for r in rows) == [(1, 3), (1, 15), (1, 15), (2, 1)]
    assert {hashlib.sha256(b"a b c d e f a b").hexdigest()} & {r.edited_sha256 for r in rows}


def test_exact_groups(messy):
    rows = exact_dedup.exact_dedup(messy).collect()
    same = [r for r in rows if r.doc_id in (1, 5)]
    assert [r.group_size for r in same] == [3] * 3 and sum(r.kept for r in same) == 1 and {r.keep_id for r in same} == {1}
    nothing = [r for r in rows if r.doc_id in (2, 3, 4)]
    assert {r.group_size for r in nothing} == {4} and {r.keep_id for r in nothing} == {4}


def test_near_results(messy):
    rows = {(r.doc_id, r.n_shingles): r for r in near_dedup.near_duplicates(messy).collect()}
    assert rows[(5, 3)].component_id == 1 and not rows[(5, 3)].kept
    for i in (2, 3, 4):
        assert rows[(i, 0)].component_id == i and rows[(i, 0)].kept
    assert rows[(None, 2)].component_id is None and rows[(None, 2)].kept


def test_stages_keep_all_columns(messy, empty):
    for out in (line_dedup.dedup_lines(messy, with_counts=False), near_dedup.keep_one(messy)):
        assert out.columns == messy.columns
    assert near_dedup.keep_one(empty).count() == 0
    lengths = {r.doc_id: len(r.text) for r in near_dedup.keep_one(messy).collect() if r.text}
    assert 6 in lengths and 5 not in lengths and lengths[6] == len(LONG)


def test_urls(spark):
    urls = spark.createDataFrame([(1, "HTTP://Sub.Example.NET/en/x?q"), (1, None), (None, "no scheme"), (2, "https://a.org/fr/1#x"), (3, "x://net"),
                                  (4, "x://notnet/"), (5, "http://éÀ.NET\n/a b"), (6, "a://b://c/d"), (7, "http://A\0B.net/")],
                                 "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("rule", F.lit(1))
    rules = [url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"),
             url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/")]
    model = url_filter.fit(spark)
    got = {(r.page_id, r.host, r.path): (r.rule, r.verdict) for r in url_filter.judge(urls, model, rules).collect()}
    assert got[(1, "sub.example.net", "/en/x")] == ("example.net/en/", "allow")
    assert got[(2, "a.org", "/fr/1")] == ("org/fr/", "allow")
    assert got[(3, "net", "")][0] is None and got[(4, "notnet", "/")][0] is None
    assert got[(5, "éÀ.net\n", "/a b")][0] is None  # the host ends in a line break, not in .net
    assert (1, "", "") in got and (None, "", "") in got and got[(6, "b:", "//c/d")][0] is None
    assert got[(7, "a\0b.net", "/")] == ("net/", "block")
    assert url_filter.judge(urls.limit(0), model, rules).count() == 0
    unseen = spark.createDataFrame([(1, "http://spam-farms.example.com/en/1"), (2, "http://www.casino-bonuses.test.org/x"),
                                    (3, "https://hereon.example.com/en/99"), (4, "https://m.ththand.example.org/es/5")], "page_id long, url string")
    verdicts = {r.page_id: r.verdict for r in url_filter.judge(unseen, model, []).collect()}
    assert verdicts == {1: "block", 2: "block", 3: "allow", 4: "allow"}
