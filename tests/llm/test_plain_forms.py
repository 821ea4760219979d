"""op8, op10 and the pipeline's first and last stage against plain Python, and over odd rows."""

import math
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from clicklake.llm import queries, sharding, url_filter
from clicklake.llm.common import prepare

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------------------- op8

def _murmur3(data: bytes, seed: int = 42) -> int:
    """32-bit MurmurHash3 (x86), as the hashing of terms uses it; signed."""
    def rotl(x, r):
        return ((x << r) | (x >> (32 - r))) & 0xFFFFFFFF

    def mixed(k):
        return rotl(k * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF

    h = seed
    whole = len(data) // 4 * 4
    for i in range(0, whole, 4):
        h = (rotl(h ^ mixed(int.from_bytes(data[i:i + 4], "little")), 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
    if data[whole:]:
        h ^= mixed(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def _parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:end], rest[end:]
    stop = min((tail.index(c) for c in "?#" if c in tail), default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:stop]


def _plain_grams(host, path):
    out = set()
    for kind, text in (("h:", host), ("p:", path)):
        padded = "^" + text.lower() + "$"
        out |= {kind + padded[i:i + n] for n in (3, 4, 5) for i in range(len(padded) - n + 1)}
    return out


def _plain_rule(host, path):
    best = None
    for verdict, of, start in (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")):
        if (host == of or host.endswith("." + of)) and path.startswith(start) and (best is None or len(of + start) > len(best[1])):
            best = verdict, of + start
    return best


def test_op8_url_filter_equals_plain_python(spark):
    prepare(spark)
    regression = url_filter.fit(spark).stages[1]
    weights, bias = regression.coefficients.toArray(), regression.intercept
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    got = queries.op8_url_filter(spark, SF).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path = _parts(urls[r.page_id])
        raw = bias + sum(weights[at] for at in {_murmur3(g.encode()) % url_filter.BUCKETS for g in _plain_grams(host, path)})
        rule = _plain_rule(host, path)
        assert (r.host, r.path) == (host, path) and r.rule == (rule[1] if rule else None)
        if rule or abs(raw) > 1e-6:
            assert r.verdict == (rule[0] if rule else "block" if raw > 0 else "allow"), (urls[r.page_id], raw)


def test_op8_grams_have_their_lengths(spark):
    df = spark.createDataFrame([("Ab.cde", "/x"), ("", "")], "host string, path string")
    got = [set(r._grams) for r in url_filter.with_grams(df).collect()]
    assert got == [_plain_grams("Ab.cde", "/x"), _plain_grams("", "")]


def test_op8_held_out_hosts(spark):
    urls = url_filter.labelled_urls(spark).filter("held_out").withColumn("page_id", F.xxhash64("url"))
    labels = {r.page_id: r.label for r in urls.collect()}
    right = Counter()
    for r in url_filter.judge(urls, url_filter.fit(spark), []).collect():
        right[labels[r.page_id], r.verdict] += 1
    assert right[1.0, "block"] >= 0.88 * (right[1.0, "block"] + right[1.0, "allow"])
    assert right[0.0, "allow"] >= 0.99 * (right[0.0, "block"] + right[0.0, "allow"])
    # The labels are words put together by rule: no host of the pages is among them.
    own = {h for h, _, _ in url_filter.labelled_hosts()}
    hosts = {_parts(r.url)[0] for r in spark.read.parquet(f"{SF}/pages.parquet").select("url").collect()}
    assert not {label for h in hosts for label in h.split(".")[:-2]} & own


def test_op8_very_long_urls(spark):
    long = "http://" + "garden." * 5_000 + "example.com/" + "en/" * 20_000
    urls = spark.createDataFrame([(1, long), (1, long), (2, "http://" + "x" * 50_000)], "page_id long, url string")
    rows = url_filter.judge(urls, url_filter.fit(spark), []).collect()
    assert len(rows) == 3 and {len(r.path) for r in rows if r.page_id == 1} == {60_001}


# ---------------------------------------------------------------------------- op10

def _plain_shard(key, node, seed=0):
    while node.children:
        draws = []
        for i, c in enumerate(node.children):
            first = xxhash.xxh64_intdigest(key.encode(), seed=42)
            u = ((xxhash.xxh64_intdigest(f"{seed}:{c.name}".encode(), seed=first) >> 11) + 0.5) / 2 ** 53
            draws.append((-math.log(u) / c.weight, i))
        node = node.children[min(draws)[1]]
    return node.shard


def test_op10_sharding_equals_the_plain_tree(spark):
    root = sharding.tree(8)
    more = sharding.grown(root, 8)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = queries.op10_sharding(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.shard, r.grown_shard) == (_plain_shard(str(r.doc_id), root), _plain_shard(str(r.doc_id), more))
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))


@pytest.mark.parametrize("weights", [{5: 3.0}, {0: 0.25, 7: 10.0}])
def test_op10_weights_equal_the_plain_tree(spark, weights):
    root = sharding.tree(8, weights=weights)
    df = spark.range(500).selectExpr("id AS doc_id", "'x' AS text")
    assert all(r.shard == _plain_shard(str(r.doc_id), root) for r in sharding.shard_rows(df, root).collect())


# ---------------------------------------------------------------------------- stages

def test_first_and_last_stage_over_odd_rows(spark):
    prepare(spark)
    long = " ".join(f"word{i % 977}" for i in range(20_000))
    rows = [(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (None, "no id"), (None, None), (4, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("_id", "_text", "_score", "ids", "_part", "start", "length")})
    kept = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert kept.columns == docs.columns and corpus_pipeline.drop_toxic(spark, docs.limit(0), SF).count() == 0
    assert kept.count() == len(rows)
    pieces = corpus_pipeline.pack_sequences(spark, docs, SF)
    places = sorted((r.sequence_id, r.offset, r.length) for r in pieces.collect())
    ends = Counter()
    for sequence, offset, length in places:
        assert offset == ends[sequence]
        ends[sequence] += length
    assert pieces.filter("start = 0").count() == len(rows)
    assert corpus_pipeline.pack_sequences(spark, docs.limit(0), SF).count() == 0
