"""The pipeline's stages against plain Python over the small table."""

import collections

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from test_brute_force import _components, _kept_text

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for i, (name, apply) in enumerate(corpus_pipeline.STAGES):
        out = apply(spark, before, SF)
        out.write.parquet(f"{tmp_dir}/{i}")
        after = spark.read.parquet(f"{tmp_dir}/{i}")
        if name != "packing":
            assert after.columns == docs.columns
        then, now = ({r.doc_id: r.text or "" for r in x.select("doc_id", "text").collect()} if "text" in x.columns else None for x in (before, after))
        if name == "toxicity":
            toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
            gone = set(then) - set(now)
            assert set(now) <= set(then) and len(gone) < len(then) / 4 and (not gone or len(gone & toxic) >= len(gone) / 3)
        elif name == "line_dedup":
            assert now == _kept_text(then)
            assert all(r.n_chars == len(r.text) for r in after.collect())
        elif name == "near_dedup":
            assert set(now) == {d for d, (_, c) in _components(then, 80).items() if c == d}
        else:
            tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            tokens = collections.Counter()
            for r in after.collect():
                tokens[r.doc_id] += r.length
            assert tokens == {d: len(tok.encode(t, add_special_tokens=False).ids) + 1 for d, t in then.items()}
        before = after


def test_run_is_the_last_stage(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "packing"]
    assert "sequence_id" in corpus_pipeline.run(spark, SF).columns
