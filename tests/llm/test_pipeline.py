"""The pipeline's stages against plain versions, each on its own input."""

import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from subjectflow.llm import bpe, mixing, quality, toxicity
from subjectflow.llm.common import stored, table, text_of

from .test_neardup import brute

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs, columns = table(spark, SF, "documents"), None
    labels = table(spark, SF, "labels")
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        columns = columns or docs.columns
        docs = stored(stage(spark, docs, SF), "test-stage")
        results[name] = (before, docs)
        if name != "bpe":
            assert docs.columns == columns
    before, after = results["quality"]
    scores = before.select("doc_id", quality.score_of(text_of(), quality.train(before, labels)).alias("s")).collect()
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in scores if r.s >= 0.3}
    before, after = results["toxicity"]
    scores = before.select("doc_id", toxicity.score_of(text_of(), toxicity.train(before, labels)).alias("s")).collect()
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in scores if r.s < 0.5}
    before, after = results["near_dedup"]
    classes = brute({r.doc_id: r.text for r in before.collect()})
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(classes.values()))
    before, after = results["mixing"]
    times = {r.doc_id: r.times for r in mixing.mix(before).collect()}
    counted = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert counted == {i: n for i, n in times.items() if n}
    before, after = results["bpe"]
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in before.collect()}
    assert after.count() == before.count()
    for r in after.limit(200).collect():
        assert len(library.encode_ordinary(texts[r.doc_id])) == r.n_tokens
        assert hashlib.sha256(texts[r.doc_id].encode()).hexdigest() == r.decoded_sha256
