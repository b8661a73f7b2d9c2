"""Each stage against what it should keep, and the whole against the stages."""

import hashlib

import corpus_pipeline
from riskfeatures.llm import pii
from test_near_dedup import brute

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, rows = docs.columns, {r.doc_id: r for r in docs.collect()}
    good = corpus_pipeline.keep_quality(spark, docs, SF_DIR)
    assert good.columns == columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id: r for r in good.collect()}
    assert all(kept[i] == rows[i] for i in kept)
    assert sum(i in kept for i, q in labels.items() if q == 1) >= 0.97 * sum(labels.values())
    assert sum(i in kept for i, q in labels.items() if q == 0) <= 0.2 * max(1, sum(q == 0 for q in labels.values()))

    single = corpus_pipeline.drop_near_duplicates(spark, good, SF_DIR)
    assert single.columns == columns
    want = {i for i, _, _, first in brute([(r.doc_id, r.text) for r in kept.values()], 5) if first}
    left = {r.doc_id: r for r in single.collect()}
    assert set(left) == want

    masked = corpus_pipeline.mask_personal_data(spark, single, SF_DIR)
    assert masked.columns == columns and {r.doc_id for r in masked.collect()} == want
    spans = pii.pii_spans(masked).selectExpr("sum(size(filter(pii, x -> x.kind in ('email', 'ip', 'phone')))) n").head().n
    assert spans == 0

    mixed = corpus_pipeline.mix_sources(spark, masked, SF_DIR)
    texts = {r.doc_id: r.text for r in masked.collect()}
    sample = {r.doc_id: r.text for r in mixed.collect()}
    assert mixed.columns == columns and all(texts[i] == t for i, t in sample.items()) and 0 < len(sample) <= len(texts)

    encoded = {r.doc_id: r for r in corpus_pipeline.encode(spark, mixed, SF_DIR).collect()}
    assert {i: r.decoded_sha256 for i, r in encoded.items()} == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in sample.items()}
    assert sorted(corpus_pipeline.run(spark, SF_DIR).collect()) == sorted(encoded.values())
