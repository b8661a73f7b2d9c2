"""Held-out accuracy of the quality classifier, and its edge cases."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from riskfeatures.llm import quality
from riskfeatures.llm.queries import op9_quality

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = op9_quality(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert got.count() == docs.count()
    labelled = got.join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id").where("held_out")
    n, right, kept, good = labelled.agg(
        F.count("*"), F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.sum(F.expr("int(predicted = 1 and quality = 1)")), F.sum("quality")
    ).head()
    assert n > 100 and right / n >= 0.97 and kept / good >= 0.98
    for r in got.limit(50).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def test_blocks_are_exact():
    texts = ["The cat sat on the mat.", "X!! Y!! Z!!", "", None, "a a a a a a", "word " * 5_000]

    model = quality.fit(np.stack([quality.terms(t) for t in texts]), np.array([1, 0, 1, 1, 0, 0], float))
    together = model.scores(texts * 60)
    assert np.allclose(together, np.tile([model.scores([t])[0] for t in texts], 60), atol=1e-6)


def test_edges(spark):
    docs = spark.createDataFrame([(1, "some text", 9.0), (1, "some text", 9.0), (None, None, 0.0), (4, "", 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, None), (None, 1)], "doc_id long, quality int")
    rows = quality.digests(quality.classify(spark, docs, labels)).collect()
    assert [r.score for r in rows] == [0.5] * 4
    one = quality.digests(quality.classify(spark, docs, labels.selectExpr("4L as doc_id", "0 as quality"))).collect()
    assert {r.predicted for r in one} <= {0, 1} and len(one) == 4
    assert quality.classify(spark, docs.where("doc_id > 9"), labels).collect() == []


def test_repeated_keys(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, quality long")
    texts = [(i, f"{'good plain words' if i % 2 else '$$ !! 99'} {i}") for i in range(1, 60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    more = [(i, "~ " + t) for i, t in texts for _ in range(200)] + [(1, None)]
    again = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string")).repartition(7)
    scores = lambda learnt: [tuple(r) for r in quality.score_quality(docs, learnt).orderBy("doc_id").collect()]
    assert scores(quality.learn(again, labels, sample=8)) == scores(quality.learn(docs, labels, sample=8))


def test_the_driver_holds_the_sample_once():
    import tracemalloc

    texts = [f"{i % 7} words of text number {i} " * (1 + i % 5) for i in range(300)]
    counts = np.stack([quality.terms(t) for t in texts])
    unpacked = np.zeros_like(counts)
    for t, out in zip(counts, unpacked):
        data = quality.packed(t)
        assert len(data) < t.nbytes / 4
        quality.unpack(data, out)
    assert (unpacked == counts).all()
    tracemalloc.start()
    model = quality.fit(unpacked, np.arange(300) % 2.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # neither a weighted copy nor one in double precision
    assert peak < counts.nbytes
    assert (model.vectors == model.latent(counts).astype(np.float32)).all()
