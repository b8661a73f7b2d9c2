"""Raked shares against their targets, and sampling."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskfeatures.llm import mixing
from riskfeatures.llm.queries import op2_mixing

SF_DIR = "/root/testdata/sf0.01"


def test_rake_meets_targets():
    rng = np.random.default_rng(0)
    cells = [(a, b, c) for a in range(5) for b in range(3) for c in range(2)]
    tokens = rng.integers(10, 1000, len(cells)).astype(float)
    targets = [rng.dirichlet(np.ones(n)) for n in (5, 3, 2)]
    p = mixing.rake(tokens, cells, targets)
    assert p.max() == pytest.approx(1)
    for m, target in enumerate(targets):
        now = np.bincount([c[m] for c in cells], weights=tokens * p)
        assert np.allclose(now / now.sum(), target, atol=1e-5)
    assert (mixing.rake(tokens, cells, targets, most=50.0) * tokens).sum() == pytest.approx(50)


def test_query_margins(spark):
    rows = op2_mixing(spark, SF_DIR).toPandas()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for m in ("source", "lang", "topic"):
        want = mixing.tempered(rows.groupby(m)["tokens"].sum().to_dict())
        expected = rows["tokens"] * rows["probability"]
        got = expected.groupby(rows[m]).sum() / expected.sum()
        assert all(abs(got[v] - s) < 1e-3 for v, s in want.items())
    assert abs(rows["sampled"].mean() - rows["probability"].mean()) < 0.05


def test_edges(spark):
    df = spark.createDataFrame(
        [(1, "a b", "s", "en"), (1, "a b", "s", "en"), (2, None, None, None), (None, "", "s", "de"), (3, "x " * 50, "t", None)],
        "doc_id long, text string, source string, lang string",
    ).withColumn("tokens", F.lit("old"))
    rows = mixing.digests(mixing.mix(df)).collect()
    assert len(rows) == 5 and all(0 <= r.probability <= 1 for r in rows)
    assert len({r.sampled for r in rows if r.doc_id == 1}) == 1
    assert mixing.mix(df.where("doc_id > 5")).collect() == []
    fixed = mixing.mix(df, {"source": {"s": 0.9, "t": 0.1}, "lang": {"en": 1.0}, "topic": {str(i): 1 for i in range(8)}})
    assert fixed.count() == 5
