"""Neighbours found against brute force."""

import numpy as np

from riskfeatures.llm import ann
from riskfeatures.llm.queries import op7_ann


def brute(rows, k=5, ask=lambda i: i % 50 == 0):
    x = np.array([v for _, v in rows], np.float32).astype(float)
    ids = np.array([i for i, _ in rows])
    n = np.sqrt((x * x).sum(axis=1))
    out = {}
    for q in np.flatnonzero(ask(ids)):
        s = (x * x[q]).sum(axis=1) / (n * n[q])
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[j]), s[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in rows}) / len(rows) for q, rows in want.items()])


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    got, want = found(op7_ann(spark, "/root/testdata/sf0.01")), brute(rows)
    assert recall(got, want) >= 0.99
    for q in want:
        assert len(got[q]) == 5
        assert all(abs(a[1] - b[1]) < 1e-12 for a, b in zip(got[q], want[q]) if a[0] == b[0])


def test_recall_in_a_full_shard():
    x = np.random.default_rng(8).normal(size=(ann.SHARD, 64))
    v = ann.units(x)
    graph = ann.build(v, ann.layers_of(np.arange(len(v))))
    got = ann.search(v, graph, v[::50], ann.BEAM)
    want = np.argsort(-(v[::50] @ v.T), axis=1)[:, :6]
    assert np.mean([len(set(g[:6]) & set(w)) / 6 for g, w in zip(got, want)]) >= 0.95


def test_many_shards_and_copies(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.normal(size=8).astype(np.float32).tolist()) for i in range(600)]
    rows += [(i, rows[0][1]) for i in range(600, 900)]
    bad = [(1000, None), (1050, [0.0] * 8), (1100, [float("nan")] + [1.0] * 7), (None, [1.0] * 8), (1150, [1.0, None] * 4), (1200, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad + rows[:1], "vec_id long, embedding array<float>").selectExpr("*", "7 as rank", "0.5d as score")
    got, want = found(ann.nearest(df, df.where("vec_id % 50 = 0"), shard_nodes=100)), brute(rows)
    assert set(got) == set(want) and recall(got, want) >= 0.95
    assert [i for i, _ in got[0]] == [600, 601, 602, 603, 604] and [i for i, _ in got[650]] == [0, 600, 601, 602, 603]
    assert ann.nearest(df.where("vec_id < 0"), df).collect() == []
