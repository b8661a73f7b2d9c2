"""Fingerprints against a plain reading, and against SQL."""

import hashlib
import re

from riskfeatures.llm import spotsigs
from riskfeatures.llm.queries import op10_spotsigs

SCHEMA = "doc_id long, text string, print string"


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    words, sigs = ["^", *words], set()
    stop = {*spotsigs.ANCHORS, "^"}
    content = [i for i, w in enumerate(words) if w not in stop]
    for k, i in enumerate(content):
        if words[i - 1] in stop:
            then = words[content[k + 1]] if k + 1 < len(content) else ""
            sigs.add(f"{words[i - 1]},{words[i]} {then}")
    if words[-1] in stop:
        sigs.add(f"{words[-1]}, ")
    return {hashlib.md5(s.encode()).hexdigest()[:8] for s in sigs}


def like(a, b):
    return 1.0 if a == b else round(len(a & b) / len(a | b), 9)


def test_rows(spark):
    texts = ["The cat of the house is black", "", None, "the of", "word", "Und der Hund \U0001f600 bellt. " * 400, "x " * 20_000, "Is it? a b c the d", "the " * 60_000 + "end of it", "same text is here", "same text is here"]
    rows = [(i * 3, t, "") for i, t in enumerate(texts)] + [(12, texts[4], "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, spotsigs.fingerprints(spark, df).collect()), key=lambda r: -r[0])
    ordered = sorted(((i, t or "") for i, t, _ in rows), key=lambda r: -r[0])
    for (i, t), (_, then), r in zip(ordered, ordered[1:] + ordered[:1], got):
        k = len(t) // 3
        edited = t[: len(t) - k] + then[:k]
        a, b, c = brute(t), brute(edited), brute(then)
        assert r[:7] == (i, len(t), hashlib.sha256(edited.encode()).hexdigest(), ",".join(sorted(a)), ",".join(sorted(b)), like(a, b), like(a, c))


def test_without_keys(spark):
    df = spark.createDataFrame([(None, "the cat", ""), (None, None, "")], SCHEMA)
    assert sorted(r.near_next for r in spotsigs.fingerprints(spark, df).collect()) == [1.0, 1.0]
    assert spotsigs.fingerprints(spark, df.where("text = 'none'")).collect() == []
    one = spotsigs.fingerprints(spark, spark.createDataFrame([(7, "the cat sat on the mat", "")], SCHEMA)).collect()
    assert [r.near_next for r in one] == [1.0]


def test_alike(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    prints = {}
    for d in docs.collect():
        if s := brute(d.text):
            prints.setdefault(frozenset(s), []).append(d.doc_id)
    sets = [(min(v), k) for k, v in prints.items()]
    want = {(min(a, b), max(a, b)) for a, s in sets for b, t in sets if a < b and len(s & t) >= 0.8 * len(s | t) - 1e-9}
    assert {(r.a, r.b) for r in spotsigs.alike(docs).collect()} == want


def test_sql_agrees(spark, agrees):
    agrees(op10_spotsigs(spark, "/root/testdata/sf0.001"), spotsigs.oracle())


def test_no_python(spark):
    assert "Python" not in op10_spotsigs(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
