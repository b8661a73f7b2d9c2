"""Near-duplicate components against all pairs by brute force, and against SQL."""

import random
import re

import numpy as np
import pytest

from riskfeatures.llm import near_dedup as nd
from riskfeatures.llm.queries import op3_near_dedup


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, k):
    sets = [(i, shingles(t, k)) for i, t in rows]
    comp = {n: i for n, (i, _) in enumerate(sets)}
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a][1] and sets[b][1] and 100 * len(sets[a][1] & sets[b][1]) >= 80 * len(sets[a][1] | sets[b][1])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(comp[a], comp[b])
            changed |= comp[a] != low or comp[b] != low
            comp[a] = comp[b] = low
    return sorted((i, len(s), comp[n], i == comp[n]) for n, (i, s) in enumerate(sets))


def corpus():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(words, k=60))
    texts = []
    for _ in range(25):
        base = rng.choices(words, k=rng.choice([3, 6, 20, 90, 500]))
        texts.append(" ".join(base))
        for _ in range(rng.randrange(6)):
            copy = list(base)
            for _ in range(rng.randrange(1 + len(base) // 12)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy).title() if rng.random() < 0.3 else "\n".join(copy))
    texts += [passage + " " + " ".join(rng.choices(words, k=40)) for _ in range(30)]
    chain = rng.choices(words, k=60)
    for i in range(12):  # a chain whose ends are unlike
        chain = chain[2:] + rng.choices(words, k=2)
        texts.append(" ".join(chain))
    return list(enumerate(texts + ["", None, "one", "ONE", "  \t", " two  words ", "İ É"]))


@pytest.mark.parametrize("k", [4, 5])
def test_components(spark, k):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "'x' as comp")
    assert sorted(map(tuple, nd.near_duplicates(df, k=k).collect())) == brute(rows, k)


def test_recall_of_bands():
    rng = np.random.default_rng(1)
    lost = 0
    for n in [4, 9, 30, 200, 900] * 60:
        d = n // 9
        union = rng.integers(0, 2**63, n + d, dtype=np.int64).view(np.uint64)
        a, b = nd.sketch(np.unique(union[:n])), nd.sketch(np.unique(union[d:]))  # 8 of 10 shared, at least
        lost += not np.any(nd.band_keys(a[None]) == nd.band_keys(b[None]))
    assert lost == 0


def test_ties_and_empty(spark):
    text = "a b c d e f g"
    df = spark.createDataFrame([(3, text), (3, text), (1, text), (None, text), (None, None), (2, None)], "doc_id long, text string")
    got = sorted(map(tuple, nd.near_duplicates(df).collect()), key=str)
    assert got == sorted([(3, 3, 1, False), (3, 3, 1, False), (1, 3, 1, True), (None, 3, None, True), (None, 0, None, True), (2, 0, 2, True)], key=str)
    assert sorted(map(tuple, nd.deduplicate(df).collect()), key=str) == sorted([(1, text), (2, None), (None, text), (None, None)], key=str)
    assert nd.near_duplicates(df.where("doc_id > 9")).collect() == []


@pytest.mark.parametrize("swap", [False, True])
def test_texts_under_one_key(spark, swap):
    words = [f"w{i}" for i in range(40)]
    a, b = " ".join(words), " ".join(w + "x" for w in words)
    rows = [(1, a), (1, b), (2, b + " more"), (3, a + " more"), (4, "else")]
    rows = [rows[1], rows[0], *rows[2:]] if swap else rows
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as mark", "'x' as digest").coalesce(1)
    got = sorted(map(tuple, nd.near_duplicates(df).collect()))
    assert [(r[0], r[2], r[3]) for r in got] == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)]
    left = nd.deduplicate(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == sorted([(1, a), (1, b), (4, "else")])


@pytest.mark.parametrize("whole", [0, 40, 512])
def test_small_tiles(spark, monkeypatch, whole):
    monkeypatch.setattr(nd, "WHOLE", whole)
    monkeypatch.setattr(nd, "TILE", 3)
    monkeypatch.setattr(nd, "TOGETHER", 2)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, nd.near_duplicates(df).collect())) == brute(rows, 5)


def test_overlaps():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 30, rng.integers(1, 20))).astype(np.uint64) for _ in range(12)]
    of, every = np.array([3, 0, 7]), np.array([1, 2, 3, 11])
    got = [both.tolist() for both in nd._overlaps(sets, of, every)]
    assert got == [[len(set(sets[i]) & set(sets[j])) for j in every] for i in of]


def test_pairs_of_a_large_group(spark):
    """Texts of a group that lie between the threshold and far below it: what leaves the tiles
    grows with the texts, not with their pairs."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    base = rng.choices(words, k=150)
    rows = []
    for i in range(400):
        copy = list(base)
        for _ in range(rng.randrange(1, 24)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append((i, " ".join(copy)))
    seen = []

    def counted(pairs, *more, confirmed=nd.confirmed):
        seen.append(pairs.count())
        return confirmed(pairs, *more)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(nd, "confirmed", counted)
        got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=4)
        got = sorted(map(tuple, got.collect()))
    assert got == brute(rows, 4)
    assert seen[2] + seen[3] <= 4 * len(rows)


def test_sql_agrees(spark, agrees):
    agrees(op3_near_dedup(spark, "/root/testdata/sf0.001"), nd.oracle())
