"""Removed bytes against brute force, and against SQL."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest

from riskfeatures.llm import suffix_dedup as sd
from riskfeatures.llm.queries import op6_suffix_dedup

SCHEMA = "doc_id long, text string"
L = sd.LENGTH


def brute(rows):
    raw = [(i, (t or "").encode()) for i, t in rows]
    holder = {}
    for i, b in raw:
        for a in range(len(b) - L + 1):
            w = b[a : a + L]
            holder[w] = min(i, holder.get(w, i))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for a in range(len(b) - L + 1):
            if holder[b[a : a + L]] < i:
                gone[a : a + L] = True
        left = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out)


def test_random_texts(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdeé中\n", k=rng.randrange(1, 7))) for _ in range(60)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    shared = [text(40) for _ in range(6)] + ["a" * 120, "ab" * 70, "\0" * 80]
    rows = [(i, "".join(rng.choice([text(rng.randrange(30)), rng.choice(shared), rng.choice(shared)[: rng.randrange(120)]]) for _ in range(rng.randrange(6)))) for i in range(60)]
    rows += [(100, rows[5][1]), (101, rows[5][1]), (102, ""), (103, None), (104, "x" * 49), (105, "x" * 49), (106, "y" * 50), (107, "y" * 50), (107, "y" * 50), (108, "z" * 3_000), (109, "z" * 200)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as doc", "2 as n_bytes")
    assert sorted(map(tuple, sd.digests(sd.remove_repeats(df)).collect())) == brute(rows)


def test_empty_and_keyless(spark):
    df = spark.createDataFrame([(None, "q" * 60), (3, "q" * 60)], SCHEMA)
    assert sorted((r.doc_id or -1, r.n_removed) for r in sd.remove_repeats(df).collect()) == [(-1, 60), (3, 0)]
    assert sd.remove_repeats(df.where("doc_id > 9")).collect() == []


def test_every_string_has_an_anchor():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 5_000).astype(np.uint8)
    at, h = sd.anchors(data)
    assert max(np.diff(at)) <= sd.REACH + 1 and at[0] <= sd.REACH and at[-1] >= len(data) - L
    again, g = sd.anchors(data[777:1777])
    inner = (again >= sd.REACH) & (again < 1000 - L)
    assert set(again[inner] + 777) <= set(at)


def test_sql_agrees(spark, agrees):
    agrees(op6_suffix_dedup(spark, "/root/testdata/sf0.001"), sd.oracle())


def stages(rows, shards=3, batch=7):
    """What remove_repeats does, stage by stage: its rows, and all frames that are sent."""
    texts = pd.DataFrame(rows, columns=["doc", "text"])
    run = lambda f, df: pd.concat([pd.DataFrame(), *f(iter([df[a : a + batch] for a in range(0, len(df), batch)]))], ignore_index=True)
    of_shard = lambda f, df: pd.concat([pd.DataFrame(), *(run(f, x) for _, x in (df.groupby("shard") if len(df) else ()))], ignore_index=True)
    back = lambda df, names: {c: x[names].to_dict("records") for c, x in df.groupby("chunk")} if len(df) else {}
    chunks = run(sd._chunks, texts)
    chunks["chunk"] = range(len(chunks))
    grams = run(sd._grams(shards), chunks)
    bits = of_shard(sd._shared, grams)
    held = back(bits, ["shard", "bits"])
    pieces = run(sd._pieces(shards), chunks.assign(shared=pd.Series([held.get(c) for c in chunks["chunk"]], dtype=object)))
    ranges = of_shard(sd._shard, pieces)
    marks = {c: [r["ranges"] for r in x] for c, x in back(ranges, ["ranges"]).items()}
    out = run(sd._removed, chunks.assign(marks=pd.Series([marks.get(c) for c in chunks["chunk"]], dtype=object)))
    return sorted(map(tuple, out.drop(columns="kept").to_numpy().tolist())), (chunks, grams, bits, pieces, ranges)


def sent(*frames):
    return sum(len(x) for f in frames for c in f for x in f[c] if isinstance(x, bytes))


@pytest.mark.parametrize("seed", range(4))
def test_cuts_change_nothing(monkeypatch, seed):
    """Chunks, blocks, parts of a shard and scratch files of any size give the same rows."""
    rng = random.Random(seed)
    for name, value in (("CHUNK", rng.choice([1, 300, 5_000])), ("BLOCK", rng.choice([1, 37, 400])), ("TOGETHER", rng.choice([1, 5, 90])), ("IN_MEMORY", 0)):
        monkeypatch.setattr(sd, name, value)
    words = ["".join(rng.choices("abc\0é", k=rng.randrange(1, 7))) for _ in range(40)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    shared = [text(40) for _ in range(4)] + ["a" * 130, "\0" * 80, "ab" * 40]
    rows = [(rng.randrange(25), "".join(rng.choice([text(rng.randrange(20)), rng.choice(shared), rng.choice(shared)[: rng.randrange(120)]]) for _ in range(rng.randrange(5)))) for _ in range(40)]
    rows += [(30, None), (31, "x" * 49), (32, "x" * 50), (32, "x" * 50), (33, "x" * 51)]
    assert stages(rows, shards=rng.choice([1, 3, 50]))[0] == brute(rows)


def test_what_is_sent_stays_below_twice_the_text():
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 9))) for _ in range(3_000)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    shared = [text(60) for _ in range(40)]
    rows = [(i, " ".join(text(60) if rng.random() < 0.75 else rng.choice(shared) for _ in range(8))) for i in range(400)]
    got, (chunks, grams, bits, pieces, ranges) = stages(rows)
    assert got == brute(rows)
    size = sum(len(t) for _, t in rows)
    # texts are stored and exchanged; pieces of shared anchors alone follow, and few bits come back
    assert sent(chunks[["docs", "sizes", "body"]]) * 2 + sent(grams, bits, pieces, ranges) < 2 * size
    assert sent(bits, ranges) < 0.1 * size


def test_copies_in_a_chunk_send_their_pieces_once():
    rng = random.Random(2)
    text = "".join(rng.choices("abcdefgh ", k=2_000))
    one, many = (stages([(i, text) for i in range(n)]) for n in (2, 200))
    assert one[1][3]["n"].sum() == many[1][3]["n"].sum()
    assert [r[2] for r in many[0]] == [0] + [2_000] * 199
