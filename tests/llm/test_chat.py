"""Role recovery, exactness of cut conversations, and canonical turns."""

import itertools

import numpy as np

from riskfeatures.llm import chat
from riskfeatures.llm.queries import op5_chat

SCHEMA = "conv_id long, turn long, role string, text string"


def test_query(spark):
    rows = op5_chat(spark, "/root/testdata/sf0.01").collect()
    given = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert len(rows) == given.count()
    assert np.mean([r.role == r.found for r in rows]) >= 0.8


def test_viterbi_is_the_best_path(spark):
    hmm = chat.learn(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    lines = ["User: hi", "more", "Assistant: yo?"]
    scores = hmm.lines(np.array([chat.seen(t, i != 1) for i, t in enumerate(lines)]))
    value = lambda p: hmm.start[p[0]] + scores[0, p[0]] + sum(hmm.step[a, b] + scores[i + 1, b] for i, (a, b) in enumerate(zip(p, p[1:])))
    best = max(itertools.product(range(chat.N), repeat=3), key=value)
    assert tuple(chat.viterbi(hmm, scores, None, None)) == best
    assert [chat.STATES[s] for s in best] == [("user", True), ("user", False), ("assistant", True)]


def test_cut_conversations(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(5, t, ("user", "assistant")[t % 2], "\n".join("w " * int(n) for n in rng.integers(1, 80, rng.integers(1, 4)))) for t in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    hmm = chat.learn(df)
    whole = sorted(map(tuple, chat.recover_roles(df, hmm).collect()))
    monkeypatch.setattr(chat, "SEGMENT", 7)
    assert sorted(map(tuple, chat.recover_roles(df, hmm).collect())) == whole


def test_transcript_and_edges(spark):
    text = "### System:\nBe kind.\n<|user|> Who?\nAnd why?\n**Assistant:** Me."
    rows = [(1, 0, None, text), (1, 0, None, text), (2, None, "user", None), (None, 0, "x", ""), (3, 1, "user", "hello"), (3, 1, "user", "bye")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as line", "'y' as found")
    hmm = chat.learn(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    found = chat.recover_roles(df, hmm).where("conv_id = 1").orderBy("line").collect()
    assert "\n".join(r.rendered for r in found) == "<|system|>\n\nBe kind.\n<|user|>\nWho?\nAnd why?\n<|assistant|>\nMe."
    assert chat.digests(chat.recover_roles(df)).count() == 5
    assert chat.recover_roles(df.where("conv_id > 9"), hmm).collect() == []
