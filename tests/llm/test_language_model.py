"""The language model: counts and base scores by hand, scores token by token, one whole mass."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from riskfeatures.llm import language_model as lm
from riskfeatures.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def plain_tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for white in "\t\n\x0b\x0c\r":
        lower = lower.replace(white, " ")
    return [w for w in lower.split(" ") if w] + [None]


def brute(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) of each row."""
    c = Counter(t for d, text in rows if fold(d) != 1 for t in plain_tokens(text))
    total, distinct = sum(c.values()), len(c)
    out = []
    for d, text in rows:
        ts = plain_tokens(text)
        base = sum(math.log10((c[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in ts)
        out.append((d, fold(d) == 1, len(ts), sum(c[t] > 0 for t in ts), total, base))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[2], round(r[5], 6))


def agree(df, rows):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in df.collect()), key=key)
    want = sorted(brute(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) <= 1e-9 * max(1, abs(w[5])) for g, w in zip(got, want))
    return got


def test_query_counts_and_beats_word_frequency_on_held_out_texts(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = agree(QUERIES["op11_language_model"](spark, SF_DIR), rows)
    kept, held = ([g for g in got if g[1] is h] for h in (False, True))
    assert held and all(math.isfinite(g[6]) and g[6] < 0 for g in got)
    for part in (kept, held):
        assert sum(g[6] for g in part) > sum(g[5] for g in part)


ODD = [
    (1, None), (2, ""), (3, "The the\tTHE\x0bcat dog É é"), (4, "the cat sat on the mat " * 30), (4, "the cat sat on the mat " * 30),
    (5, "unseen words only"), (None, "the cat"), (6, "a b c " * 3000), (7, " wide blank"),
]


@pytest.mark.parametrize("head", [0, 3, 1 << 18])
def test_odd_rows(spark, head):
    docs = spark.createDataFrame([(d, t, 1.0, 2) for d, t in ODD], "doc_id long, text string, score double, row_no int").repartition(3)
    got = agree(lm.score_texts(spark, docs, head_words=head), ODD)
    same = [g[6] for g in got if g[0] == 4]
    assert same[0] == same[1]


def trained(spark, rows, head=1 << 18):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return lm.train(spark, docs, lm.word_counts(docs), rounds=2, head_words=head)


def test_probabilities_add_up_to_one(spark):
    rows = [(i, " ".join(f"w{(i * j * j) % 1500}" for j in range(300))) for i in range(40)]
    model = trained(spark, rows)
    assert any(np.abs(t).sum() > 0 for t in model.tables)
    vocabulary = list(model.rank)
    for before in ([], [b"w1"], [b"w4", b"zzz", b"w9"], [b"w25", b"w1024", b"w0", b"w16"]):
        texts = [[*before, w] for w in [*vocabulary, b"never seen"]]
        logs = [model.logs(model.ids(t), np.arange(len(t)))[-1] for t in texts]
        counts = [*model.counts, 0]
        inside = [i < model.modelled for i in range(len(vocabulary))] + [False]
        mass = sum(math.exp(v) * (1 if ok else (n + 0.5) / model.rest) for v, ok, n in zip(logs, inside, counts))
        assert abs(mass - 1) < 1e-4


def test_scores_token_by_token(spark):
    """The frame's scores are the sums of single token probabilities, computed one by one."""
    rows = [(i, " ".join(f"w{(i * j * j) % 1500}" for j in range(200))) for i in range(60)]
    kept = [r for r in rows if fold(r[0]) != 1]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.score for r in lm.score_texts(spark, docs).collect()}
    learnt = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).where(~lm.held_out(lm.F.col("doc_id")))
    model = lm.train(spark, learnt, lm.word_counts(learnt))
    assert model.total == sum(len(plain_tokens(t)) for _, t in kept)

    def one(before, word):
        cls = lm.CLASSES if word not in model.rank or model.rank[word] >= model.modelled else model.rank[word] // lm.CLASS_WORDS
        ids = model.ids([*before[-3:], word])
        hashes = model.contexts(ids, np.arange(len(ids)) + (len(before) - len(before[-3:])))[-1]
        bits = lambda h, n: int(h) >> (65 - n.bit_length())
        z = model.class_bias.astype(float) + sum(model.tables[0][bits(h, lm.CLASS_ROWS)].astype(float) for h in hashes)
        p = math.exp(z[cls]) / sum(math.exp(v) for v in z)
        if cls == lm.CLASSES:
            return p * ((model.counts[model.rank[word]] if word in model.rank else 0) + 0.5) / model.rest
        mixed = [((int(h) + cls * int(lm._PRIMES[2])) * int(lm._PRIMES[0])) % 2**64 for h in hashes]
        z = model.word_bias[cls].astype(float) + sum(model.tables[1][bits(h, lm.WORD_ROWS)].astype(float) for h in mixed)
        return p * math.exp(z[model.rank[word] % lm.CLASS_WORDS]) / sum(math.exp(v) for v in z)

    for doc_id, text in rows[:8]:
        words = [b"" if w is None else w.encode() for w in plain_tokens(text)]
        want = sum(math.log10(one(words[:i], w)) for i, w in enumerate(words))
        assert abs(got[doc_id] - want) < 1e-3 * len(words)


def test_empty_tables(spark):
    assert lm.score_texts(spark, spark.createDataFrame([], "doc_id long, text string")).collect() == []
    only = next(i for i in range(100) if fold(i) == 1)
    docs = spark.createDataFrame([(only, "held out")], "doc_id long, text string")
    (row,) = lm.score_texts(spark, docs).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.base_score == 0 and abs(row.score) < 1e-9


def test_row_sums_and_ids():
    rng = np.random.default_rng(1)
    for tokens in (1, 2, 700):
        rows = (rng.integers(0, 40, (lm.FEATURES, tokens)) ** 2).astype(np.int64)
        values = rng.integers(-9, 9, (tokens, 5)).astype(np.float32)
        touched, sums, times = lm._row_sums(rows, values)
        assert touched.tolist() == sorted(set(rows.ravel().tolist()))
        for at, total, n in zip(touched, sums, times):
            hits = (rows == at).sum(axis=0)
            assert n == hits.sum() and (total == hits @ values).all()
    model = lm.Model([b"a", b"", b"b"], [5, 3, 1], 9, 3)
    assert model.ids([b"b", b"other", b"a", b""]).tolist() == [2, -1 - lm.zlib.crc32(b"other"), 0, 1]
    # the features of a token are rows, the tokens of a feature lie together
    assert model.contexts(np.arange(9), np.arange(9)).T.flags.c_contiguous


def learnt(pairs, head):
    """A model of texts of two words, whose words beyond the `head` most frequent share leaves."""
    counts = Counter(w for pair in pairs for w in (*pair, b""))
    ranked = sorted(counts, key=lambda w: (-counts[w], w))
    beyond = ranked[head:]
    shared = np.zeros(lm.SHARED)
    for w in beyond:
        shared[zlib.crc32(w) % lm.SHARED] += counts[w] + 0.5
    model = lm.Model(ranked[:head], [counts[w] for w in ranked[:head]], sum(counts.values()), len(counts), shared if beyond else None)
    squares, seen = ([np.zeros(len(t), np.float32) for t in model.tables] for _ in range(2))
    ids = model.ids([w for pair in pairs for w in (*pair, b"")])
    model.train(ids, np.arange(len(ids)) % 3, squares, seen)
    return model, counts, beyond


def log_after(model, before, words):
    texts = [[*before, w] for w in words]
    return np.array([model.logs(model.ids(t), np.arange(len(t)))[-1] for t in texts])


@pytest.mark.parametrize("head", [1 << 18, 1900])
def test_every_word_depends_on_its_context(head):
    """Not only the words of the classes: 20 rare words come after one word each."""
    rng = np.random.default_rng(4)
    often = [b"w%d" % i for i in np.append(rng.permutation(2200), rng.integers(0, 2200, 79_800)).tolist()]
    pairs = [*zip(often[::2], often[1::2]), *((b"a%d" % i, b"b%d" % i) for i in range(20) for _ in range(12))]
    model, counts, beyond = learnt([pairs[i] for i in rng.permutation(len(pairs))], head)
    after = [b"b%d" % i for i in range(20)]
    assert all(model.rank.get(w, head) >= model.modelled for w in after) and all(w in beyond for w in after) == (head == 1900)
    for i, w in enumerate(after):
        own, other = (log_after(model, [b], [w])[0] for b in (b"a%d" % i, b"w5"))
        assert own - other > 1


def test_words_with_and_without_a_leaf_add_up_to_one():
    rng = np.random.default_rng(3)
    names = [b"v%d" % i for i in np.append(rng.permutation(3000), rng.integers(0, 1500, 6000)).tolist()]
    model, counts, beyond = learnt(list(zip(names[::2], names[1::2])), 2000)
    assert len(beyond) > 300 and model.modelled == lm.CLASSES * lm.CLASS_WORDS < 2000
    leaf = {w: zlib.crc32(w) % lm.SHARED for w in beyond}
    for before in ([], [names[0]], [b"v3", beyond[0]]):
        inside = np.exp(log_after(model, before, list(model.rank))).sum()
        # of the shared leaves those without a known word hold an unknown one alone
        ids = np.append([-1 - zlib.crc32(w) for w in beyond], -1 - np.arange(lm.SHARED))
        known = model.ids(before)
        logs = [model.logs(np.append(known, i), np.arange(len(before) + 1))[-1] for i in ids[: len(beyond)]]
        shares = [math.exp(v) * (counts[w] + 0.5) / model.shared[leaf[w]] for v, w in zip(logs, beyond)]
        many = ids[len(beyond) :]
        texts = np.concatenate([np.append(known, i) for i in many])
        n = len(known) + 1
        last = model.logs(texts, np.tile(np.arange(n), len(many)))[n - 1 :: n]
        unknown = (np.exp(last) * 0.5 / model.shared[np.arange(lm.SHARED)]).sum()
        assert abs(inside + sum(shares) + unknown - 1) < 1e-3


def test_masses_of_shared_leaves(spark):
    rows = [(i, " ".join(f"u{i}-{j}" for j in range(50)) + " often" * 9) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = lm.train(spark, docs, lm.word_counts(docs), rounds=1, head_words=100)
    want = np.full(lm.SHARED, 0.5)
    for w in {w for _, t in rows for w in t.split()} - {"often"}:
        want[zlib.crc32(w.encode()) % lm.SHARED] += 1.5
    assert sorted(model.rank) == [b"", b"often"] and (model.shared == want).all()


def test_tree_parts_by_mass():
    rng = np.random.default_rng(2)
    for n in (1, 2, lm.BRANCHES, lm.BRANCHES + 1, 3000):
        mass = rng.pareto(1.0, n) + 0.5
        tree = lm.Tree(mass)
        which, node, branch = tree.paths(np.arange(n))
        found = np.exp(np.bincount(which, tree.bias[node, branch].astype(float), n))
        assert np.allclose(found, mass / mass.sum(), rtol=1e-4)
