"""Alignment against a token-by-token merge, with A encoded by the other library's file."""

import hashlib
import random
import sys

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

from riskfeatures.llm import alignment  # noqa: E402
from riskfeatures.llm.queries import QUERIES  # noqa: E402

A = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
FILES = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))
SF_DIR = "/root/testdata/sf0.001"

_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE = {chr(b): b for b in _PLAIN} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in _PLAIN)}


def spelt(text):
    """(id, bytes) of both sides, or none."""
    if not text:
        return None
    a = [(i, bytes(_BYTE[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(B.id_to_piece(i)[1:-1], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()) for i in B.encode(text)]
    want = (" " + text).encode()
    return (a, b) if all(b"".join(t for _, t in side) == want for side in (a, b)) else None


def brute(rows):
    out, held = [], {}
    for doc_id, text in rows:
        sides = spelt(text)
        if sides is None:
            out.append((doc_id, 0, 0, [], []))
            continue
        spans = []
        for side in sides:
            end, own = 0, []
            for i, t in side:
                own.append((end, end + len(t), i))
                end += len(t)
            spans.append(own)
        links = [(i, j) for s, e, i in spans[0] for u, v, j in spans[1] if s < v and u < e]
        common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, before = [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for s, e, i in own if before <= s and e <= end) for own in spans))
            before = end
        for p in set(links):
            held[p] = held.get(p, 0) + 1
        out.append((doc_id, len(spans[0]), len(spans[1]), groups, links))
    best = {}
    for (i, _), n in held.items():
        best[i] = max(best.get(i, 0), n)
    return sorted(
        (
            d, na, nb, len(g), len(ls), sum(held[p] == best[p[0]] for p in ls), sum(held[p] for p in ls),
            hashlib.sha256(";".join(g).encode()).hexdigest() if na else "",
        )
        for d, na, nb, g, ls in out
    )


def rows_of(df):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted(tuple(r[n] for n in names) for r in df.collect())


ODD = [
    (1, None), (2, ""), (3, " "), (4, "plain words here"), (5, "▁ not spelt"), (6, "naïve 中文 \U0001f600 é́"),
    (7, "<s> <|endoftext|> <0x41>\n\n\tx"), (8, "a" * 300), (9, "plain words here"), (4, "plain words here"), (10, "don't 'tis"), (11, "\x00\x01"),
]


@pytest.mark.parametrize("piece, head", [(1, 0), (2, 5), (7, 1 << 20), (alignment.PIECE, alignment.HEAD_PAIRS)])
def test_rows_against_a_plain_merge(spark, piece, head):
    docs = spark.createDataFrame([(d, t, "x", 3) for d, t in ODD], "doc_id long, text string, pairs string, row_no int").repartition(3)
    assert rows_of(alignment.align(spark, docs, *FILES, piece=piece, head_pairs=head)) == brute(ODD)


def test_query_against_a_plain_merge(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect() if len(r.text or "") < 4000]
    got = QUERIES["op13_alignment"](spark, SF_DIR)
    all_rows = rows_of(got)
    assert len(all_rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    mine = {r[0]: r for r in all_rows}
    # groups and links need no other document; counts of all documents are compared above
    for r in brute(docs):
        assert mine[r[0]][:5] == r[:5] and mine[r[0]][7] == r[7]


def test_cuts_share_the_work_and_agree_with_one_piece():
    rng = np.random.default_rng(3)
    for _ in range(50):
        total = int(rng.integers(1, 200))
        a, b = (np.unique(np.append(rng.integers(1, total + 1, int(rng.integers(0, 60))), total)) for _ in range(2))
        whole = alignment.overlaps(a, b, 1 << 20)
        for piece in (1, 2, 3, 16):
            i, j = alignment.cut_points(a, b, piece)
            assert (np.diff(i) + np.diff(j))[:-1].tolist() == [piece] * (len(i) - 2)
            for x, y in zip(whole, alignment.overlaps(a, b, piece)):
                assert x.tolist() == y.tolist()
        assert len(whole[0]) == len(set(a) | set(b)) and whole[2].sum() == len(set(a) & set(b))


def test_same_ids_as_the_other_library_on_odd_texts():
    t = alignment.Tokenizers(*FILES)
    rng = random.Random(1)
    texts = ["".join(rng.choices("abc xyz\n\t .,'éß中\U0001f600　0123²-_", k=rng.randrange(1, 200))) for _ in range(300)]
    texts += ["a" * 20_000, " " * 20_000, "\n" * 5000, "ab1" * 5000, "-" * 9000]
    for text, (a, _) in zip(texts, t.encode(texts)):
        assert a in ([], A.encode(" " + text, add_special_tokens=False).ids)


def test_groups_are_written_without_a_step_for_each():
    """The digests of a batch take a few calls a text, however many groups the texts have."""
    t = alignment.Tokenizers(*FILES)
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["naïve", "中文", "tokens", "un\nlike", "12345", "x"], k=2_000))) for i in range(3)] + [(3, None)]
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        got = alignment._aligned([d for d, _ in rows], [x for _, x in rows], t, alignment.PIECE).to_pydict()
    finally:
        sys.setprofile(None)
    want = brute(rows)
    assert [tuple(got[c][i] for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")) for i in range(4)] == [(*r[1:5], r[7]) for r in want]
    assert calls < sum(got["n_groups"]) / 4


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(spark, docs, *FILES).collect() == []
    docs = spark.createDataFrame([(None, None), (None, "x")], "doc_id long, text string")
    assert sorted(r.n_a for r in alignment.align(spark, docs, *FILES).collect()) == [0, 1]
