"""Ids and decoded texts against the sentencepiece library."""

import random

import pytest
from hypothesis import given, settings, strategies as st

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

from riskfeatures.llm.pieces import Codec, encode_pieces, vocabulary  # noqa: E402

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
CODEC = Codec(*vocabulary(MODEL))


def check(texts):
    ids, decoded = CODEC.encode(texts)
    for t, i, d in zip(texts, ids, decoded):
        right = LIBRARY.encode(t or "")
        assert i.tolist() == right, t
        assert d == LIBRARY.decode(right), t


def test_odd_texts():
    check(["", None, " ", "  a  b ", "a\n\nb\tc\r\n", "▁x ▁▁", "<s>hi</s> <0x41>", "\x00a", "\U0001f600̀ é", "don't", "A" * 5000, "ab" * 3000, "　x\xa0y"])
    check([" " * n + tail for n in range(70) for tail in ("", "the", "\U0001f600", "\x00", "x  y")])
    check(["a" * n for n in range(40)] + ["==" * n + "-" * n for n in range(40)])


def test_random_texts():
    rng = random.Random(5)
    letters = "abcdethein  \n.,XYZéß中ع\U0001f600=-_/0123"
    check(["".join(rng.choices(letters, k=rng.randrange(300))) for _ in range(400)])
    long = "".join(rng.choices("0123456789abcdef+/=", k=20_000))
    check([long])


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    check([text])


def test_frame(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (2, None, "y"), (2, None, "y"), (3, "", "z")], "doc_id long, text string, ids string")
    rows = encode_pieces(spark, df, MODEL).orderBy("doc_id").collect()
    assert [(r.doc_id, r.ids, r.decoded) for r in rows] == [(1, LIBRARY.encode("a b"), "a b"), (2, [], ""), (2, [], ""), (3, [], "")]
    assert encode_pieces(spark, df.where("doc_id > 9"), MODEL).collect() == []


def test_query(spark):
    from riskfeatures.llm.queries import op8_pieces
    import hashlib

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.doc_id: r for r in op8_pieces(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, r = LIBRARY.encode(d.text or ""), got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids)))
