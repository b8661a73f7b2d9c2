"""Spelling variants against all pairs."""

import re
import zlib
from collections import Counter

import pytest

from riskfeatures.llm import spelling
from riskfeatures.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def words_of(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def edited_once(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, meet=None):
    """meet: words that may be near one, all others by default."""
    near = {w: [v for v in (words if meet is None else meet(w)) if edited_once(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), None if form[w] is None else words[form[w]]))
    return sorted(out)


def rows_of(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_query_against_all_pairs(spark):
    words = words_of((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())
    by_shape = {}
    for w in words:
        for i in range(len(w)):
            by_shape.setdefault(w[:i] + w[i + 1 :], set()).add(w)
        by_shape.setdefault(w, set()).add(w)

    def meet(w):  # words that share one with a letter dropped, or are one
        return {v for x in [w, *(w[:i] + w[i + 1 :] for i in range(len(w)))] for v in by_shape.get(x, ())} - {w}

    got = rows_of(QUERIES["op12_spelling"](spark, SF_DIR))
    assert got == brute(words, meet) and any(r[4] for r in got)


def text(words):
    return " ".join(w for w, n in words.items() for _ in range(n))


CHAIN = {"abcdefgh": 2, "abcdefghi": 20, "abcdefghij": 200, "abcdefghijk": 2000, "xbcdefghijk": 2, "abcdefghijkl": 1999, "aaaaaaa": 3, "aaaaaaaa": 2, "aaaaaaaaa": 40, "abababa": 5, "bababab": 5, "abababab": 50, "éèêëàâä": 2, "éèêëàâäç": 20, "zzzzzzz": 2, "yzzzzzz": 20, "zzzzzzy": 20}


@pytest.mark.parametrize("hot", [1, 2, 3, 100])
def test_chains_ties_and_tiles(spark, hot):
    rows = [(7, text(CHAIN)), (8, None), (None, ""), (9, "short " * 5 + "ABABABA")]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n int, word string")
    got = rows_of(spelling.group_variants(docs, hot=hot))
    assert got == brute(words_of(rows))
    assert {r[0]: r[2] for r in got}["abcdefgh"] == "abcdefghijk"


def test_one_first_part_for_all_words(spark):
    """A key that holds every word, cut into tiles: the same rows as uncut."""
    words = {f"commonpart{chr(97 + i)}{chr(97 + j)}": 2 + 30 * (i == j) for i in range(12) for j in range(12)}
    docs = spark.createDataFrame([(1, text(words))], "doc_id long, text string")
    assert rows_of(spelling.group_variants(docs, hot=20)) == brute(words_of([(1, text(words))]))


def test_very_long_words_and_empty_tables(spark):
    long = "abcdefghij" * 800
    rows = [(3, f"{long} {long} {long}x {long}x"), (3, f"{long} {long}x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(spelling.group_variants(docs)) == brute(words_of(rows))
    assert spelling.group_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
