"""Spelling variants: words one edit apart, grouped under their most frequent form.

Two words of lengths m and m or m + 1 that differ by one edit agree in their first m // 2
code points, or in their last m - m // 2. So near words meet under one of these keys. The
words under a key form a bit-sliced index: per position and letter, a bitset over the words.
One pass over the positions carries bitsets of the words that match a query so far without an
error and with one replaced, missing or additional code point, the latter two against shifted
positions; every step is a few word-parallel operations for all queries at once. Pairs are
never emitted: a task passes on, per word, the number of near words and the best of them.

A key with more than HOT words is cut into tiles, each with the queries of one block and the
index of another, so that no task holds more; all tiles together compare all of its words.

Defined results: no text counts as empty; repeated rows count repeatedly; a null doc_id is
written as nothing before the colon; other columns of the input are left out; an empty table
gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import stored

LEAST_LENGTH, LEAST_TIMES, RATIO = 7, 2, 10
DROP_EVERY = 31  # of the occurrences, by hash, one of so many loses a letter
HOT = 1 << 14  # words of a tile
PACK = 512  # keys are put together until they have so many words
FLUSH = 1 << 20
# Shorter runs give no word, with or without a letter dropped.
RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")
# A form has RATIO times the occurrences of its variant, so no chain of forms is longer.
DOUBLINGS = 5


def _variant(doc_id: int | None, run: str) -> str:
    """The run, or the run without one letter, as the hash of document and run decides."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % DROP_EVERY:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1 :]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts that are long and frequent enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if not text:
                    continue
                # lower-cases A-Z alone
                for run, times in Counter(RUN.findall(text.encode().lower().decode())).items():
                    word = _variant(doc_id, run)
                    if len(word) >= LEAST_LENGTH:
                        seen[word] += times
                if len(seen) >= FLUSH:
                    yield out()
                    seen.clear()
        yield out()

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = docs.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST_TIMES)


def keyed(words: DataFrame, hot: int = HOT) -> DataFrame:
    """Words under the keys at which near words meet: one row per word, key and tile.

    `m` is the shorter length of the pairs sought there; `half` tells whether the first or
    the last part is the key. `asks` and `holds` tell whether the word is a query of the tile,
    part of its index, or both.
    """
    size = F.length("word")
    m = F.explode(F.array(size, size - 1)).alias("m")
    rows = words.select("word", "n", size.alias("size"), m)
    head, tail = F.expr("left(word, m div 2)"), F.expr("substring(word, 1 + size - (m - m div 2))")
    half = F.explode(F.array(F.struct(F.lit(0).alias("half"), head.alias("key")), F.struct(F.lit(1).alias("half"), tail.alias("key"))))
    rows = rows.select("word", "n", "m", half.alias("k")).select("word", "n", "m", "k.*")
    # a word of length LEAST_LENGTH has no shorter partner
    rows = rows.where(F.col("m") >= LEAST_LENGTH)
    group = ["m", "half", "key"]
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("words")).where("words > 1")
    rows = rows.join(sizes, group)
    blocks = F.ceil(F.col("words") / hot).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("word"), "blocks").cast("int"))
    # in tile (i, j) the words of block i ask and those of block j are held
    tiles = F.expr(
        """case when blocks = 1 then array(struct(0 as i, 0 as j, true as asks, true as holds))
        else concat(
          transform(sequence(0, blocks - 1), x -> struct(block as i, x as j, true as asks, x = block as holds)),
          transform(filter(sequence(0, blocks - 1), x -> x <> block), x -> struct(x as i, block as j, false as asks, true as holds)))
        end"""
    )
    return rows.select("word", "n", *group, F.explode(tiles).alias("t")).select("word", "n", *group, "t.*")


# --- the index --------------------------------------------------------------------------------


def _bitset_rows(member: np.ndarray) -> np.ndarray:
    """Rows of booleans, the last axis packed into 64-bit words."""
    pad = -member.shape[-1] % 64
    if pad:
        member = np.concatenate([member, np.zeros((*member.shape[:-1], pad), bool)], axis=-1)
    return np.packbits(member, axis=-1, bitorder="little").view(np.uint64)


def near_bits(m: int, half: int, queries: list[str], held: list[str], groups: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each query the bitset of held words at one edit that meet at this key.

    Lengths are m or m + 1, and pairs of two longer words belong to another key. Pairs that
    agree in their first m // 2 code points are left to that key. `groups` number the keys of
    queries and held words, since small keys share an index.
    """
    letters = {c: i for i, c in enumerate(sorted(set("".join(queries)) | set("".join(held))))}
    none = len(letters)  # stands at places beyond the end
    code = lambda ws: np.array([[letters[c] for c in w] + [none] * (m + 2 - len(w)) for w in ws], np.int32)
    q, w = code(queries), code(held)
    q_long, w_long = (np.array([len(x) > m for x in ws]) for ws in (queries, held))
    # bits[p][a]: held words with letter a at place p
    bits = [_bitset_rows(w[:, p][None, :] == np.arange(none)[:, None]) for p in range(m + 2)]
    empty = np.zeros((1, bits[0].shape[1]), np.uint64)
    bits = [np.concatenate([b, empty]) for b in bits]  # no word matches a missing letter
    alive = _bitset_rows((groups[0][:, None] == groups[1][None, :]) & ~(q_long[:, None] & w_long[None, :]))

    exact, replaced = alive, np.zeros_like(alive)
    missing, more = np.zeros_like(alive), np.zeros_like(alive)  # of the query in the word, of the word over the query
    agreed = None
    out = np.zeros_like(alive)
    has = lambda p: _bitset_rows((w[:, p] != none)[None, :])
    short = _bitset_rows(~w_long[None, :])
    for i in range(m + 1):
        if i == m // 2:
            agreed = exact
        if i == m:  # queries of length m end here
            end = np.where(q_long[:, None], np.uint64(0), (replaced & short) | ((more | exact) & ~short))
            out |= end
        here = bits[i][q[:, i]]
        missing, more, replaced, exact = (
            ((missing & bits[i - 1][q[:, i]]) if i else missing) | exact,
            (more | exact) & bits[i + 1][q[:, i]],
            (replaced & here) | (exact & ~here & has(i)),
            exact & here,
        )
    # queries of length m + 1: words of length m, one code point fewer
    out |= np.where(q_long[:, None], missing & short, np.uint64(0))
    return out & ~agreed if half else out & agreed


def _best(m: int, half: int, asks: list[tuple], holds: list[tuple]) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, count of the best, the best) for queries with near words."""
    if not asks or not holds:
        return
    # the best comes first: most frequent, then smallest
    holds = sorted(holds, key=lambda r: (-r[1], r[0]))
    held_group = np.array([r[2] for r in holds])
    words = [r[0] for r in holds]
    for lo in range(0, len(asks), PACK):
        some = asks[lo : lo + PACK]
        bits = near_bits(m, half, [r[0] for r in some], words, (np.array([r[2] for r in some]), held_group))
        counts = np.bitwise_count(bits).sum(axis=1)
        for i in np.flatnonzero(counts):
            slot = int(np.argmax(bits[i] != 0))
            lowest = int(bits[i, slot])
            at = slot * 64 + (lowest & -lowest).bit_length() - 1
            yield some[i][0], int(counts[i]), holds[at][1], holds[at][0]


_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs through tiles in order, several small ones at a time."""
    tile, number, level = None, 0, None
    asks: list[tuple] = []
    holds: list[tuple] = []

    def done() -> Iterator[pa.RecordBatch]:
        found = list(_best(*level, asks, holds)) if level else []
        asks.clear()
        holds.clear()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), _NEAR.types)], schema=_NEAR)

    for batch in batches:
        for m, half, key, i, j, word, n, asking, holding in zip(*(batch.column(c).to_pylist() for c in _ORDER)):
            if (m, half, key, i, j) != tile:
                if (m, half) != level or len(holds) >= PACK or len(asks) >= PACK:
                    yield from done()
                tile, level, number = (m, half, key, i, j), (m, half), number + 1
            if asking:
                asks.append((word, n, number))
            if holding:
                holds.append((word, n, number))
    yield from done()


_ORDER = ["m", "half", "key", "i", "j", "word", "n", "asks", "holds"]


def near_words(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have near words."""
    tiles = keyed(words, hot).select(*_ORDER)
    found = tiles.repartition("m", "half", "key", "i", "j").sortWithinPartitions(*_ORDER).mapInArrow(
        _match, "word string, n_near bigint, best_n bigint, best string"
    )
    # the most frequent one, ties to the smallest in code-point order, which is that of UTF-8
    rank = F.struct((-F.col("best_n")).alias("a"), F.col("best").alias("b"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(rank).alias("r")).select(
        "word", "n_near", (-F.col("r.a")).alias("best_n"), F.col("r.b").alias("best")
    )


def group_variants(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """Words with their form, the root that the forms lead to, and counts."""
    words = stored(word_counts(docs), "words")
    forms = words.join(near_words(words, hot), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(F.col("best_n") >= RATIO * F.col("n"), F.col("best")).alias("form"),
        F.when(F.col("best_n") >= RATIO * F.col("n"), F.col("best_n")).alias("form_n"),
    )
    forms = stored(forms, "forms")
    # Only words with a form are followed; each round doubles the length of what is known.
    links = forms.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        links = stored(links.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "links")
    return forms.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
