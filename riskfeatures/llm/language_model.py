"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

The probability of a token is that of its class given the context, times that of the word
in its class. The most frequent words are dealt to classes by rank. The last class holds all
other words; it is split by a tree, at each node of which the context decides among a few
branches of about the same weight. A leaf of the tree is a word whose count every task has;
the words beyond these share leaves by their hash, and a leaf's words part it, with one unknown
word, in proportion to their counts plus a half. Where every word has a leaf, the unknown word
has one as well. So the probabilities of all known words and an unknown one of each shared leaf
add up to one in every context, and that of every token depends on its context.

Context features are hashed: the word before, the two words before, and, skipping words, the
second and the third word before. Each selects a row of weights, over classes in one table,
over the words of a class in another, and over the branches of a node in a third. All weights
start at zero, where the model is the
smoothed word frequency; they are trained in rounds of distributed gradient updates: every
partition takes its share of the round's documents through mini-batches from the same
weights, and the updates are averaged row by row, weighted by how often a partition saw the
row.

Defined results: no text counts as empty, which has one token, its end; a null doc_id counts
as the empty text where documents are dealt; repeated rows are scored one by one; without
any training document every probability is one; other columns of the input are left out.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import most_frequent, small_batches, stored

FOLDS, HELD_OUT = 5, 1
# Words whose counts go to every task, the most frequent ones; the rest is joined.
HEAD_WORDS = 1 << 18
CLASSES, CLASS_WORDS = 32, 48
BRANCHES = 16  # of a node of the tree that splits the last class
SHARED = 1 << 16  # leaves for the words beyond the head
CLASS_ROWS, WORD_ROWS, NODE_ROWS = 1 << 13, 1 << 14, 1 << 15  # rows of the hashed weight tables
FEATURES = 4
ROUNDS = 2
BATCH = 4096  # tokens of a mini-batch
RATE = 0.3
BLOCK_ROWS = 512
FLUSH = 1 << 20  # different words that a task counts before it passes them on

_PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_START = (1 << 40) + 1  # stands for the words before a text
_LOG10 = math.log(10.0)


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words between white space, then the end, which no word equals."""
    words = (text or "").encode().lower().split()
    words.append(b"")
    return words


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


# --- counts -----------------------------------------------------------------------------------


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c): how often each token occurs in the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "c"]
            )

        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update(tokens(text))
                if len(seen) >= FLUSH:
                    yield out()
                    seen.clear()
        yield out()

    partial = train.select("text").mapInArrow(count, "word binary, c bigint")
    return partial.groupBy("word").agg(F.sum("c").alias("c"))


# --- the model --------------------------------------------------------------------------------


def shared_leaf(crc: np.ndarray) -> np.ndarray:
    return crc % SHARED


def shared_masses(counts: DataFrame, words: list[bytes], head: list[int]) -> np.ndarray:
    """Counts plus a half of the words of each shared leaf: of all words but those of the head."""
    mass = np.zeros(SHARED)
    leaf = F.pmod(F.crc32("word"), F.lit(SHARED)).cast("int")
    for r in counts.groupBy(leaf.alias("leaf")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        mass[r.leaf] = r.c + 0.5 * r.n
    own = shared_leaf(np.array([zlib.crc32(w) for w in words], np.int64))
    return mass - np.bincount(own, np.array(head, float) + 0.5, SHARED)


class Tree:
    """Leaves of given masses under nodes of at most BRANCHES branches, in the leaves' order.

    A node parts its leaves by their masses, so that a leaf's depth follows from its share. The
    path of leaf i are places `ends[i]` to `ends[i + 1]` of `nodes` and `branches`.
    """

    def __init__(self, mass: np.ndarray):
        leaf, node = np.arange(len(mass)), np.zeros(len(mass), np.int64)
        up_to = np.cumsum(mass)
        middle, known = up_to - mass / 2, 0
        steps, biases = [], []
        while len(leaf) > 1:
            # the leaves of a node are neighbours
            first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            size = np.diff(first, append=len(leaf))
            begin = (up_to - mass)[leaf[first]]
            weight = up_to[leaf[first + size - 1]] - begin
            of = np.repeat(np.arange(len(first)), size)
            place = np.arange(len(leaf)) - first[of]
            by_mass = ((middle[leaf] - begin[of]) / weight[of] * BRANCHES).astype(np.int64)
            branch = np.where(size[of] <= BRANCHES, place, np.clip(by_mass, 0, BRANCHES - 1))
            steps.append((leaf, known + of, branch))
            below = np.bincount(of * BRANCHES + branch, mass[leaf], len(first) * BRANCHES).reshape(-1, BRANCHES)
            with np.errstate(divide="ignore"):
                biases.append(np.log(below / below.sum(axis=1, keepdims=True)).astype(np.float32))
            known += len(first)
            child = of * BRANCHES + branch
            more = np.bincount(child)[child] > 1
            leaf, node = leaf[more], child[more]
        self.bias = np.concatenate([*biases, np.empty((0, BRANCHES), np.float32)])
        found = [np.concatenate([[], *column]).astype(np.int32) for column in zip(*steps)] or [np.empty(0, np.int32)] * 3
        order = np.argsort(found[0], kind="stable")
        self.nodes, self.branches = found[1][order], found[2][order].astype(np.int8)
        self.ends = np.append(0, np.cumsum(np.bincount(found[0], minlength=len(mass)))).astype(np.int32)

    def paths(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each node on the way to some leaves: which of the leaves, the node, its branch."""
        begin, size = self.ends[leaves], self.ends[leaves + 1] - self.ends[leaves]
        which = np.repeat(np.arange(len(leaves)), size)
        at = np.arange(len(which)) + np.repeat(begin - (np.cumsum(size) - size), size)
        return which, self.nodes.take(at), self.branches.take(at)


class Model:
    """What every task needs: head words with their counts, the tree, and the weights.

    Its size is bounded by HEAD_WORDS, SHARED and the three tables, whatever the corpus.
    """

    def __init__(self, words: list[bytes], counts: list[int], total: int, distinct: int, shared: np.ndarray | None = None):
        """shared: counts plus a half of the words of each shared leaf, if not all are in one."""
        self.rank = {w: i for i, w in enumerate(words)}
        self.counts = np.array(counts, np.int64)
        self.total, self.distinct = total, distinct
        frequent = self.counts[: CLASSES * CLASS_WORDS].astype(float)
        self.modelled = len(frequent)  # the words of the classes but the last
        pad = np.zeros(CLASSES * CLASS_WORDS)
        pad[: self.modelled] = frequent + 0.5
        by_class = pad.reshape(CLASSES, CLASS_WORDS)
        if shared is None:
            shared = np.array([total - self.counts.sum() + 0.5 * (distinct - len(words))], float)
        self.shared = shared + 0.5  # and a half for the unknown word
        self.rest = self.shared.sum()
        # the last class: the other head words, then the shared leaves
        leaves = np.concatenate([self.counts[self.modelled :] + 0.5, self.shared])
        self.tree = Tree(leaves)
        mass = np.append(by_class.sum(axis=1), leaves.sum())
        with np.errstate(divide="ignore"):
            self.class_bias = np.log(mass / mass.sum()).astype(np.float32)
            self.word_bias = np.log(by_class / np.maximum(by_class.sum(axis=1, keepdims=True), 0.5)).astype(np.float32)
        self.tables = [
            np.zeros((CLASS_ROWS, CLASSES + 1), np.float32),
            np.zeros((WORD_ROWS, CLASS_WORDS), np.float32),
            np.zeros((NODE_ROWS, BRANCHES), np.float32),
        ]

    # ids: the rank of a head word; other words are hashed beyond the ranks
    def ids(self, words: list[bytes]) -> np.ndarray:
        out = np.fromiter(map(self.rank.get, words, repeat(-1)), np.int64, len(words))
        other = np.flatnonzero(out < 0)
        out[other] = [-1 - zlib.crc32(words[i]) for i in other.tolist()]
        return out

    def contexts(self, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Hashes of the context features, one row per token; place counts from the text's start."""
        before = [np.full(len(ids), _START, np.int64) for _ in range(3)]
        for k, b in enumerate(before, start=1):
            b[k:] = np.where(place[k:] >= k, ids[:-k], _START) if len(ids) > k else b[k:]
        one, two, three = (b.view(np.uint64) for b in before)
        with np.errstate(over="ignore"):
            out = np.stack(
                [
                    one * _PRIMES[0] + np.uint64(1),
                    one * _PRIMES[0] + two * _PRIMES[1] + np.uint64(2),
                    two * _PRIMES[2] + np.uint64(3),
                    three * _PRIMES[3] + np.uint64(4),
                ]
            )
            out ^= out >> np.uint64(29)
            out *= _PRIMES[1]
            return out.T  # the tokens of a feature lie together

    def classes(self, ids: np.ndarray) -> np.ndarray:
        return np.where((ids >= 0) & (ids < self.modelled), ids // CLASS_WORDS, CLASSES)

    def shares(self, ids: np.ndarray) -> np.ndarray:
        """The shared leaf of words beyond the head."""
        return shared_leaf(-1 - ids) if len(self.shared) > 1 else np.zeros(len(ids), np.int64)

    def leaves(self, ids: np.ndarray) -> np.ndarray:
        """The leaves of words of the last class."""
        out = ids - self.modelled
        beyond = np.flatnonzero(ids < 0)
        out[beyond] = len(self.counts) - self.modelled + self.shares(ids[beyond])
        return out

    def step(self, ids: np.ndarray, context: np.ndarray) -> list[tuple]:
        """Per softmax: its table, rows (features x tokens), probabilities before they are
        divided by their sums, the sums, target columns and tokens, a token once for each node
        on the way to its leaf."""
        cls, context = self.classes(ids), context.T
        rows = (context >> np.uint64(64 - CLASS_ROWS.bit_length() + 1)).view(np.int64)
        everyone = np.arange(len(ids))
        out = [(0, rows, *_softmax(self.tables[0], rows, self.class_bias[None, :]), cls, everyone)]
        inside = np.flatnonzero(cls < CLASSES)
        if len(inside):
            c = cls[inside]
            with np.errstate(over="ignore"):
                mixed = context.take(inside, axis=1)
                mixed += c.astype(np.uint64) * _PRIMES[2]
                mixed *= _PRIMES[0]
            rows = (mixed >> np.uint64(64 - WORD_ROWS.bit_length() + 1)).view(np.int64)
            out.append((1, rows, *_softmax(self.tables[1], rows, self.word_bias.take(c, axis=0)), ids[inside] % CLASS_WORDS, inside))
        last = np.flatnonzero(cls == CLASSES)
        which, node, branch = self.tree.paths(self.leaves(ids[last]))
        if len(which):
            which = last.take(which)
            with np.errstate(over="ignore"):
                mixed = context.take(which, axis=1)
                mixed += (node.astype(np.uint64) + np.uint64(1)) * _PRIMES[3]
                mixed *= _PRIMES[0]
            rows = (mixed >> np.uint64(64 - NODE_ROWS.bit_length() + 1)).view(np.int64)
            out.append((2, rows, *_softmax(self.tables[2], rows, self.tree.bias.take(node, axis=0)), branch, which))
        return out

    def logs(self, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Natural logarithms: of a head word its probability, of another one its leaf's."""
        out = np.zeros(len(ids))
        for lo, part, context in self.batches(ids, place):
            for _, _, p, total, target, which in self.step(part, context):
                found = np.log(np.maximum(p[np.arange(len(which)), target] / total[:, 0], 1e-30))
                out[lo : lo + len(part)] += np.bincount(which, found, len(part))
        return out

    def batches(self, ids: np.ndarray, place: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """First token, tokens and context hashes of each mini-batch."""
        for lo in range(0, len(ids), BATCH):
            back, hi = max(0, lo - 3), lo + BATCH
            yield lo, ids[lo:hi], self.contexts(ids[back:hi], place[back:hi])[lo - back :]

    def train(self, ids: np.ndarray, place: np.ndarray, squares: list[np.ndarray], seen: list[np.ndarray]) -> None:
        """Mini-batch gradient updates, with a step per row that shrinks with its past gradients."""
        for _, part, context in self.batches(ids, place):
            for t, rows, p, total, target, which in self.step(part, context):
                p /= total
                p[np.arange(len(which)), target] -= 1.0
                touched, gradient, times = _row_sums(rows, p)
                square = squares[t].take(touched)
                square += np.einsum("ij,ij->i", gradient, gradient)
                squares[t][touched] = square
                gradient *= (RATE / np.sqrt(1.0 + square))[:, None]
                self.tables[t][touched] = np.subtract(self.tables[t].take(touched, axis=0, mode="clip"), gradient, out=gradient)
                seen[t][touched] += times


def _softmax(table: np.ndarray, rows: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of each row and their sums, by which they are still to be divided."""
    # rows are in range, so `take` need not check them
    z = table.take(rows[0], axis=0, mode="clip")
    z += bias
    more = np.empty_like(z)
    for k in range(1, FEATURES):
        z += table.take(rows[k], axis=0, mode="clip", out=more)
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    return z, z.sum(axis=1, keepdims=True)


def _row_sums(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different rows, the sum of the values of their tokens, and how often each occurs."""
    rows = rows.T.astype(np.uint16, order="C").ravel()  # token by token; the tables have few enough rows
    order = np.argsort(rows, kind="stable")
    ordered = rows.take(order)
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    times = np.diff(first, append=len(rows))
    out = values.take(order.take(first) // FEATURES, axis=0, mode="clip")
    several = np.flatnonzero(times > 1)
    if len(several):
        # of rows that occur often, neighbours are added in pairs until each row is left once
        token = order[np.repeat(times > 1, times)] // FEATURES
        size = times[several]
        place = np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)
        at, odd = np.flatnonzero((place & 1) == 0), np.flatnonzero(place & 1)
        sums = values.take(token.take(at), axis=0, mode="clip")
        sums[odd - 1 - np.arange(len(odd))] += values.take(token.take(odd), axis=0, mode="clip")
        at, place = np.arange(len(at)), place.take(at) >> 1  # where those left lie, and which they are
        while len(odd := np.flatnonzero(place & 1)):
            sums[at.take(odd - 1)] += sums.take(at.take(odd), axis=0, mode="clip")
            even = np.flatnonzero((place & 1) == 0)
            at, place = at.take(even), place.take(even) >> 1
        out[several] = sums.take(at, axis=0, mode="clip")
    return ordered.take(first).astype(np.int64), out, times


def _places(lengths: list[int]) -> np.ndarray:
    """0, 1, 2, ... within each text."""
    n = np.array(lengths, np.int64)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _updated(docs: DataFrame, known) -> DataFrame:
    """One round: what each partition's updates did to each block of weight rows."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = known.value
        start = model.tables
        model.tables = [t.copy() for t in start]
        squares = [np.zeros(len(t), np.float32) for t in start]
        seen = [np.zeros(len(t), np.float32) for t in start]
        try:
            for batch in batches:
                words = [tokens(t) for t in batch.column("text").to_pylist()]
                lengths = [len(w) for w in words]
                model.train(model.ids(list(chain.from_iterable(words))), _places(lengths), squares, seen)
            for t, (old, new) in enumerate(zip(start, model.tables)):
                for lo in range(0, len(old), BLOCK_ROWS):
                    at = lo + np.flatnonzero(seen[t][lo : lo + BLOCK_ROWS])
                    if len(at):
                        yield pa.RecordBatch.from_pylist(
                            [{
                                "part": t, "block": lo, "at": at.astype(np.int32).tobytes(), "seen": seen[t][at].tobytes(),
                                "change": (new[at] - old[at]).astype(np.float16).tobytes(),
                            }],
                            schema=_CHANGES,
                        )
        finally:
            model.tables = start  # the worker may be used again

    return docs.select("text").mapInArrow(learn, _CHANGES_DDL)


_CHANGES_DDL = "part int, block int, at binary, seen binary, change binary"
_CHANGES = pa.schema(
    [("part", pa.int32()), ("block", pa.int32()), ("at", pa.binary()), ("seen", pa.binary()), ("change", pa.binary())]
)


def _averaged(changes: DataFrame) -> DataFrame:
    """Changes of each block summed over partitions, weighted by how often rows were seen.

    A task holds the sums of its blocks alone, at most all tables.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            for r in batch.to_pylist():
                at, seen = np.frombuffer(r["at"], np.int32), np.frombuffer(r["seen"], np.float32)
                change = np.frombuffer(r["change"], np.float16).reshape(len(at), -1).astype(np.float64)
                total, weight = sums.setdefault(
                    (r["part"], r["block"]), [np.zeros((BLOCK_ROWS, change.shape[1])), np.zeros(BLOCK_ROWS)]
                )
                total[at - r["block"]] += change * seen[:, None]
                weight[at - r["block"]] += seen
        for (part, block), (total, weight) in sums.items():
            at = np.flatnonzero(weight)
            yield pa.RecordBatch.from_pylist(
                [{
                    "part": part, "block": block, "at": (at + block).astype(np.int32).tobytes(), "seen": b"",
                    "change": (total[at] / weight[at, None]).astype(np.float32).tobytes(),
                }],
                schema=_CHANGES,
            )

    return changes.repartition("part", "block").mapInArrow(add, _CHANGES_DDL)


def train(spark: SparkSession, docs: DataFrame, counts: DataFrame, rounds: int = ROUNDS, head_words: int = HEAD_WORDS) -> Model:
    """The model of the given training texts, which all take part, each in one round."""
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    head = sorted((-r.c, bytes(r.word)) for r in most_frequent(counts, "c", head_words).collect())
    words, times = [w for _, w in head], [-c for c, _ in head]
    shared = shared_masses(counts, words, times) if sums[1] > len(words) else None
    model = Model(words, times, sums[0], sums[1], shared)
    for r in range(rounds):
        share = docs.where(F.floor(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) / FOLDS) % rounds == r)
        known = spark.sparkContext.broadcast(model)
        # at most one row per block of the tables comes back
        for row in _averaged(_updated(share, known)).collect():
            at = np.frombuffer(row.at, np.int32)
            model.tables[row.part][at] += np.frombuffer(row.change, np.float32).reshape(len(at), -1)
        known.unpersist()
    return model


# --- scores -----------------------------------------------------------------------------------

_SCORED_DDL = "doc_id bigint, n_tokens bigint, n_head bigint, head_log double, model_log double, rare array<struct<word: binary, times: bigint>>"
_RARE = pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())]))


def _scored(docs: DataFrame, known) -> DataFrame:
    """Sums over the tokens of each text that need no join, and its words beyond the head."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = known.value
        logs = np.log10(model.counts + 0.5)
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = [tokens(t) for t in batch.column("text").to_pylist()]
            lengths = np.array([len(w) for w in texts])
            words = list(chain.from_iterable(texts))
            ids = model.ids(words)
            starts = np.cumsum(lengths) - lengths
            known_word = ids >= 0
            counted = np.where(known_word, logs[np.maximum(ids, 0)] if len(logs) else 0.0, 0.0)
            natural = model.logs(ids, _places(lengths))
            total = natural / _LOG10
            # words beyond the head: their share of the leaf, whose counts are joined later
            beyond = np.flatnonzero(~known_word)
            total[beyond] -= np.log10(model.shared)[model.shares(ids[beyond])]
            bounds = np.searchsorted(beyond, np.append(starts, len(ids))).tolist()
            beyond = beyond.tolist()
            rare, ends = [], [0]
            for at, end in zip(bounds, bounds[1:]):
                if end > at:
                    rare.extend(Counter(words[i] for i in beyond[at:end]).items())
                ends.append(len(rare))
            items = pa.StructArray.from_arrays(
                [pa.array([w for w, _ in rare], pa.binary()), pa.array([n for _, n in rare], pa.int64())], ["word", "times"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(np.add.reduceat(known_word, starts, dtype=np.int64)),
                    pa.array(np.add.reduceat(counted, starts)),
                    pa.array(np.add.reduceat(total, starts)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items),
                ],
                ["doc_id", "n_tokens", "n_head", "head_log", "model_log", "rare"],
            )

    return docs.select("doc_id", "text").mapInArrow(score, _SCORED_DDL)


def score_texts(spark: SparkSession, docs: DataFrame, rounds: int = ROUNDS, head_words: int = HEAD_WORDS) -> DataFrame:
    """Scores of all texts by a model of those that are not held out.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (smoothed word
    frequency) and score (the model), both log10 probabilities of the whole text.
    """
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learnt = docs.where(~held_out(F.col("doc_id")))
    counts = stored(word_counts(learnt), "counts")
    model = train(spark, learnt, counts, rounds, head_words)
    # the row number is written with the row, so it stays the same whatever is run again
    rows = stored(
        _scored(docs, spark.sparkContext.broadcast(model)).withColumn("row_no", F.monotonically_increasing_id()), "scored"
    )
    # Words beyond the head occur in few texts each, so no key of this join is hot.
    rare = (
        rows.select("row_no", F.explode("rare").alias("r")).select("row_no", "r.word", "r.times")
        .join(counts, "word", "left")
        .groupBy("row_no")
        .agg(
            F.sum(F.expr("times * log10(coalesce(c, 0) + 0.5d)")).alias("rare_log"),
            F.sum(F.expr("case when c > 0 then times else 0 end")).alias("rare_known"),
        )
    )
    base = math.log10(model.total + 0.5 * (model.distinct + 1))
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return rows.join(rare, "row_no", "left").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("n_head") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        (F.col("head_log") + rare_log - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        (F.col("model_log") + rare_log).alias("score"),
    )
