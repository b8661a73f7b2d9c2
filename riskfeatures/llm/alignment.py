"""Alignment of two tokenizers' tokens over the same bytes.

The tokens of a text's two encodings are two sequences of ends. Merging them gives the bytes'
common grid: every distinct end closes one overlap of an A token with a B token, every common
end closes a group. The ends of all texts of a batch are laid out one after the other and
merged in pieces of equal work: a binary search on each diagonal of the merge matrix finds
where both sequences are cut, so that a very long text is many pieces and many short ones are
few. Pieces are independent of each other; each emits its overlaps and the common ends in it,
and numbering the common ends over all pieces stitches the groups that lie across a cut.

Counts of id pairs are those of all documents. The most frequent pairs, a bounded number, go
to every task; the pairs beyond them are joined.

Defined results: texts that are null or empty, or whose tokens do not spell the blank and the
text, have zeros and an empty digest; repeated rows are documents of their own; other columns
of the input are left out; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import most_frequent, small_batches, stored

PIECE = 1 << 15  # merge steps of a piece
# Pairs whose counts go to every task (nine bytes each), the most frequent ones.
HEAD_PAIRS = 1 << 20
B_IDS = 1 << 15  # an id pair is a * B_IDS + b
TEXTS = 64  # encoded at a time
PUT_TOGETHER = 1 << 22  # characters whose tokens are merged at a time


# --- merging ----------------------------------------------------------------------------------


def cut_points(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Where both sequences of ends are cut, so that each piece has `piece` merge steps.

    On diagonal d the cut (i, d - i) is the place where the merge has taken d ends, an A end
    before an equal B end. All diagonals are searched at the same time.
    """
    d = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        # a[mid] goes before b[d - mid - 1]: then the cut lies beyond mid
        at = np.flatnonzero(open_)
        beyond = a[mid[at]] <= b[d[at] - mid[at] - 1]
        low[at] = np.where(beyond, mid[at] + 1, low[at])
        high[at] = np.where(beyond, high[at], mid[at])
    return low, d - low


def overlaps(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping tokens of two sequences of ends with the same last end.

    Returns, in the order of the bytes, the index of the A and of the B token of each overlap,
    and whether it is the last one of its group.
    """
    at, bt = cut_points(a, b, piece)
    parts = []
    for i, i_next, j, j_next in zip(at[:-1], at[1:], bt[:-1], bt[1:]):
        pa_, pb = a[i:i_next], b[j:j_next]
        # the token of the other sequence that covers the byte before each end
        b_of = j + np.searchsorted(pb, pa_)
        a_of = i + np.searchsorted(pa_, pb)
        # an end that both have is emitted by A; its B end may lie in the next piece
        common = np.zeros(len(pa_), bool)
        inside = b_of < len(b)
        common[inside] = b[b_of[inside]] == pa_[inside]
        alone = np.ones(len(pb), bool)
        if len(pb):
            before = a_of - 1 + (np.searchsorted(pa_, pb, side="right") - np.searchsorted(pa_, pb))
            known = before >= 0
            alone[known] = a[before[known]] != pb[known]
        ends = np.concatenate([pa_, pb[alone]])
        order = np.argsort(ends, kind="stable")
        parts.append(
            (
                np.concatenate([np.arange(i, i_next), a_of[alone]])[order],
                np.concatenate([b_of, np.flatnonzero(alone) + j])[order],
                np.concatenate([common, np.zeros(int(alone.sum()), bool)])[order],
            )
        )
    if not parts:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool)
    return tuple(np.concatenate(c) for c in zip(*parts))


# --- encoding ---------------------------------------------------------------------------------


class Tokenizers:
    """Both tokenizers, and the bytes of each of their ids."""

    def __init__(self, ranks_path: str, pattern: str, pieces_path: str):
        import base64

        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
        self._a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b_bytes = []
        for i in range(self._b.get_piece_size()):
            piece = self._b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[1:-1], 16)]) if self._b.is_byte(i) else piece.replace("▁", " ").encode())
        if len(self.b_bytes) > B_IDS:
            raise ValueError(f"more than {B_IDS} ids on the second side")
        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        # each id as in the text of groups: followed by another one of its side, and as the last
        self.names = [f"{i}{after}" for i in range(len(self.a_bytes)) for after in ",|"]
        self.b_names = len(self.names)
        self.names += [f"{i}{after}" for i in range(len(self.b_bytes)) for after in ",;"]

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of both, or none where they do not spell the same bytes."""
        for lo in range(0, len(texts), TEXTS):
            some = texts[lo : lo + TEXTS]
            for text, b in zip(some, self._b.encode(some, num_threads=1)):
                want = b" " + text.encode()
                if not text or b"".join(map(self.b_bytes.__getitem__, b)) != want:
                    yield [], []
                    continue
                a = self._a.encode_ordinary(" " + text)
                yield (a, b) if b"".join(map(self.a_bytes.__getitem__, a)) == want else ([], [])


_LOADED: dict[tuple, Tokenizers] = {}


def _tokenizers(*paths: str) -> Tokenizers:
    """Loaded once per Python worker."""
    if paths not in _LOADED:
        _LOADED[paths] = Tokenizers(*paths)
    return _LOADED[paths]


def _written(a_ids: np.ndarray, b_ids: np.ndarray, a_to: np.ndarray, b_to: np.ndarray, t: Tokenizers) -> np.ndarray:
    """The tokens of all groups in the order of the groups' text, each as the index of its name
    with what follows it. `a_to` and `b_to` are where the groups end."""
    a_size, b_size = np.diff(a_to, prepend=0), np.diff(b_to, prepend=0)
    a_last, b_last = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
    a_last[a_to - 1] = b_last[b_to - 1] = 1
    # a group's A tokens stand after the B tokens of the groups before it, its B tokens after its A tokens
    at = np.empty(len(a_ids) + len(b_ids), np.int64)
    at[np.arange(len(a_ids)) + np.repeat(b_to - b_size, a_size)] = a_ids * 2 + a_last
    at[np.arange(len(b_ids)) + np.repeat(a_to, b_size)] = t.b_names + b_ids * 2 + b_last
    return at


_ALIGNED = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
        ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())),
    ]
)
_ALIGNED_DDL = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<int>, times array<int>"
)


def _aligned(ids: list, texts: list[str | None], t: Tokenizers, piece: int) -> pa.RecordBatch:
    """Groups, and different id pairs with the number of their links, for a few texts."""
    encoded = list(t.encode([x or "" for x in texts]))
    a_count, b_count = (np.array([len(e[side]) for e in encoded], np.int64) for side in (0, 1))
    a_ids, b_ids = (np.fromiter(chain.from_iterable(e[side] for e in encoded), np.int64) for side in (0, 1))
    del encoded
    a_ends, b_ends = np.cumsum(t.a_size[a_ids]), np.cumsum(t.b_size[b_ids])
    # all texts end at a common end, so overlaps of one never reach into the next
    a_of, b_of, last = overlaps(a_ends, b_ends, piece)
    doc = np.repeat(np.arange(len(texts)), a_count)
    doc_of = doc[a_of]
    closing = np.flatnonzero(last)
    n_links = np.bincount(doc_of, minlength=len(texts))
    n_groups = np.bincount(doc_of[closing], minlength=len(texts))
    written = _written(a_ids, b_ids, a_of[closing] + 1, b_of[closing] + 1, t)
    to, digests = np.cumsum(a_count + b_count), []
    for lo, hi in zip((to - a_count - b_count).tolist(), to.tolist()):
        # the last token ends the text, without what would follow
        text = "".join(map(t.names.__getitem__, written[lo:hi].tolist()))[:-1]
        digests.append(hashlib.sha256(text.encode()).hexdigest() if lo < hi else "")
    pair = (doc_of << 32) | (a_ids[a_of] * B_IDS + b_ids[b_of])
    different, times = np.unique(pair, return_counts=True)
    offsets = np.searchsorted(different, np.arange(len(texts) + 1) << 32)
    lists = [
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(v.astype(np.int32)))
        for v in (different & 0xFFFFFFFF, times)
    ]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()), pa.array(a_count), pa.array(b_count), pa.array(n_groups, pa.int64()), pa.array(n_links, pa.int64()),
            pa.array(digests, pa.string()), *lists,
        ],
        schema=_ALIGNED,
    )


def aligned(docs: DataFrame, load: Callable[[], Tokenizers], piece: int = PIECE) -> DataFrame:
    """Each document's groups and its different linked id pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = load()
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            lo = size = 0
            for hi, text in enumerate(texts, start=1):
                size += len(text or "")
                if size >= PUT_TOGETHER or hi == len(texts):
                    yield _aligned(ids[lo:hi], texts[lo:hi], t, piece)
                    lo, size = hi, 0

    return docs.mapInArrow(run, _ALIGNED_DDL)


# --- counts of pairs --------------------------------------------------------------------------


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold the pair, and whether no pair of its A id has more.

    Rows hold each pair once, and counts combine before the exchange.
    """
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    # an A id has at most B_IDS pairs
    of_a = Window.partitionBy(F.shiftright("pair", B_IDS.bit_length() - 1))
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_a))


def align(
    spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str, pieces_path: str,
    piece: int = PIECE, head_pairs: int = HEAD_PAIRS,
) -> DataFrame:
    """Groups, links and corpus-wide pair counts of every document.

    `ranks_path` and `pattern` give the byte-level tokenizer A, `pieces_path` the model B.
    """
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # the row number is written with the row, so it stays the same whatever is run again
    rows = stored(
        aligned(docs, lambda: _tokenizers(ranks_path, pattern, pieces_path), piece).withColumn("row_no", F.monotonically_increasing_id()),
        "aligned",
    )
    counts = stored(pair_counts(rows), "pairs")
    head = most_frequent(counts, "n", head_pairs).toArrow()
    order = np.argsort(head["pair"].to_numpy())
    known = spark.sparkContext.broadcast(
        (head["pair"].to_numpy()[order], head["n"].to_numpy()[order], head["best"].to_numpy(zero_copy_only=False)[order])
    )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_pair, head_n, head_best = known.value
        for batch in batches:
            if not batch.num_rows:
                continue
            lists, times = batch.column("pairs"), batch.column("times").flatten().to_numpy()
            pairs = lists.flatten().to_numpy()
            sizes = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), sizes)
            at = np.minimum(np.searchsorted(head_pair, pairs), max(len(head_pair) - 1, 0))
            hit = head_pair[at] == pairs if len(head_pair) else np.zeros(len(pairs), bool)
            best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(best, row[hit], times[hit] * head_best[at[hit]])
            np.add.at(total, row[hit], times[hit] * head_n[at[hit]])
            left = np.append(0, np.cumsum(np.bincount(row[~hit], minlength=batch.num_rows)))
            rest = pa.StructArray.from_arrays([pa.array(pairs[~hit], pa.int32()), pa.array(times[~hit], pa.int32())], ["pair", "times"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_no"), pa.array(best), pa.array(total), pa.ListArray.from_arrays(pa.array(left, pa.int32()), rest)],
                ["row_no", "n_best", "count_sum", "rest"],
            )

    sums = stored(
        rows.select("row_no", "pairs", "times").mapInArrow(
            summed, "row_no bigint, n_best bigint, count_sum bigint, rest array<struct<pair: int, times: int>>"
        ),
        "sums",
    )
    # pairs beyond the head occur in few documents each, so no key of this join is hot
    rest = sums.select("row_no", F.explode("rest").alias("r")).select("row_no", "r.pair", "r.times").join(counts, "pair")
    rest = rest.select("row_no", F.expr("if(best, times, 0L)").alias("n_best"), F.expr("times * n").alias("count_sum"))
    total = rest.unionByName(sums.select("row_no", "n_best", "count_sum")).groupBy("row_no").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )
    return rows.select("row_no", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(total, "row_no").drop("row_no")
