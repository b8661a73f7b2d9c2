"""SentencePiece BPE, encoded and decoded in vectorised merge rounds.

Texts are cut into words that no piece can span, each distinct word of a batch is encoded
once, and all words are merged together: one flat numpy array of symbols, the smallest pair
rank of each word by a segmented minimum, the leftmost merges of that rank, compaction, and
so on until no pair remains.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import fresh, small_batches

SPACE = "▁"
# A full run of 16 spaces merges no further, so longer runs are cut there, from the left.
WORDS = re.compile(f"{SPACE}{{16}}(?={SPACE})|{SPACE}*[^{SPACE}]+|{SPACE}+")
NONE = np.iinfo(np.int32).max
KEPT_WORDS = 200_000
SLICE = 128


def vocabulary(path: str) -> tuple[list[str], list[float], list[int], int]:
    """Pieces, scores, ids of the 256 byte pieces and the id of unknown pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    scores = [model.get_score(i) for i in range(n)]
    special = [i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)]
    in_bytes = {pieces[i]: i for i in special if model.is_byte(i)}
    for i in special:
        pieces[i] = ""  # never the result of a merge
    return pieces, scores, [in_bytes[f"<0x{b:02X}>"] for b in range(256)], model.unk_id()


class Codec:
    """Encoder of one vocabulary, with the words that it has met."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int], unknown: int):
        self.n = len(pieces)
        ids = {p: i for i, p in enumerate(pieces) if p}
        # A rank for each different score, best first: equal scores have equal ranks.
        _, rank = np.unique(-np.asarray(scores), return_inverse=True)
        left, right, made, within = [], [], [], set()
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                within.add(piece[cut - 1 : cut + 1])
                if piece[:cut] in ids and piece[cut:] in ids:
                    left.append(ids[piece[:cut]])
                    right.append(ids[piece[cut:]])
                    made.append(i)
        keys = np.asarray(left, np.int64) * self.n + np.asarray(right, np.int64)
        order = np.argsort(keys)
        self.keys, self.made = keys[order], np.asarray(made, np.int32)[order]
        self.rank = np.append(rank[self.made], NONE).astype(np.int32)
        self.made = np.append(self.made, 0).astype(np.int32)
        # Whether all pairs of a rank may merge at once: no merge makes a pair as good as itself.
        best = np.full(self.n, NONE, np.int64)
        np.minimum.at(best, left, rank[made])
        np.minimum.at(best, right, rank[made])
        alone = np.zeros(rank.max() + 1, bool)
        alone[rank[made]] = True
        worse = np.unique(rank[[m for m in made if best[m] <= rank[m]]])
        alone[worse] = False
        self.together = np.append(alone, False)
        self.char_id = np.full(0x110000, -1, np.int32)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.char_id[ord(piece)] = i
        self.joins = np.sort(np.asarray([self.char_id[ord(a)].item() * self.n + self.char_id[ord(b)].item() for a, b in within], np.int64))
        self.byte_ids = np.asarray(byte_ids, np.int32)
        self.text = [p.replace(SPACE, " ") for p in pieces]
        self.of_byte = {i: b for b, i in enumerate(byte_ids)}
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.decoded: list[str] = []
        self.flat, self.starts, self.lengths = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair, or the last index where the two never merge."""
        keys = left.astype(np.int64) * self.n + right
        at = np.searchsorted(self.keys, keys)
        found = (left >= 0) & (right >= 0) & (self.keys[np.minimum(at, len(self.keys) - 1)] == keys)
        return np.where(found, at, len(self.keys))

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each word has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        symbols = self.char_id[points]
        owner = np.repeat(np.arange(len(words)), lengths)
        place = np.arange(len(points))  # of the first character, which tells the order in the end
        # Parts between characters that stand together in no piece merge on their own.
        breaks = np.ones(len(points), bool)
        if len(points) > 1:
            keys = symbols[:-1].astype(np.int64) * self.n + symbols[1:]
            at = np.minimum(np.searchsorted(self.joins, keys), len(self.joins) - 1)
            together = (self.joins[at] == keys) & (symbols[:-1] >= 0) & (symbols[1:] >= 0)
            breaks[1:] = ~together | (owner[1:] != owner[:-1])
        part = np.cumsum(breaks) - 1
        pair = np.full(len(points), len(self.keys))
        inside = np.flatnonzero(~breaks[1:])
        pair[inside] = self.pairs(symbols[inside], symbols[inside + 1])
        done_place, done_symbol = [], []
        while len(symbols):
            first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            ranks = self.rank[pair]
            least = np.minimum.reduceat(ranks, first)
            sizes = np.diff(np.r_[first, len(part)])
            live = np.repeat(least != NONE, sizes)
            if not live.all():  # compaction: finished parts leave
                done_place.append(place[~live])
                done_symbol.append(symbols[~live])
                symbols, place, part, pair, ranks = symbols[live], place[live], part[live], pair[live], ranks[live]
                sizes, least = sizes[least != NONE], least[least != NONE]
                if not len(symbols):
                    break
            wanted = np.repeat(least, sizes)
            hit = np.flatnonzero(ranks == wanted)
            # Of hits that overlap in a run every second one counts, from the left.
            run = np.r_[True, np.diff(hit) > 1]
            since = np.arange(len(hit)) - np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
            leftmost = np.r_[True, part[hit][1:] != part[hit][:-1]]
            hit = hit[leftmost | (self.together[wanted[hit]] & (since % 2 == 0))]
            symbols[hit] = self.made[pair[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            pair[hit] = pair[hit + 1]
            symbols, place, part, pair = symbols[keep], place[keep], part[keep], pair[keep]
            at = hit - np.arange(len(hit))  # where the merged symbols stand now
            for start in (at, at[at > 0] - 1):
                start = start[(start + 1 < len(part))]
                start = start[part[start] == part[start + 1]]
                pair[start] = self.pairs(symbols[start], symbols[start + 1])
            ends = at[(at + 1 == len(part))]
            pair[ends] = len(self.keys)
        place, symbols = np.concatenate(done_place or [place]), np.concatenate(done_symbol or [symbols])
        order = np.argsort(place)
        place, symbols = place[order], symbols[order]
        # Characters without a piece become the pieces of their bytes.
        lost = np.flatnonzero(symbols < 0)
        if len(lost):
            raw = [chr(points[p]).encode() for p in place[lost]]
            times = np.ones(len(symbols), np.int64)
            times[lost] = [len(b) for b in raw]
            symbols, place = np.repeat(symbols, times), np.repeat(place, times)
            symbols[symbols < 0] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        return symbols, np.bincount(owner[place], minlength=len(words))

    def learn(self, words: list[str]) -> None:
        """Encode words that are met for the first time, and decode their ids."""
        symbols, lengths = self.merge(words)
        for i, w in enumerate(words, len(self.decoded)):
            self.index[w] = i
        starts = np.cumsum(lengths) - lengths
        for s, n in zip(starts.tolist(), lengths.tolist()):
            self.decoded.append(self.decode_ids(symbols[s : s + n].tolist()))
        self.starts = np.r_[self.starts, starts + len(self.flat)]
        self.flat, self.lengths = np.r_[self.flat, symbols], np.r_[self.lengths, lengths]

    def decode_ids(self, ids: list[int]) -> str:
        """Text of the ids of whole words; runs of byte pieces are read as UTF-8."""
        out, raw = [], bytearray()
        for i in ids:
            if (b := self.of_byte.get(i)) is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.text[i])
        return "".join(out) + raw.decode("utf-8", "replace")

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[str]]:
        """Ids of each text, and the text that these ids decode to."""
        if len(self.index) > KEPT_WORDS:
            self.forget()
        cut = [WORDS.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        get = self.index.get
        new = {w for words in cut for w in words if w not in self.index}
        if new:
            self.learn(list(new))
        ids, decoded = [], []
        for words in cut:
            at = list(map(get, words))
            decoded.append("".join(map(self.decoded.__getitem__, at))[1:])
            at = np.asarray(at, np.int64)
            lengths = self.lengths[at]
            ends = np.cumsum(lengths)
            total = int(ends[-1]) if len(ends) else 0
            ids.append(self.flat[np.repeat(self.starts[at] - ends + lengths, lengths) + np.arange(total)])
        return ids, decoded


def encode_pieces(spark: SparkSession, df: DataFrame, model: str, text: str = "text") -> DataFrame:
    """Add `ids` (array of int) and `decoded` (their text) for each row's whole text.

    `model` is the path of a SentencePiece BPE model without text normalisation, read on the
    driver; its vocabulary, bounded by the model, is broadcast. No begin or end ids, no
    sampling. A null or empty text has no ids and decodes to an empty text. Columns of the
    input stay, but for clashing `ids` and `decoded`, which are replaced.
    """
    small_batches(spark)
    shipped = spark.sparkContext.broadcast(vocabulary(model))
    held: list[Codec] = []

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if not held:
            held.append(Codec(*shipped.value))
        for texts in batches:
            ids, decoded = [], []
            for at in range(0, len(texts), SLICE):  # words of few texts are held at a time
                more = held[0].encode([t if isinstance(t, str) else None for t in texts[at : at + SLICE]])
                ids += more[0]
                decoded += more[1]
            yield pd.DataFrame({"ids": ids, "decoded": decoded})

    encode = F.pandas_udf(run, "ids array<int>, decoded string")
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    encoded = df.withColumn("__pieces", encode(F.col(f"`{text}`")))
    kept = fresh(encoded, "ids", "decoded", "__pieces")
    names = kept.columns
    return encoded.select(*[F.col(f"`{c}`") for c in names], "__pieces.ids", "__pieces.decoded")


def digests(encoded: DataFrame) -> DataFrame:
    """Counts and digests of ids and decoded texts."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
