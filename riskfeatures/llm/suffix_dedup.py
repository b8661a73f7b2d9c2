"""Removal of byte strings that an earlier document has too, by induced suffix sorting.

Only places that can repeat are sorted. Every string of LENGTH bytes has an anchor, chosen by
its own bytes alone, so equal strings have equal anchors at equal places. Documents are packed
into chunks of some megabytes. Chunks send the hashes of their anchors to shards, by hash, and
get a bit for each: whether another chunk has it. Anchors that two documents share are then
sent with the bytes of the strings that chose them. In a chunk equal pieces count as one, that
of its smallest document. In a shard suffixes are sorted by induction: the order and common
prefixes of the suffixes one byte further right give, by one stable pass over the bytes before
them, the order and common prefixes of those that start there. What goes back to a chunk is
where the strings stand that a smaller document has. A shard that is large is kept in an
unlinked scratch file of the task.
"""

from __future__ import annotations

import hashlib
import tempfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import small_batches, stored

LENGTH = 50  # bytes of a string
GRAM = 16  # bytes of an anchor
REACH = LENGTH - GRAM  # bytes that a string can extend to either side of its anchor
WIDTH = GRAM + 2 * REACH  # bytes of a piece, at most
STRINGS = REACH + 1  # strings around an anchor
CHUNK = 8 << 20  # bytes of texts that are packed into a chunk
PLACE = 18  # bits of a place in a block
BLOCK = (1 << PLACE) - 2 * LENGTH  # string starts looked at together
GRAM_BITS = 48  # of a hash that are sent; anchors taken for shared by chance cost work alone
TOGETHER = 1 << 16  # pieces sent together
IN_MEMORY = 128 << 20  # bytes of a shard's pieces that are not yet put into a file


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    n = len(data) - 7
    words = np.empty(n, np.uint64)
    for k in range(min(8, n)):
        words[k::8] = data[k : k + (n - k + 7) // 8 * 8].view(np.uint64)
    return _mixed(words[:-8] + _mixed(words[8:]))


def strings(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places and hashes of all anchors, with the first and the last start of the strings that
    chose each. A string chooses the least hash in it, the leftmost of equal ones. `ends` are
    those of the texts that lie in `data` one after the other."""
    whole = np.ones(len(data), bool)  # whether the string that starts here ends in its text
    for begin, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
        whole[max(begin, end - LENGTH + 1) : end] = False
    low_bits = np.uint64((1 << PLACE) - 1)
    parts = [(np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))]
    for start in range(0, len(data) - LENGTH + 1, BLOCK):
        block = data[start : start + BLOCK + LENGTH - 1]
        h = _gram_hashes(block)
        # least of each run of REACH + 1 grams: the lesser of two halves, doubled up
        least, span = (h & ~low_bits) | np.arange(len(h), dtype=np.uint64), 1
        while span < REACH + 1:
            step = min(span, REACH + 1 - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        at = np.flatnonzero(whole[start : start + len(least)])
        if len(at):
            chosen = (least[at] & low_bits).astype(np.int64)
            new = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
            last = np.r_[new[1:], len(chosen)] - 1
            parts.append((chosen[new] + start, h[chosen[new]], at[new] + start, at[last] + start))
    at, h, first, last = (np.concatenate(c) for c in zip(*parts))
    # an anchor may be chosen in two blocks
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]][: len(at)])
    return at[new], h[new], first[new], last[np.r_[new[1:], len(at)][: len(new)] - 1]


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all anchors of one text."""
    return strings(data, np.array([len(data)]))[:2]


# --- chunks -----------------------------------------------------------------------------------


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    docs, texts, size = [], [], 0

    def chunk() -> pd.DataFrame:
        sizes = np.array([len(t) for t in texts], np.int64)
        body = zlib.compress(b"".join(texts), 1)
        return pd.DataFrame({"docs": [np.array(docs, np.int64).tobytes()], "sizes": [sizes.tobytes()], "body": [body]})

    for batch in batches:
        for doc, text in zip(batch["doc"].tolist(), batch["text"]):
            raw = (text or "").encode("utf-8", "replace")
            if docs and size + len(raw) > CHUNK:
                yield chunk()
                docs, texts, size = [], [], 0
            docs.append(doc)
            texts.append(raw)
            size += len(raw)
    if docs:
        yield chunk()


def _opened(docs: bytes, sizes: bytes, body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents of a chunk, the ends of their texts, and the bytes."""
    return np.frombuffer(docs, np.int64), np.cumsum(np.frombuffer(sizes, np.int64)), np.frombuffer(zlib.decompress(body), np.uint8)


def _different(h: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different hashes as they are sent, sorted by shard; where each shard's begin and end;
    and the index of each anchor's."""
    sent = h & np.uint64((1 << GRAM_BITS) - 1)
    grams, which = np.unique(sent, return_inverse=True)
    shard = (grams % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return grams[order], np.searchsorted(shard[order], np.arange(shards + 1)), place[which]


def _grams(shards: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, *packed in zip(batch["chunk"], batch["docs"], batch["sizes"], batch["body"]):
                _, ends, data = _opened(*packed)
                grams, bounds, _ = _different(strings(data, ends)[1], shards)
                raw = np.ascontiguousarray(grams.view(np.uint8).reshape(-1, 8)[:, : GRAM_BITS // 8])
                out = [(s, chunk, raw[a:b].tobytes()) for s, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if a < b]
                yield pd.DataFrame(out, columns=["shard", "chunk", "grams"])

    return run


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A bit for each hash of a chunk: whether another chunk has it."""
    rows = [r for batch in batches for r in zip(batch["shard"], batch["chunk"], batch["grams"])]
    if not rows:
        return
    width = GRAM_BITS // 8
    raw = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, width)
    grams = np.zeros((len(raw), 8), np.uint8)
    grams[:, :width] = raw
    grams = grams.view(np.uint64)[:, 0]
    order = np.argsort(grams, kind="stable")
    again = grams[order][1:] == grams[order][:-1]  # a chunk sends a hash once
    bits = np.zeros(len(grams), bool)
    bits[order[1:]] = again
    bits[order[:-1]] |= again
    ends = np.cumsum([len(r[2]) // width for r in rows])
    out = [(chunk, shard, np.packbits(own).tobytes()) for (shard, chunk, _), own in zip(rows, np.split(bits, ends[:-1])) if own.any()]
    yield pd.DataFrame(out, columns=["chunk", "shard", "bits"])


def _inside(lead: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which bytes of each row of a matrix of pieces belong to the piece."""
    at = np.arange(WIDTH)
    low = REACH - lead.astype(np.int64)[:, None]
    return (at >= low) & (at < low + size[:, None])


def _together(around: np.ndarray, at: np.ndarray, lead: np.ndarray, size: np.ndarray, doc: np.ndarray, gram: np.ndarray) -> tuple[int, bytes]:
    """Some anchors' pieces, equal ones as one, and where they stand. Anchors are sorted by hash."""
    pieces, inside = around[at], _inside(lead, size)
    pieces[~inside] = 0
    same = gram[1:] == gram[:-1]
    alone = ~(np.r_[False, same] | np.r_[same, False])
    several = np.flatnonzero(~alone)
    of = np.empty(len(at), np.int64)
    first = np.flatnonzero(alone)
    of[first] = np.arange(len(first))
    if len(several):
        key = np.column_stack([pieces[several], lead[several], size[several]])  # sizes are not 0, the end of a string
        _, one, which = np.unique(key.view(f"S{WIDTH + 2}")[:, 0], return_index=True, return_inverse=True)
        of[several] = len(first) + which
        first = np.r_[first, several[one]]
    holder = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(holder, of, doc)
    order = np.argsort(of, kind="stable")
    body = [lead[first], size[first], holder, np.diff(of[order], prepend=0).astype(np.uint8), (doc > holder[of])[order].astype(np.uint8)]
    body += [(at[order] - REACH).astype(np.int32), pieces[first][inside[first]]]
    return len(first), zlib.compress(b"".join(x.tobytes() for x in body), 1)


def _pieces(shards: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, docs, sizes, body, shared in zip(*(batch[c] for c in ("chunk", "docs", "sizes", "body", "shared"))):
                docs, ends, data = _opened(docs, sizes, body)
                at, h, first, last = strings(data, ends)
                if not len(at):
                    continue
                grams, bounds, which = _different(h, shards)
                hit = np.zeros(len(grams), bool)
                for row in shared if shared is not None else ():
                    a, b = bounds[row["shard"]], bounds[row["shard"] + 1]
                    hit[a:b] = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=b - a)
                doc = docs[np.searchsorted(ends, at, side="right")]
                order = np.argsort(which, kind="stable")
                begin = np.searchsorted(which[order], np.arange(len(grams)))
                # a document's own repeats don't make an anchor shared
                hit |= np.minimum.reduceat(doc[order], begin) < np.maximum.reduceat(doc[order], begin)
                order = order[hit[which[order]]]
                if not len(order):
                    continue
                at, first, last, doc, which = at[order], first[order], last[order], doc[order], which[order]
                lead, size = (at - first).astype(np.uint8), (last + LENGTH - first).astype(np.uint8)
                edge = np.zeros(REACH, np.uint8)
                around = np.lib.stride_tricks.sliding_window_view(np.concatenate([edge, data, edge]), WIDTH)
                cuts, out = np.searchsorted(which, bounds), []
                for shard, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                    for lo in range(a, b, TOGETHER):
                        part = slice(lo, min(lo + TOGETHER, b))
                        n, packed = _together(around, at[part], lead[part], size[part], doc[part], which[part])
                        out.append((shard, chunk, n, part.stop - lo, packed))
                yield pd.DataFrame(out, columns=["shard", "chunk", "n", "places", "pieces"])

    return run


# --- shards -----------------------------------------------------------------------------------


def scratch(shape: tuple[int, ...], dtype) -> np.ndarray:
    """An array in a file that has no name and goes with the task."""
    return np.memmap(tempfile.TemporaryFile(), dtype=dtype, mode="w+", shape=shape)


def first_holders(pieces: np.ndarray, low: np.ndarray, high: np.ndarray, docs: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each offset, from the right: the smallest document that has each piece's string there.

    `pieces` is a matrix of bytes, `low` and `high` bound the valid bytes of each row. Only
    strings inside the bounds count; others get -1.
    """
    n, width = pieces.shape
    order, prefix = np.arange(n), np.zeros(n, np.int64)  # prefix: bytes shared with the suffix before
    for offset in range(width - 1, -1, -1):
        byte = pieces[order, offset]
        turn = np.argsort(byte, kind="stable")
        sorted_byte = byte[turn]
        shared = np.zeros(n, np.int64)
        starts = np.flatnonzero(np.r_[True, sorted_byte[1:] != sorted_byte[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], n]):
            if b - a > 1:
                # what two suffixes share is the least that lies between them in the old order
                places = turn[a:b]
                least = np.minimum.reduceat(np.r_[prefix[1:], 0], places)[:-1]
                shared[a + 1 : b] = least + 1
        order, prefix = order[turn], shared
        if offset + LENGTH <= width:
            inside = (low[order] <= offset) & (offset + LENGTH <= high[order])
            group = np.cumsum(prefix < LENGTH) - 1
            holders = np.full(group[-1] + 1, np.iinfo(np.int64).max)
            np.minimum.at(holders, group[inside], docs[order[inside]])
            out = np.full(n, -1, np.int64)
            out[order[inside]] = holders[group[inside]]
            yield offset, out


def _ranges(masks: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the bytes that each row's marked strings cover."""
    bits = ((masks[:, None] >> np.arange(STRINGS, dtype=np.uint64)) & np.uint64(1)).astype(np.int8)
    steps = np.diff(bits, axis=1, prepend=0, append=0)
    row, start = np.nonzero(steps == 1)
    _, stop = np.nonzero(steps == -1)
    return (base[row] + start).astype(np.int32), (base[row] + stop - 1 + LENGTH).astype(np.int32)


def _shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = [r for batch in batches for r in zip(batch["chunk"], batch["n"], batch["places"], batch["pieces"])]
    total = sum(r[1] for r in rows)
    if not total:
        return
    # a column of bytes is gathered at a time, so columns lie together
    columns = np.zeros((WIDTH, total), np.uint8) if total * WIDTH <= IN_MEMORY else scratch((WIDTH, total), np.uint8)
    lead, size, docs, places, at = np.empty(total, np.uint8), np.empty(total, np.uint8), np.empty(total, np.int64), [], 0
    for i, (chunk, n, found, packed) in enumerate(rows):
        raw, own = zlib.decompress(packed), slice(at, at + n)
        lead[own], size[own] = np.frombuffer(raw, np.uint8, n), np.frombuffer(raw, np.uint8, n, n)
        docs[own] = np.frombuffer(raw, np.int64, n, 2 * n)
        step, later = (np.frombuffer(raw, np.uint8, found, 10 * n + k * found) for k in (0, 1))
        base = np.frombuffer(raw, np.int32, found, 10 * n + 2 * found)
        matrix = np.zeros((n, WIDTH), np.uint8)
        matrix[_inside(lead[own], size[own])] = np.frombuffer(raw, np.uint8, -1, 10 * n + 6 * found)
        columns[:, own] = matrix.T
        places.append((chunk, own, step, later.astype(bool), base))
        rows[i] = None
        at += n
    low = REACH - lead.astype(np.int64)
    masks = np.zeros(total, np.uint64)  # a bit for each string that a smaller document has
    for offset, holder in first_holders(columns.T, low, low + size, docs):
        masks[(holder >= 0) & (holder < docs)] |= np.uint64(1 << offset)
    for chunk, own, step, later, base in places:
        of = np.cumsum(step, dtype=np.int64)
        every = ((np.uint64(1) << (size[own].astype(np.uint64) - np.uint64(LENGTH - 1))) - np.uint64(1)) << low[own].astype(np.uint64)
        # where a document of the same chunk has the whole piece, all of its strings go
        gone = np.where(later, every[of], masks[own][of])
        marked = gone != 0
        if marked.any():
            starts, stops = _ranges(gone[marked], base[marked])
            yield pd.DataFrame({"chunk": [chunk], "ranges": [np.concatenate([starts, stops]).tobytes()]})


def _removed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for docs, sizes, body, marks in zip(*(batch[c] for c in ("docs", "sizes", "body", "marks"))):
            docs, ends, data = _opened(docs, sizes, body)
            change = np.zeros(len(data) + 1, np.int32)
            for ranges in marks if marks is not None else ():
                starts, stops = np.frombuffer(ranges, np.int32).reshape(2, -1)
                np.add.at(change, starts, 1)
                np.add.at(change, stops, -1)
            covered, out = np.cumsum(change[:-1]) > 0, []
            for doc, begin, end in zip(docs.tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
                gone = covered[begin:end]
                spans = int(np.count_nonzero(np.diff(np.r_[0, gone.astype(np.int8)]) == 1))
                left = data[begin:end][~gone].tobytes()
                out.append((doc, end - begin, int(gone.sum()), spans, hashlib.sha256(left).hexdigest(), left))
            yield pd.DataFrame(out, columns=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of df: `key`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256`, `kept` (bytes).

    Removed is each byte covered by a string of LENGTH bytes that also starts in a document
    with a smaller key, all judged on the given texts, as UTF-8. Rows with the same key are
    one document to each other: they remove nothing from one another. A null text is empty;
    a row without key counts as after all others, keeps its null, and is judged against
    them. Rows are neither dropped nor merged; other columns are left out.
    """
    small_batches(df.sparkSession)
    last = np.iinfo(np.int64).max - 1
    docs = df.select(F.coalesce(F.col(f"`{key}`").cast("bigint"), F.lit(last)).alias("doc"), F.col(f"`{text}`").alias("text"))
    shards = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    # the number of a chunk is written with it, so it stays the same whatever is run again
    chunks = stored(
        docs.mapInPandas(_chunks, "docs binary, sizes binary, body binary").withColumn("chunk", F.monotonically_increasing_id()), "chunks"
    )
    grams = chunks.mapInPandas(_grams(shards), "shard int, chunk long, grams binary")
    bits = grams.repartition(shards, "shard").mapInPandas(_shared, "chunk long, shard int, bits binary")
    shared = bits.groupBy("chunk").agg(F.collect_list(F.struct("shard", "bits")).alias("shared"))
    # chunks meet what comes back to them twice, over one exchange
    pieces = chunks.join(shared, "chunk", "left").mapInPandas(
        _pieces(shards), "shard int, chunk long, n int, places int, pieces binary"
    )
    ranges = pieces.repartition(shards, "shard").mapInPandas(_shard, "chunk long, ranges binary")
    marks = ranges.groupBy("chunk").agg(F.collect_list("ranges").alias("marks"))
    out = chunks.join(marks, "chunk", "left").mapInPandas(
        _removed, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    return out.select(F.when(F.col("doc") != last, F.col("doc")).alias(key), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")


def digests(removed: DataFrame) -> DataFrame:
    return removed.drop("kept")


def oracle() -> str:
    """DuckDB SQL for the rows of the query, where keys are neither null nor repeated."""
    return f"""
with docs as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
windows as (select doc_id, i, x[2 * i + 1:2 * i + {2 * LENGTH}] as w from (
  select doc_id, x, unnest(range(greatest(length(x) // 2 - {LENGTH - 1}, 0))) as i from docs)),
firsts as (select w, min(doc_id) as holder from windows group by w having min(doc_id) < max(doc_id)),
marked as (select doc_id, i from windows join firsts using (w) where holder < doc_id),
islands as (select doc_id, i, i > coalesce(max(i + {LENGTH}) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), -1) as starts from marked),
numbered as (select doc_id, i, sum(starts::int) over (partition by doc_id order by i) as run from islands),
runs as (select doc_id, run, min(i) as a, max(i) + {LENGTH} as b from numbered group by all),
gaps as (select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as from_, a as to_ from runs
  union all select doc_id, max(b), 1000000000 from runs group by doc_id),
kept as (select doc_id, string_agg(x[2 * from_ + 1:2 * to_], '' order by from_) as k from gaps join docs using (doc_id) group by doc_id),
sums as (select doc_id, sum(b - a) as n, count(*) as spans from runs group by doc_id)
select d.doc_id, (length(x) // 2)::bigint as n_bytes, coalesce(n, 0)::bigint as n_removed, coalesce(spans, 0)::bigint as n_spans,
  sha256(unhex(coalesce(k, x))) as kept_sha256
from docs d left join sums using (doc_id) left join kept using (doc_id)
"""
