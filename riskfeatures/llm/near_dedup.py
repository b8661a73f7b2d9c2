"""Near-duplicate documents by HyperMinHash sketches of their word shingles.

A sketch has a register per bucket: the leading zeros of the smallest hash in the bucket and
the bits that follow. Bands of registers propose pairs, the registers of a pair estimate its
likeness (corrected for chance collisions), and what may reach the threshold is decided on
the full sets. Pairs of a bucket are not all formed: members meet the least one, and only
where a bucket still holds several components do the others meet: small sets as they are,
larger ones by folded registers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import forget, small_batches, stored

BUCKETS = 256
MANTISSA = 10  # bits after the leading zeros
BANDS, WIDTH = 42, 6  # a pair at 0.8 misses every band with probability (1 - 0.8**6)**42 = 3e-6
TILE = 1024  # members of a bucket that one task compares with as many others
WHOLE = 512  # sets of at most so many shingles meet as they are, larger ones by their sketches
TOGETHER = 256  # partners of a document whose texts are compared with its own in one group
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of k words; with fewer words, of all as one."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # ASCII letters and white space only
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - k + 1)
    out = np.full(n, min(k, len(h)), np.uint64)
    for i in range(min(k, len(h))):
        out = mixed(out * _MIX + h[i : i + n])
    return np.unique(out)


# For each empty bucket the order in which others are asked for their register.
_ORDER = np.argsort(mixed(np.arange(BUCKETS * BUCKETS, dtype=np.uint64) + np.uint64(1)).reshape(BUCKETS, BUCKETS), axis=1)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers of a non-empty set: leading zeros, then mantissa bits, of each bucket's least hash."""
    x = np.sort(mixed(hashes + np.uint64(0xABCD)))
    bucket = (x >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    rest = (x[first] << np.uint64(8)) | np.uint64(255)
    exponent = np.frexp(rest.astype(np.float64))[1]
    zeros = np.minimum(64 - exponent, 63).astype(np.uint64)
    after = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    registers = np.zeros(BUCKETS, np.uint16)
    filled = np.zeros(BUCKETS, bool)
    registers[bucket[first]] = ((zeros << np.uint64(MANTISSA)) | after).astype(np.uint16)
    filled[bucket[first]] = True
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = _ORDER[empty]
        registers[empty] = registers[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return registers


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One key for each band of each sketch; registers is sketches x buckets."""
    bands = registers[:, : BANDS * WIDTH].reshape(-1, BANDS, WIDTH).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2])
    for i in range(WIDTH):
        keys = mixed(keys * _MIX + bands[:, :, i])
    return keys.view(np.int64) if keys.flags.c_contiguous else np.ascontiguousarray(keys).view(np.int64)


def estimated(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness of pairs of sketches, corrected for registers that agree by chance.

    Least hashes of unlike sets of like size share their leading zeros with a probability of
    about a third, and then their mantissa with one of 2 ** -MANTISSA.
    """
    same = (a == b).mean(axis=1)
    chance = 2.0**-MANTISSA / 3
    return np.clip((same - chance) / (1 - chance), 0, 1)


def margin(n: np.ndarray) -> np.ndarray:
    """How far below the threshold an estimate may lie: five standard deviations, where the
    smaller set has n shingles. Borrowed registers of small sets count for half a shingle."""
    return 5 * 0.4 / np.sqrt(np.clip(n / 2, 1, BUCKETS))


def folded(registers: np.ndarray) -> np.ndarray:
    """Registers cut to four mixed bits, two in a byte."""
    small = ((registers * np.uint16(40503)) >> np.uint16(12)).astype(np.uint8)
    return small[..., ::2] << 4 | small[..., 1::2]


def unfolded(small: list[bytes]) -> np.ndarray:
    pairs = np.frombuffer(b"".join(small), np.uint8).reshape(len(small), -1)
    return np.stack([pairs >> 4, pairs & 15], axis=2).reshape(len(small), -1)


def _sketches(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sizes, digest, sketches = [], [], []
        for text in batch["text"]:
            s = shingle_set(text, k)
            sizes.append(len(s))
            digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else b"")
            sketches.append(sketch(s).tobytes() if len(s) else b"")
        yield pd.DataFrame({"id": batch["id"], "mark": batch["mark"], "n": sizes, "digest": digest, "sketch": sketches})


def _bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            registers = np.frombuffer(b"".join(batch["sketch"]), np.uint16).reshape(-1, BUCKETS)
            yield pd.DataFrame({"key": band_keys(registers).reshape(-1), "node": np.repeat(batch["node"].to_numpy(), BANDS)})


def components(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """`id` and `comp`, the smallest id that it is linked with, for the ids of the edges.

    Labels of neighbours are taken over and followed to their own labels until none changes,
    so a chain takes a logarithmic number of rounds; every second one is written to the
    shared folder. `labels` are components found before, which the edges join; both are
    given as stored frames.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ids = both.select(F.col("a").alias("id")).distinct()
    if labels is None:
        now = ids.withColumn("comp", F.col("id"))
    else:
        both = both.unionByName(labels.where("id <> comp").selectExpr("id as a", "comp as b")).unionByName(
            labels.where("id <> comp").selectExpr("comp as a", "id as b")
        )
        now = ids.join(labels.select("id", "comp"), "id", "full_outer").select("id", F.coalesce("comp", "id").alias("comp"))

    def told(now: DataFrame) -> DataFrame:
        # each id asks its neighbours, and the id that it is labelled with, for their labels
        asks = both.unionByName(now.where("id <> comp").selectExpr("comp as a", "id as b"))
        heard = asks.join(now.select("id", "comp"), asks.a == F.col("id")).select(F.col("b").alias("id"), "comp", F.lit(None).cast("bigint").alias("was"))
        best = heard.unionByName(now.select("id", "comp", F.col("comp").alias("was"))).groupBy("id")
        return best.agg(F.min("comp").alias("comp"), F.max("was").alias("was"))

    then = None
    while True:
        before, then = then, stored(told(told(now).select("id", "comp")), "labels")
        forget(before)
        now = then.select("id", "comp")
        # what the second of two rounds leaves as it was, another one would leave too
        if then.where("was <> comp").isEmpty():
            return then


def _overlaps(sets: list[np.ndarray], of: np.ndarray, every: np.ndarray) -> Iterator[np.ndarray]:
    """For each set of `of`, how many elements it shares with each set of `every`; both are
    places in `sets`, none of which is empty."""
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    ends = np.cumsum([len(x) for x in sets])
    begins = np.r_[0, ends[:-1]]
    all_codes = np.concatenate([codes[begins[i] : ends[i]] for i in every])
    starts = np.r_[0, np.cumsum((ends - begins)[every])[:-1]]
    flag = np.zeros(codes.max() + 1, np.uint8)
    for i in of:
        mine = codes[begins[i] : ends[i]]
        flag[mine] = 1
        yield np.add.reduceat(flag[all_codes], starts, dtype=np.int32)
        flag[mine] = 0


def _tiles(batches: Iterator[pd.DataFrame], percent: int, whole: bool, at_most: int) -> Iterator[pd.DataFrame]:
    """Pairs of different components, from rows sorted by tile.

    A tile holds some members of a bucket (role 0) and some members outside its largest
    component (role 1), which meet. Sets of `at_most` shingles are small. With `whole`,
    each of the latter names its likeliest partner in each other component: among small sets
    if the threshold is reached, else if it may be. Without, all partners are named that may
    reach it and are not both small.
    """
    chance = 1 / 16

    def met(tile: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        role = tile["role"].to_numpy()
        node, n, comp = (tile[c].to_numpy() for c in ("node", "n", "comp"))
        few, every = np.flatnonzero(role == 1), np.flatnonzero(role == 0)
        if not len(few) or not len(every):
            return
        is_small = n <= at_most

        def pairs(i: int, at: np.ndarray, like: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if whole and len(at) > 1:
                order = np.lexsort((node[at], -like))
                at = at[order[np.unique(comp[at][order], return_index=True)[1]]]
            return np.minimum(node[at], node[i]), np.maximum(node[at], node[i])

        small, those = few[is_small[few]], every[is_small[every]]
        if whole and len(small) and len(those):
            place = np.cumsum(is_small) - 1
            sets = [np.frombuffer(s, np.uint64) for s in tile["shingles"].to_numpy()[is_small]]
            for i, both in zip(small, _overlaps(sets, place[small], place[those])):
                union = n[those] + n[i] - both
                found = (100 * both >= percent * union) & (comp[those] != comp[i])
                if found.any():
                    yield pairs(i, those[found], (both / union)[found])
        if is_small.all():
            return
        registers = unfolded(list(tile["small"]))
        for i in few:
            least, most = np.minimum(n[every], n[i]), np.maximum(n[every], n[i])
            near = (comp[every] != comp[i]) & (100 * least >= percent * most) & (most > at_most)
            at, least = every[near], least[near]
            if not len(at):
                continue
            like = ((registers[at] == registers[i]).mean(axis=1) - chance) / (1 - chance)
            may = like >= percent / 100 - margin(least)
            if may.any():
                yield pairs(i, at[may], like[may])

    def done(rows: pd.DataFrame) -> pd.DataFrame:
        tile = rows[["key", "i", "j"]].to_numpy()
        cuts = np.flatnonzero((tile[1:] != tile[:-1]).any(axis=1)) + 1
        found = [p for x, y in zip(np.r_[0, cuts], np.r_[cuts, len(rows)]) for p in met(rows.iloc[x:y])]
        a, b = (np.concatenate([p[s] for p in found]) if found else np.empty(0, np.int64) for s in (0, 1))
        return pd.DataFrame({"a": a, "b": b}).drop_duplicates()

    held = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if not len(held):
            continue
        tile = held[["key", "i", "j"]].to_numpy()
        ended = int(np.flatnonzero((tile == tile[-1]).all(axis=1))[0])  # the last tile may go on
        if ended:
            yield done(held.iloc[:ended])
            held = held.iloc[ended:].reset_index(drop=True)
    if held is not None and len(held):
        yield done(held)


def mixed_buckets(rows: DataFrame) -> DataFrame:
    """The rows (`key`, `node`, `comp`) of buckets of several components, with the bucket's
    largest one, `main`, and into how many tiles its members and those outside `main` go."""
    counts = rows.groupBy("key", "comp").agg(F.count("*").alias("of")).groupBy("key")
    counts = counts.agg(F.sum("of").alias("members"), F.max(F.struct("of", "comp")).alias("most")).where("most.of < members")
    tiles = lambda c: F.ceil(c / TILE).cast("int")
    counts = counts.select("key", F.col("most.comp").alias("main"), tiles(F.col("members")).alias("wide"), tiles(F.col("members") - F.col("most.of")).alias("high"))
    return rows.join(counts, "key")


def small_sets(nodes: DataFrame, classes: DataFrame, source: DataFrame, k: int) -> DataFrame:
    """`node` and `shingles`, the set as it is, for the nodes with at most WHOLE shingles."""

    @F.pandas_udf("binary")
    def shingles(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, k).tobytes() for t in texts], dtype=object)

    return texts_of(nodes, classes.where(F.col("n") <= WHOLE), source).select("node", shingles("text").alias("shingles"))


def apart(rows: DataFrame, classes: DataFrame, sets: DataFrame | None, percent: int) -> DataFrame:
    """Distinct pairs `a`, `b` of different components that share a bucket and may be alike.

    Members outside the largest component of a bucket meet all members, in tiles of about
    TILE by TILE rows, so no task holds a whole bucket. With `sets`, the small sets, each
    names its likeliest partners; without, all partners but those of small sets.
    """
    members = classes.select("node", "n", "small")
    if sets is None:
        # what is not near the size of a larger set has met all it can be linked with
        members = members.where(F.col("n") * 100 > WHOLE * percent).withColumn("shingles", F.lit(None).cast("binary"))
        rows = rows.join(members.select("node"), "node", "left_semi")
    else:
        members = members.join(sets, "node", "left")
    mixed_rows = mixed_buckets(rows).join(members, "node")
    at_j, at_i = F.pmod(F.xxhash64("node"), "wide").cast("int"), F.pmod(F.xxhash64("node", F.lit(1)), "high").cast("int")
    place = lambda i, j, role: F.struct(i.alias("i"), j.alias("j"), F.lit(role).alias("role"))
    wide = F.transform(F.sequence(F.lit(0), F.col("high") - 1), lambda i: place(i, at_j, 0))
    high = F.transform(F.sequence(F.lit(0), F.col("wide") - 1), lambda j: place(at_i, j, 1))
    places = F.when(F.col("comp") == F.col("main"), wide).otherwise(F.concat(wide, high))
    dealt = mixed_rows.select("key", "node", "comp", "n", "small", "shingles", F.inline(places)).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    whole, at_most = sets is not None, WHOLE
    return dealt.mapInPandas(lambda b: _tiles(b, percent, whole, at_most), "a long, b long").distinct()


def _classes(source: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Rows with size and digest of their sets, and one row per different set."""

    @F.pandas_udf("binary")
    def small(sketches: pd.Series) -> pd.Series:
        return pd.Series([folded(np.frombuffer(s, np.uint16)).tobytes() for s in sketches], dtype=object)

    every = source.mapInPandas(lambda b: _sketches(b, k), "id long, mark long, n long, digest binary, sketch binary")
    every = stored(every, "sketches")
    classes = every.where("id is not null and n > 0").groupBy("digest")
    classes = classes.agg(F.min(F.struct("id", "mark")).alias("least"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    # numbered once: what is stored is read by all that follows
    classes = classes.select(F.monotonically_increasing_id().alias("node"), "digest", "least.id", "least.mark", "n", "sketch", small("sketch").alias("small"))
    return every, stored(classes, "classes")


def _groups(source: DataFrame, k: int, percent: int) -> DataFrame:
    """One row per row of source (`id`, `mark`, `text`): `id`, `mark`, `n`, `digest`, and the
    smallest id and digest (`component`, `first`) of the component, null where there is none."""
    every, classes = _classes(source, k)
    bands = classes.select("node", "sketch").mapInPandas(_bands, "key long, node long")
    shared = bands.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most").select("key", "least")
    rows = stored(bands.join(shared, "key"), "buckets")
    labels = None

    def labelled(node: str, comp: str) -> DataFrame:
        return labels.select(F.col("id").alias(node), F.col("comp").alias(comp))

    def linked(pairs: DataFrame) -> None:
        nonlocal labels
        edges = stored(confirmed(pairs, classes, source, k, percent), "edges")
        if not edges.isEmpty():
            before = labels
            labels = components(edges, labels)
            forget(before)
        forget(edges)

    def with_comp() -> DataFrame:
        if labels is None:
            return rows.withColumn("comp", F.col("node"))
        return rows.join(labelled("node", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))

    # Each set meets the least member of one of its buckets, then those of all of them.
    met = rows.where("least < node")
    linked(may_link(met.groupBy("node").agg(F.min("least").alias("a")).select("a", F.col("node").alias("b")), classes, percent))
    if labels is not None:
        met = with_comp().where("least < node").join(labelled("least", "of_least"), "least", "left").where(F.col("comp") != F.coalesce("of_least", "least"))
    linked(may_link(met.select(F.col("least").alias("a"), F.col("node").alias("b")).distinct(), classes, percent))
    # What is still apart within a bucket: first the likeliest partners, which settles small
    # sets, then all that may be.
    sets = stored(small_sets(mixed_buckets(with_comp()).select("node").distinct(), classes, source, k), "sets")
    linked(apart(with_comp(), classes, sets, percent))
    forget(sets)
    linked(apart(with_comp(), classes, None, percent))
    forget(rows)

    nodes = classes.select("digest", "id", "node")
    if labels is None:
        of_digest = nodes.select("digest", F.col("id").alias("component"), F.col("digest").alias("first"))
    else:
        nodes = nodes.join(labelled("node", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        least = nodes.groupBy("comp").agg(F.min(F.struct("id", "digest")).alias("least"))
        of_digest = nodes.join(least, "comp").select("digest", F.col("least.id").alias("component"), F.col("least.digest").alias("first"))
    return every.select("id", "mark", "n", "digest").join(of_digest, "digest", "left")


def _source(df: DataFrame, key: str, text: str) -> DataFrame:
    small_batches(df.sparkSession)
    return df.select(F.col(f"`{key}`").cast("bigint").alias("id"), _mark(text).alias("mark"), F.col(f"`{text}`").alias("text"))


def _mark(text: str) -> Column:
    """Tells texts under one key apart."""
    return F.xxhash64(F.col(f"`{text}`"))


def near_duplicates(df: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of df: `key`, `n_shingles`, `component_id`, `kept`.

    Documents whose sets of k-word shingles have an intersection of at least `percent` per
    cent of their union are linked; a component is named by its smallest key, which is kept.
    Equal sets count once. A document without words is linked with nothing. Rows that share
    a key are documents of their own, each linked by its own text, so repeated rows share a
    component and are all kept if one is; a row without key is kept and has no component.
    Works on whole texts; other columns are left out. Proposals by bands miss a pair at the
    threshold with a probability of 3e-6, estimates of what they propose with one of 3e-7,
    and none with equal sets; every reported link is confirmed on the full sets.
    """
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return _groups(_source(df, key, text), k, percent).select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def may_link(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs `a`, `b` whose sizes and sketches leave the threshold within reach."""

    @F.pandas_udf("boolean")
    def maybe(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        rows = [np.frombuffer(b"".join(s), np.uint16).reshape(-1, BUCKETS) for s in (a, b)]
        return pd.Series(estimated(*rows) >= percent / 100 - margin(np.minimum(n_a.to_numpy(), n_b.to_numpy())))

    side = lambda s: classes.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    return both.where(maybe("sketch_a", "sketch_b", "n_a", "n_b")).select("a", "b")


def _compared(batches: Iterator[pd.DataFrame], k: int, percent: int) -> Iterator[pd.DataFrame]:
    """Pairs whose full sets reach the threshold; a row without `b` holds the text of `a` for
    those that follow."""
    of, first = None, None
    for batch in batches:
        a, b = [], []
        for node, salt, other, text in zip(batch["a"], batch["salt"], batch["b"], batch["text"]):
            s = shingle_set(text, k)
            if other < 0:
                of, first = (node, salt), s
            elif of == (node, salt):
                both = len(np.intersect1d(first, s, assume_unique=True))
                if 100 * both >= percent * (len(first) + len(s) - both):
                    a.append(node)
                    b.append(other)
        yield pd.DataFrame({"a": np.asarray(a, np.int64), "b": np.asarray(b, np.int64)})


def texts_of(nodes: DataFrame, classes: DataFrame, source: DataFrame) -> DataFrame:
    """`node` and one text of it; rows that repeat both key and text are alike."""
    wanted = classes.join(nodes, "node").select("node", "id", "mark")
    return source.join(wanted, ["id", "mark"]).groupBy("node").agg(F.first("text").alias("text"))


def confirmed(pairs: DataFrame, classes: DataFrame, source: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs `a`, `b` whose full sets reach the threshold.

    The text of `a` goes once to each group of some `TOGETHER` partners, whose texts go to
    the group once each.
    """
    pairs = stored(pairs, "pairs")
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / TOGETHER).cast("int").alias("groups"))
    ids = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = texts_of(ids, classes, source)
    firsts = groups.join(texts, groups.a == texts.node).select("a", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("salt"), F.lit(-1).cast("bigint").alias("b"), "text")
    others = pairs.join(groups, "a").join(texts, F.col("b") == texts.node)
    others = others.select("a", F.pmod(F.xxhash64("b"), "groups").cast("int").alias("salt"), "b", "text")
    dealt = firsts.unionByName(others).repartition("a", "salt").sortWithinPartitions("a", "salt", "b")
    return dealt.mapInPandas(lambda batches: _compared(batches, k, percent), "a long, b long")


def deduplicate(df: DataFrame, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df of which one document of each group of near-duplicates stays.

    It is the one with the smallest key; of several texts of the group under that key, one
    stays, and of rows that repeat its key and text as well. Rows without key all stay, and
    so do rows without words, but for those that repeat key and text.
    """
    rows = _groups(_source(df, key, text), k, percent).where("id is not null").withColumnsRenamed({"id": "__id", "mark": "__mark"})
    stays = F.col("first").isNull() | ((F.col("__id") == F.col("component")) & (F.col("digest") == F.col("first")))
    rows = rows.groupBy("__id", "__mark").agg(F.max(stays).alias("stays"), F.count("*").alias("copies"), F.max("digest").alias("digest"), F.max("n").alias("n"))
    # texts of one key and one set may differ in case or white space: the one of least mark stays
    one = F.min("__mark").over(Window.partitionBy("__id", "digest")) == F.col("__mark")
    rows = stored(rows.withColumn("stays", F.col("stays") & (one | (F.col("n") == 0))).select("__id", "__mark", "stays", "copies"), "decisions")
    names = [f"`{c}`" for c in df.columns]
    marked = df.withColumn("__id", F.col(f"`{key}`").cast("bigint")).withColumn("__mark", _mark(text))
    lost = rows.where("not stays or copies > 1").select("__id", "__mark")
    many = rows.where("stays and copies > 1").select("__id", "__mark")
    left = marked.join(lost, ["__id", "__mark"], "left_anti").select(*names)
    again = marked.join(many, ["__id", "__mark"], "left_semi").dropDuplicates(["__id", "__mark"]).select(*names)
    return left.unionByName(again)


def oracle(k: int = 4, percent: int = 80) -> str:
    """DuckDB SQL for the rows of the query, where no key is null or repeated."""
    return rf"""
with recursive docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
sets as (
  select doc_id, case when len(ws) = 0 then []::varchar[] when len(ws) < {k} then [array_to_string(ws, ' ')]
    else list_distinct(list_transform(range(1, len(ws) - {k - 2}), lambda i: array_to_string(ws[i:i + {k - 1}], ' '))) end as s from docs),
classes as (select min(doc_id) as rep, s, md5(array_to_string(list_sort(s), chr(1))) as h from sets where len(s) > 0 group by s, h),
reps as (select min(rep) as rep, any_value(s) as s, h from classes group by h),
each as (select rep, unnest(s) as g, len(s) as n from reps),
links as (
  select x.rep as a, y.rep as b from each x join each y on x.g = y.g and x.rep < y.rep and least(x.n, y.n) * 100 >= greatest(x.n, y.n) * {percent}
  group by x.rep, y.rep, x.n, y.n having 100 * count(*) >= {percent} * (x.n + y.n - count(*))),
both_ways as (select a, b from links union select b, a from links),
reach(node, seen) as (select rep, rep from reps union select r.node, e.b from reach r join both_ways e on r.seen = e.a),
comps as (select node, min(seen) as comp from reach group by node)
select s.doc_id, len(s.s)::bigint as n_shingles, coalesce(c.comp, s.doc_id) as component_id, s.doc_id = coalesce(c.comp, s.doc_id) as kept
from sets s left join reps r on len(s.s) > 0 and r.h = md5(array_to_string(list_sort(s.s), chr(1))) left join comps c on c.node = r.rep
"""
