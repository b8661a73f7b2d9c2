"""Mixing sources to target weights: raking by iterative proportional fitting, then sampling.

Tokens are counted for each cell of source, language and topic. Raking scales the cells,
margin after margin, until their tokens have the target shares; a document is then kept with
its cell's probability. Only cells, whose number the targets bound, reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh, small_batches, stored

TOPICS = 8
OTHER = "*"  # values without a target of their own
LEAST_SHARE = 1e-3  # of tokens, from which a value has a target of its own: at most a thousand do
MARGINS = ("source", "lang", "topic")
ROUNDS, CLOSE = 200, 1e-6


def _traits(texts: pd.Series) -> pd.DataFrame:
    """Tokens (words) of each text, and its topic: the signs of three sums over hashed words."""
    tokens, topics = [], []
    for text in texts:
        words = (text or "").encode("utf-8", "replace").lower().split()
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        signs = [int(2 * int(((h >> np.uint64(40 + b)) & np.uint64(1)).sum()) > len(h)) << b for b in range(3)]
        tokens.append(len(words))
        topics.append(str(sum(signs)))
    return pd.DataFrame({"tokens": tokens, "topic": topics})


def with_traits(df: DataFrame, text: str = "text") -> DataFrame:
    """Add `__traits` with the tokens and the topic of each whole text."""
    small_batches(df.sparkSession)
    traits = F.pandas_udf(_traits, "tokens long, topic string")
    return df.withColumn("__traits", traits(F.col(f"`{text}`")))


def _cell(df: DataFrame) -> dict[str, Column]:
    value = {m: F.coalesce(F.col(f"`{m}`").cast("string"), F.lit("")) for m in ("source", "lang")}
    return {**value, "topic": F.col("__traits.topic")}


def tempered(counts: Mapping[str, float], power: float = 0.7) -> dict[str, float]:
    """Target shares that flatten the present ones: each share to a power, made to add up to 1."""
    total = sum(counts.values())
    raised = {v: (n / total) ** power for v, n in counts.items() if n > 0} if total else {}
    return {v: x / sum(raised.values()) for v, x in raised.items()}


def cells_of(df: DataFrame) -> DataFrame:
    """Tokens of each source, language and topic over all rows, in the shared folder."""
    cells = df.select(*[c.alias(m) for m, c in _cell(df).items()], F.col("__traits.tokens").alias("n"))
    return stored(cells.groupBy(*MARGINS).agg(F.sum("n").alias("n")), "cells")


def margin_counts(cells: DataFrame) -> dict[str, dict[str, float]]:
    """Tokens by value of each margin, of values with at least LEAST_SHARE of all tokens."""
    total = float(cells.agg(F.sum("n")).head()[0] or 0)
    least = max(LEAST_SHARE * total, 1.0)
    of = lambda m: cells.groupBy(m).agg(F.sum("n").alias("n")).where(F.col("n") >= least).collect()
    return {m: {r[m]: float(r["n"]) for r in of(m)} for m in MARGINS}


def rake(tokens: np.ndarray, cells: list[tuple[int, ...]], targets: list[np.ndarray], most: float | None = None) -> np.ndarray:
    """Probability of each cell, so that expected tokens have the target shares of each margin.

    `cells` has the position of each cell in each margin. Probabilities are the largest that
    fit, or those whose expected tokens are `most`; none exceeds 1. Targets of values that no
    cell has are spread over the others.
    """
    at = np.asarray(cells, np.int64).reshape(len(tokens), len(targets))
    weight = np.ones(len(tokens))
    shares = []
    for m, target in enumerate(targets):
        there = np.bincount(at[:, m], weights=tokens, minlength=len(target)) > 0
        share = np.where(there, target, 0.0)
        shares.append(share / share.sum() if share.sum() else np.zeros(len(target)))
    for _ in range(ROUNDS):
        worst = 0.0
        for m, share in enumerate(shares):
            now = np.bincount(at[:, m], weights=tokens * weight, minlength=len(share))
            now = now / now.sum() if now.sum() else now
            factor = np.divide(share, now, out=np.zeros_like(share), where=now > 0)
            worst = max(worst, np.abs(factor[now > 0] - 1).max(initial=0.0))
            weight = weight * factor[at[:, m]]
        if worst < CLOSE:
            break
    top = weight[tokens > 0].max(initial=0.0)
    scale = 1 / top if top else 0.0
    if most is not None and (expected := (tokens * weight).sum()):
        scale = min(scale, most / expected)
    return np.minimum(weight * scale, 1.0)


def mix(df: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, most: float | None = None, seed: int = 7, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Add `topic`, `tokens`, `probability` and `sampled` to every row.

    `targets` has shares by value for source, lang and topic; by default the present shares
    to the power 0.7. Values without a target, nulls among them if "" has none, are sampled
    like the present share of all others. Rows with the same key are sampled alike; a row
    without key by its text. Texts without words have no tokens to weigh and are sampled
    with the mean probability of their cell, or 1 if it has no other. An empty table gives
    an empty result; columns with the added names are replaced.
    """
    base = with_traits(fresh(df, "topic", "tokens", "probability", "sampled", "__traits", "__p"), text)
    every = cells_of(base)
    counts = margin_counts(every)
    wanted = {m: dict((targets or {}).get(m) or tempered(counts[m])) for m in MARGINS}
    names = {m: sorted(wanted[m]) for m in MARGINS}
    level = lambda m, c: F.when(c.isin(names[m]), c).otherwise(F.lit(OTHER)) if names[m] else F.lit(OTHER)
    own = {m: level(m, c) for m, c in _cell(base).items()}
    cells = every.select(*[level(m, F.col(m)).alias(m) for m in MARGINS], "n").groupBy(*MARGINS)
    # as many rows as the targets have combinations, at most
    rows = sorted(map(tuple, cells.agg(F.sum("n").alias("n")).collect()))
    if not rows:
        probability = {}
    else:
        levels = {m: {v: i for i, v in enumerate([*names[m], OTHER])} for m in MARGINS}
        tokens = np.array([float(r[3] or 0) for r in rows])
        position = [tuple(levels[m][v] for m, v in zip(MARGINS, r)) for r in rows]
        shares = []
        for i, m in enumerate(MARGINS):
            rest = sum(n for n, p in zip(tokens, position) if p[i] == len(names[m])) / max(tokens.sum(), 1)
            whole = sum(wanted[m].values()) or 1
            shares.append(np.array([*[wanted[m][v] / whole * (1 - rest) for v in names[m]], rest]))
        found = rake(tokens, position, shares, most)
        probability = {r[:3]: float(p) if n else 1.0 for r, p, n in zip(rows, found, tokens)}
    spark = df.sparkSession
    table = spark.createDataFrame([(*k, p) for k, p in probability.items()], ", ".join(f"__{m} string" for m in MARGINS) + ", __p double")
    keyed = base.withColumns({f"__{m}": c for m, c in own.items()})
    joined = keyed.join(F.broadcast(table), [f"__{m}" for m in MARGINS], "left")
    # a fixed draw for each key
    draw = F.pmod(F.xxhash64(F.coalesce(F.col(f"`{key}`").cast("string"), F.concat(F.lit("text "), F.coalesce(F.col(f"`{text}`"), F.lit("")))), F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)
    out = joined.withColumns({"topic": F.col("__traits.topic"), "tokens": F.col("__traits.tokens"), "probability": F.col("__p"), "sampled": draw < F.col("__p")})
    return out.drop("__traits", "__p", *[f"__{m}" for m in MARGINS])


def digests(mixed: DataFrame) -> DataFrame:
    return mixed.select("doc_id", "source", "lang", "topic", "tokens", F.round("probability", 9).alias("probability"), "sampled")
