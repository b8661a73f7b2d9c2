"""License scans with a positional index of rare licence words.

The rarest words of every licence notice, counted over the whole corpus, form the index:
word -> (notice, position). A file's words that are in the index propose notices at places
(its position less the notice's), mandatory key phrases are verified there word by word,
and words that agree on notice and place add up, weighted by rarity. Spark expressions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh, lower_ascii

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Notice:
    """A licence notice, the phrase in it that must be there, and whether it is a base phrase."""

    label: str
    text: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_at(self) -> int:
        words, key = self.words, self.key.split()
        return next(i for i in range(len(words)) if words[i : i + len(key)] == key)


# Base phrases, which are whole notices of their own, and notices of licences.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
NOTICES = (
    *(Notice(label, phrase, phrase, True) for phrase, label in BASE_PHRASES.items()),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    Notice("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", "www apache org licenses license 2 0"),
    Notice("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial international license", "creative commons attribution noncommercial"),
    Notice("cc-by-sa", "this work is licensed under a creative commons attribution sharealike international license", "creative commons attribution sharealike"),
    Notice("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Notice("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "terms of the gnu general public license"),
    Notice("gpl", "this work is licensed under the gnu general public license version", "under the gnu general public license"),
    Notice("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    Notice("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software"),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software released into the public domain"),
)
RARE = 6  # words of a notice in the index
LEAST = 0.5  # share of a notice's weight that must agree


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def seen_in(df: DataFrame, text: str, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Rows, and rows with each word of the vocabulary: as many numbers as it has words."""
    of = df.select(F.array_intersect(words(F.col(f"`{text}`")), F.array(*map(F.lit, vocabulary))).alias("w"))
    # a row without such words still counts
    rows = of.select(F.explode(F.concat(F.col("w"), F.array(F.lit("")))).alias("word")).groupBy("word").count().collect()
    counts = {r["word"]: r["count"] for r in rows}
    return counts.pop("", 0), counts


def index_of(n: int, seen: dict[str, int], notices: tuple[Notice, ...] = NOTICES) -> list[list[tuple[str, int, float]]]:
    """For each notice its rarest words with their first position and their share of its weight."""
    out = []
    for notice in notices:
        first = {w: notice.words.index(w) for w in notice.words}
        rarest = sorted(first, key=lambda w: (seen.get(w, 0), w))[: 1 if notice.base else RARE]
        weight = {w: math.log(1 + (n + 1) / (seen.get(w, 0) + 1)) for w in rarest}
        total = math.fsum(weight.values())
        out.append([(w, first[w], weight[w] / total) for w in rarest])
    return out


def scan_licenses(df: DataFrame, text: str = "text") -> DataFrame:
    """Add `licenses`: notice, place (in words), share and verified start of what was found.

    Also adds `n_words`. A null or empty text has no words and nothing found; rows are
    neither dropped nor merged; columns named `licenses` or `n_words` are replaced. Word
    counts cover all rows of df. Places of base phrases are all kept, each once.
    """
    vocabulary = sorted({w for notice in NOTICES for w in notice.words})
    index = index_of(*seen_in(df, text, vocabulary))
    postings: dict[str, list[tuple[int, int, float]]] = {}
    for t, rows in enumerate(index):
        for w, at, share in rows:
            postings.setdefault(w, []).append((t, at, share))
    rare = F.array(*[F.lit(w) for w in sorted(postings)])

    work = fresh(df, "n_words", "licenses", "__w", "__rare", "__hits").withColumn("__w", words(F.col(f"`{text}`")))
    work = work.withColumn("n_words", F.size("__w").cast("bigint")).withColumn("__rare", F.array_intersect("__w", rare))
    hit = F.transform("__w", lambda w, i: F.when(F.array_contains("__rare", w), F.struct(w.alias("w"), i.alias("i"))))
    none = F.array().cast("array<struct<w:string,i:int>>")
    work = work.withColumn("__hits", F.when(F.size("__rare") > 0, F.filter(hit, lambda h: h.isNotNull())).otherwise(none))

    def proposals(h: Column) -> Column:
        """Notices at places that a word proposes, verified by their key phrases."""
        cases, of = None, lambda rows: F.array(
            *[
                F.when(
                    (h["i"] >= at - NOTICES[t].key_at)
                    & (
                        F.slice("__w", F.greatest(h["i"] - at + NOTICES[t].key_at, F.lit(0)) + 1, len(NOTICES[t].key.split()))
                        == F.array(*map(F.lit, NOTICES[t].key.split()))
                    ),
                    F.struct(F.lit(t).alias("t"), (h["i"] - at).alias("at"), F.lit(share).alias("share")),
                )
                for t, at, share in rows
            ]
        )
        for w, rows in postings.items():
            cases = F.when(h["w"] == w, of(rows)) if cases is None else cases.when(h["w"] == w, of(rows))
        return F.filter(cases, lambda x: x.isNotNull())

    votes = F.array_sort(F.flatten(F.transform("__hits", proposals)))
    # Votes for a notice at a place stand together now; one pass adds them up.
    row = "struct<t:int,at:int,share:double>"
    start = F.struct(F.array().cast(f"array<{row}>").alias("done"), F.lit(None).cast(row).alias("last"))

    def step(acc: Column, v: Column) -> Column:
        same = F.coalesce((acc["last"]["t"] == v["t"]) & (acc["last"]["at"] == v["at"]), F.lit(False))
        closed = F.filter(F.array(acc["last"]), lambda x: x.isNotNull())
        return F.struct(
            F.when(same, acc["done"]).otherwise(F.concat(acc["done"], closed)).alias("done"),
            F.struct(v["t"].alias("t"), v["at"].alias("at"), (v["share"] + F.when(same, acc["last"]["share"]).otherwise(0.0)).alias("share")).alias("last"),
        )

    found = F.aggregate(votes, start, step, lambda acc: F.filter(F.concat(acc["done"], F.array(acc["last"])), lambda x: x.isNotNull() & (x["share"] >= LEAST)))
    nothing = F.array().cast(f"array<{row}>")
    return work.withColumn("licenses", F.when(F.size("__hits") > 0, found).otherwise(nothing)).drop("__w", "__rare", "__hits")


def digests(scanned: DataFrame) -> DataFrame:
    bases = sum(n.base for n in NOTICES)
    names = F.array(*[F.lit(n.label) for n in NOTICES])
    base = F.filter("licenses", lambda x: x["t"] < bases)
    labels = lambda rows: F.array_join(F.array_sort(F.array_distinct(F.transform(rows, lambda x: F.get(names, x["t"])))), ",")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(F.transform(base, lambda x: x["at"])).cast("bigint").alias("first_word"),
        F.array_max(F.transform(base, lambda x: x["at"])).cast("bigint").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("licenses")).alias("labels"),
        F.round(F.least(F.lit(1.0), F.coalesce(F.array_max(F.transform("licenses", lambda x: x["share"])), F.lit(0.0))), 6).alias("score"),
    )


def oracle() -> str:
    """DuckDB SQL for the rows of the query."""
    notices = ", ".join(f"({t}, '{n.label}', {n.base}, {1 if n.base else RARE}, '{n.text}', '{n.key}', {n.key_at})" for t, n in enumerate(NOTICES))
    return f"""
with notices as (select * from (values {notices}) v(t, label, base, rare, txt, key, key_at)),
docs as (select row_number() over () as r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as ws from documents),
tokens as (select r, unnest(range(len(ws))) as i, unnest(ws) as w from docs),
posts as (select t, w, min(q) as q from (select t, unnest(range(len(string_split(txt, ' ')))) as q, unnest(string_split(txt, ' ')) as w from notices) group by t, w),
seen as (select w, count(distinct r) as n from tokens where w in (select w from posts) group by w),
ranked as (
  select t, w, q, ln(1 + ((select count(*) from docs) + 1) / (coalesce(n, 0) + 1)::double) as weight,
    row_number() over (partition by t order by coalesce(n, 0), w) as k from posts left join seen using (w)),
rare as (select t, w, q, weight / sum(weight) over (partition by t) as share from ranked join notices using (t) where k <= rare),
votes as (select r, t, i - q as place, sum(share) as share from tokens join rare using (w) group by r, t, i - q),
found as (
  select r, t, label, base, place, share from votes join notices using (t) join docs using (r)
  where share >= {LEAST} and place + key_at >= 0
    and ws[place + key_at + 1:place + key_at + len(string_split(key, ' '))] = string_split(key, ' ')),
summed as (
  select r, count(*) filter (base) as n_base, min(place) filter (base) as first_word, max(place) filter (base) as last_word,
    array_to_string(list_sort(list(distinct label) filter (base)), ',') as base_labels,
    array_to_string(list_sort(list(distinct label)), ',') as labels, max(share) as share
  from found group by r)
select doc_id, len(ws)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, round(least(1.0, coalesce(share, 0)), 6)::double as score
from docs left join summed using (r)
"""
