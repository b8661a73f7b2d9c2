"""Personal data in texts: proposed by patterns, confirmed by checksums, weighed by context.

All in Spark expressions: no exchange, no Python. Positions of matches are sums of lengths:
`split` gives the gaps between the matches that `regexp_extract_all` gives.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")

# The patterns. They match what the plain forms match: a possessive quantifier
# stands where giving back characters could not help, and a look behind where a match can
# only start at the start of a run, so that long runs cost linear time and no stack.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
# Words that make a kind likelier when they stand shortly before a match.
CONTEXT = {
    "email": "mail|contact|write",
    "ip": "ip|address|host|server",
    "card": "card|visa|credit|payment",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|account|bank|konto",
    "ssn": "ssn|social|security",
}
NEAR = 40  # characters before a match in which context words count
PROPOSED, CONFIRMED, NEARBY = 0.3, 0.4, 0.3  # shares of a score
LEAST = 0.5  # score from which spans beyond the base kinds are reported
MASKS = {k: f"[{k.upper()}]" for k in KINDS}


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits pass the Luhn checksum."""
    doubled = F.transform(
        F.split(F.reverse(number), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod_97(value: Column) -> Column:
    """Whether an account number, moved round and with letters as numbers, leaves 1."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        number = F.ascii(c) - 48  # digits; letters are 10 for A and so on
        return F.when(number < 10, (acc * 10 + number) % 97).otherwise((acc * 100 + number - 7) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def confirmed(kind: str, value: Column) -> Column:
    """The validator of a kind: a checksum where there is one, else its bounds."""
    n = F.length(digits(value))
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(n.between(12, 19), luhn(digits(value))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    if kind == "iban":
        return mod_97(value)
    if kind == "ssn":
        return ~value.rlike("^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def has_checksum(kind: str) -> bool:
    return kind in ("card", "iban")


def placed(text: Column, kind: str) -> Column:
    """Start, end and text of every match of a kind, from left to right."""
    sign = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+")), "ip": text.rlike(r"[0-9]\.[0-9]")}
    maybe = sign.get(kind, text.rlike(r"[0-9][0-9 -][0-9]"))
    found = F.when(maybe, F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)))
    return F.when(F.size(found) > 0, found)


def spans_of(text: Column, found: Column, kind: str) -> Column:
    gaps = F.slice(F.split(text, PATTERNS[kind], -1), 1, F.size(found))
    steps = F.zip_with(gaps, found, lambda g, v: F.struct(F.length(g).alias("gap"), F.length(v).alias("len"), v.alias("value")))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    walked = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["len"]).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        (acc["at"] + x["gap"]).alias("start"),
                        (acc["at"] + x["gap"] + x["len"]).alias("end"),
                        x["value"].alias("value"),
                    )
                ),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    good = F.filter(walked, lambda s: confirmed(kind, s["value"]))

    def scored(s: Column) -> Column:
        # a position before the start would count from the end, hence the bounds
        start = F.greatest(s["start"] - NEAR, F.lit(0))
        before = F.lower(F.substring(text, start + 1, s["start"] - start))
        score = F.lit(PROPOSED) + F.when(before.rlike(CONTEXT[kind]), NEARBY).otherwise(0.0)
        if has_checksum(kind):
            score = score + CONFIRMED
        if kind == "ssn":  # part of a longer number is none
            outer = F.concat(F.substring(text, F.greatest(s["start"], F.lit(1)), F.least(s["start"], F.lit(1))), F.lit("|"), F.substring(text, s["end"] + 1, 1))
            score = F.when(outer.rlike("[0-9]"), F.lit(0.0)).otherwise(score)
        return F.struct(
            s["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            F.round(score, 2).alias("score"),
        )

    out = F.transform(good, scored)
    return out if kind in BASE else F.filter(out, lambda s: s["score"] >= LEAST)


def pii_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """Add `pii`: start, kind, end and score of all personal data, by start and kind.

    Positions are code points from 0, the end exclusive. Kinds email, ip, card and phone are
    reported whenever pattern and validator agree; account numbers (mod-97) and social
    security numbers (which need a context word) from a score of a half on. A null or empty
    text has no spans. Rows are neither dropped nor merged; a column named `pii` is replaced.
    """
    source = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    work = fresh(df, "pii", "__text", *[f"__{k}" for k in KINDS]).withColumn("__text", source)
    work = work.withColumns({f"__{k}": placed(F.col("__text"), k) for k in KINDS})
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,score:double>>")
    each = [
        F.when(F.col(f"__{k}").isNotNull(), spans_of(F.col("__text"), F.col(f"__{k}"), k)).otherwise(none) for k in KINDS
    ]
    some = reduce(lambda a, b: a | b, [F.col(f"__{k}").isNotNull() for k in KINDS])
    found = F.when(some, F.array_sort(F.concat(*each))).otherwise(none)
    return work.withColumn("pii", found).drop("__text", *[f"__{k}" for k in KINDS])


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind; of overlapping ones the first names them."""
    marks = F.create_map(*[F.lit(x) for kv in MASKS.items() for x in kv])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        clear = s["start"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        out = F.when(clear, F.concat(acc["out"], gap, marks[s["kind"]])).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)


def mask_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with personal data in `text` replaced by `[EMAIL]` and so on; columns stay."""
    names = [f"`{c}`" for c in df.columns]
    hit = pii_spans(df.withColumnRenamed("pii", "__own_pii"), text)
    out = hit.withColumn(text, masked(F.col(f"`{text}`"), F.col("pii"))).drop("pii")
    return out.withColumnRenamed("__own_pii", "pii").select(*names)


def digests(found: DataFrame) -> DataFrame:
    label = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("pii", lambda s: s["rank"] < len(BASE))
    count = lambda i: F.size(F.filter("pii", lambda s: s["rank"] == i)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE)],
        F.sha2(F.array_join(F.transform(base, label), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("pii", label), ",").alias("spans"),
        F.coalesce(F.array_max(F.transform("pii", lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )


# The same in SQL, with the plain patterns.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([ -]?[0-9])+",
    "phone": PATTERNS["phone"],
    "iban": PATTERNS["iban"],
    "ssn": PATTERNS["ssn"],
}


def oracle() -> str:
    """DuckDB SQL for the rows of the query."""
    kinds = "\nunion all\n".join(
        f"""select doc_id, s, {i} as rank, '{k}' as kind, '{CONTEXT[k]}' as words,
    regexp_extract_all(s, '{p}') as found, regexp_split_to_array(s, '{p}') as gaps from docs"""
        for i, (k, p) in enumerate(PLAIN.items())
    )
    return rf"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as s from documents),
matches as ({kinds.replace("select doc_id,", "select r, doc_id,")}),
walked as (
  select r, s, rank, kind, words, unnest(found) as value,
    unnest(list_transform(range(1, len(found) + 1), lambda k:
      list_sum(list_transform(gaps[1:k], lambda g: length(g)))
      + coalesce(list_sum(list_transform(found[1:k - 1], lambda g: length(g))), 0)))::bigint as start
  from matches where len(found) > 0),
plain as (
  select *, start + length(value) as stop, regexp_replace(value, '[^0-9]', '', 'g') as digits,
    replace(value, ' ', '') as packed,
    lower(s[greatest(start - {NEAR}, 0) + 1:start]) as before, s[start:start] as ahead, s[start + length(value) + 1:start + length(value) + 1] as behind
  from walked),
checked as (
  select *, case kind
    when 'email' then true
    when 'ip' then list_bool_and(list_transform(string_split(value, '.'), lambda p: length(ltrim(p, '0')) <= 3 and coalesce(try_cast(ltrim(p, '0') as int), 0) <= 255))
    when 'card' then length(digits) between 12 and 19 and list_sum(list_transform(range(1, length(digits) + 1), lambda k:
      case when k % 2 = 1 then reverse(digits)[k]::int else (reverse(digits)[k]::int * 2) % 10 + (reverse(digits)[k]::int // 5) end)) % 10 = 0
    when 'phone' then length(digits) between 9 and 15
    when 'ssn' then not regexp_matches(value, '^(000|666|9)|-00-|-0000$')
    else list_reduce(list_prepend(0, list_transform(string_split(packed[5:] || packed[1:4], ''), lambda c: ascii(c) - 48)),
      lambda a, b: case when b < 10 then (a * 10 + b) % 97 else (a * 100 + b - 7) % 97 end) = 1
    end as good,
    case when kind = 'ssn' and (regexp_matches(ahead, '[0-9]') and start > 0 or regexp_matches(behind, '[0-9]')) then 0.0
      else round({PROPOSED} + case when regexp_matches(before, words) then {NEARBY} else 0 end + case when kind in ('card', 'iban') then {CONFIRMED} else 0 end, 2) end::double as score
  from plain),
spans as (
  select r, rank, start, kind || ':' || start || ':' || stop as span, score from checked
  where good and (rank < {len(BASE)} or score >= {LEAST})),
joined as (
  select r, {", ".join(f"count(*) filter (rank = {i}) as n_{k}" for i, k in enumerate(BASE))},
    string_agg(span, ',' order by start, rank) filter (rank < {len(BASE)}) as base,
    string_agg(span, ',' order by start, rank) as spans, max(score) as top_score
  from spans group by r)
select doc_id, {", ".join(f"coalesce(n_{k}, 0)::bigint as n_{k}" for k in BASE)},
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(top_score, 0)::double as top_score
from docs left join joined using (r)
"""
