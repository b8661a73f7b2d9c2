"""Document fingerprints: chains of content words that follow common-word anchors.

Every anchor (a common word of a language) with the two content words after it is a spot
signature; the fingerprint of a text is the set of its signatures. Sets are compared by
Jaccard likeness, pruned by their lengths. Spark expressions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import fresh, lower_ascii

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "he", "in", "is", "it", "of", "on", "or", "that",
    "the", "this", "to", "was", "were", "with", "auf", "das", "der", "des", "die", "ein", "eine", "ist", "mit", "nicht",
    "sich", "und", "von", "zu", "au", "dans", "de", "du", "en", "est", "et", "la", "le", "les", "par", "pour", "que",
    "qui", "sur", "un", "une", "con", "del", "el", "las", "los", "no", "para", "se", "su",
)
# Characters other than ASCII letters and digits part words.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY = "|".join(ANCHORS)
START = "^"  # the start of a text is an anchor too, so every text with a word has a signature
# No repeated group here, whose depth in the pattern engine would grow with the text.
ANCHOR = rf"(?<= )({ANY}|\^) "


def fingerprint(text: Column) -> Column:
    """Signatures of a text: sorted, distinct, hashed to eight hexadecimal digits, with commas.

    Equal texts have equal fingerprints; an empty or null text has an empty one.
    """
    words = F.trim(F.regexp_replace(lower_ascii(text), GAPS, " "))
    marked = F.regexp_replace(F.concat(F.lit(f" {START} "), words, F.lit(" ")), ANCHOR, "$1,")
    content = F.split(F.trim(marked), " ")
    after = F.concat(F.slice(content, 2, F.size(content)), F.array(F.lit("")))
    chains = F.zip_with(
        content,
        after,
        # of a run of anchors, which all lead to the same content words, the last one counts
        lambda w, n: F.when(F.contains(w, F.lit(",")), F.concat(F.substring_index(w, ",", -2), F.lit(" "), F.substring_index(n, ",", -1))),
    )
    found = F.array_distinct(F.transform(F.filter(chains, lambda c: c.isNotNull()), lambda c: F.substring(F.md5(c), 1, 8)))
    return F.when(words == "", "").otherwise(F.array_join(F.sort_array(found), ","))


def members(print_: Column) -> Column:
    return F.filter(F.split(print_, ","), lambda x: x != "")


def n_signatures(print_: Column) -> Column:
    return F.floor((F.length(print_) + 1) / 9)


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard likeness of two fingerprints; two empty ones are alike, an empty one and another not.

    Sets whose lengths alone rule out `at_least` are not compared and count as 0.
    """
    n, m = n_signatures(a), n_signatures(b)
    shared = F.size(F.array_intersect(members(a), members(b)))
    exact = shared / (n + m - shared)
    return (
        F.when(a == b, 1.0)
        .when((n == 0) | (m == 0) | (F.least(n, m) < at_least * F.greatest(n, m)), 0.0)
        .otherwise(exact)
        .cast("double")
    )


def length_class(n: Column, at_least: float) -> Column:
    """Partition of a set length: alike sets lie in the same class or in neighbouring ones."""
    return F.floor(F.log(F.greatest(n, F.lit(1))) / -math.log(at_least)).cast("int")


def alike(df: DataFrame, at_least: float = 0.8, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Pairs of different fingerprints that are at least so alike: `a`, `b`, `likeness`.

    Equal fingerprints count as one class, named by its smallest key, so copies make no
    pairs. Sets are partitioned by length and meet, within a class or in the one above, on
    one of their rarest signatures: alike sets share one among the first n - ceil(t n) + 1.
    Texts without a signature are in no pair.
    """
    prints = df.select(F.col(f"`{key}`").alias("id"), fingerprint(F.col(f"`{text}`")).alias("print")).where("print <> ''")
    sets = prints.groupBy("print").agg(F.min("id").alias("id")).withColumn("n", n_signatures(F.col("print")))
    rows = sets.select("id", "n", F.explode(members(F.col("print"))).alias("sig"))
    counts = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("seen"))
    rarest = Window.partitionBy("id").orderBy("seen", "sig")
    needed = F.col("n") - F.ceil(F.col("n") * at_least - 1e-9) + 1
    first = rows.join(counts, "sig").withColumn("pos", F.row_number().over(rarest)).where(F.col("pos") <= needed)
    own = length_class(F.col("n"), at_least)
    left = first.select("sig", F.col("id").alias("a"), F.col("n").alias("n_a"), F.explode(F.array(own, own + 1)).alias("class"))
    right = first.select("sig", F.col("id").alias("b"), F.col("n").alias("n_b"), own.alias("class"))
    # The smaller set looks into its own class and the next; of equal sets the smaller key.
    ordered = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    near = left.join(right, ["sig", "class"]).where(ordered & (F.col("n_a") >= F.col("n_b") * at_least - 1e-9))
    pairs = near.select("a", "b").distinct()
    of = lambda side: sets.select(F.col("id").alias(side), F.col("print").alias(f"{side}_print"))
    checked = pairs.join(of("a"), "a").join(of("b"), "b")
    value = likeness(F.col("a_print"), F.col("b_print"), at_least)
    return checked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), value.alias("likeness")).where(
        F.col("likeness") >= at_least - 1e-9
    )


def _bounds(df: DataFrame, key: str, n: int) -> tuple[list[int], list[int]]:
    """First key of each of n ranges of about as many rows, and the greatest key of each.

    Both are as many numbers as there are ranges, whatever the rows.
    """
    shares = [i / n for i in range(n)]
    found = df.agg(F.percentile_approx(key, shares, max(10_000, 10 * n)), F.min(key)).head()
    bounds = sorted({*(found[0] or []), *([found[1]] if found[1] is not None else [])})
    if not bounds:
        return [], []
    tops = df.where(F.col(key).isNotNull()).groupBy(_range_of(F.col(key), bounds).alias("r")).agg(F.max(key)).collect()
    top = dict(map(tuple, tops))
    return bounds, [top[i] for i in range(len(bounds))]


def _range_of(key: Column, bounds: list[int]) -> Column:
    """Which range a key lies in; searched in two steps, first among every s-th bound."""
    step = max(1, math.isqrt(len(bounds)))
    number = lambda values: F.array(*[F.lit(v).cast("bigint") for v in values])
    coarse = F.size(F.filter(number(bounds[::step]), lambda b: b <= key)) - 1
    fine = F.slice(number(bounds), coarse * step + 1, step)
    return (coarse * step + F.size(F.filter(fine, lambda b: b <= key)) - 1).cast("int")


def with_next(df: DataFrame, key: str, wanted: list[str]) -> DataFrame:
    """Add `next_<column>`: values of the row that follows in descending order of the key.

    The last row is followed by the first, a row without key by itself; repeated keys are
    ordered by the wanted columns. Rows are dealt by ranges of keys and sorted there. The
    first row of each range is also sent to the range before it, so that rows move once.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds, tops = _bounds(df, key, 8 * parts)
    names = df.columns
    alone = df.where(F.col(key).isNull()).select("*", *[F.col(c).alias(f"next_{c}") for c in wanted])
    if not bounds:
        return alone
    ranges = len(bounds)
    keyed = df.where(F.col(key).isNotNull()).withColumn("__range", _range_of(F.col(key), bounds))
    top = F.element_at(F.array(*[F.lit(t).cast("bigint") for t in tops]), F.col("__range") + 1)
    own = F.struct(F.col("__range").alias("r"), F.lit(False).alias("copy"))
    copy = F.struct(((F.col("__range") + 1) % ranges).alias("r"), F.lit(True).alias("copy"))
    dealt = keyed.withColumn("__to", F.explode(F.when(F.col(key) == top, F.array(own, copy)).otherwise(F.array(own))))
    order = Window.partitionBy("__to.r").orderBy(F.col("__to.copy"), F.desc(key), *[F.asc(c) for c in wanted])
    led = dealt.withColumns({f"next_{c}": F.lead(F.struct(c)).over(order)[c] for c in wanted})
    return led.where(~F.col("__to.copy")).select(*names, *[f"next_{c}" for c in wanted]).unionByName(alone)


def fingerprints(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Fingerprint of each document and of its edited text, and how alike they are.

    The edited text has its last third replaced by the start of the next document in
    descending doc_id (as much of it as there is). Works on whole texts; a null text is
    empty, repeated rows come back as often, other columns are left out.
    """
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    own = documents.select("doc_id", text).withColumn("print", fingerprint(F.col("text")))
    led = with_next(own, "doc_id", ["text", "print"])
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - third), F.substring(F.col("next_text"), F.lit(1), third))
    both = led.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), edited.alias("edited"), "print", "next_print")
    full = both.withColumn("edited_print", fingerprint(F.col("edited")))
    return full.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("print").alias("fingerprint"),
        F.col("edited_print").alias("edited_fingerprint"),
        F.round(likeness(F.col("print"), F.col("edited_print")), 9).alias("near_edited"),
        F.round(likeness(F.col("print"), F.col("next_print")), 9).alias("near_next"),
        n_signatures(F.col("print")).cast("bigint").alias("n_signatures"),
        length_class(n_signatures(F.col("print")), 0.8).cast("bigint").alias("length_class"),
    )


def oracle() -> str:
    """DuckDB SQL for the rows of the query."""
    words = f"trim(regexp_replace(translate({{t}}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{GAPS}', ' ', 'g'))"
    anchors = ", ".join(f"'{a}'" for a in (*ANCHORS, START))

    def prints(source: str, name: str) -> str:
        return f"""
{name}_tokens as (select r, i, w, w in ({anchors}) as anchor from (
  select r, unnest(range(1, len(ws) + 1)) as i, unnest(ws) as w from (
    select r, string_split('{START} ' || s, ' ') as ws from (select r, {words.format(t="t")} as s from {source}) where s <> ''))),
{name}_content as (
  select r, i, anchor, w, lag(w) over (partition by r order by i) as before, lag(anchor) over (partition by r order by i) as after_anchor from {name}_tokens),
{name}_chain as (
  select r, before, w, after_anchor, coalesce(lead(w) over (partition by r order by i), '') as then_ from {name}_content where not anchor),
{name}_last as (select r, w || ', ' as sig, i from {name}_tokens qualify anchor and i = max(i) over (partition by r)),
{name} as (
  select r, string_agg(sig, ',' order by sig) as print, list(sig) as sigs from (
    select distinct r, md5(sig)[1:8] as sig from (
      select r, before || ',' || w || ' ' || then_ as sig from {name}_chain where after_anchor
      union all select r, sig from {name}_last)) group by r)"""

    def like(a: str, b: str) -> str:
        shared = f"len(list_intersect({a}.sigs, {b}.sigs))"
        return f"""round(case when coalesce({a}.print, '') = coalesce({b}.print, '') then 1.0 when {a}.print is null or {b}.print is null then 0.0
    else {shared} / (len({a}.sigs) + len({b}.sigs) - {shared})::double end::double, 9)"""

    return f"""
with docs as (select row_number() over (order by doc_id desc, text) as r, doc_id, coalesce(text, '') as t from documents),
nexts as (select a.r, a.doc_id, a.t, b.r as next_r, b.t as next_t from docs a join docs b on b.r = a.r % (select count(*) from docs) + 1),
edits as (select r, t[1:length(t) - length(t) // 3] || substring(next_t, 1, (length(t) // 3)::int) as t from nexts),
{prints("docs", "own")},
{prints("edits", "edited")}
select n.doc_id, length(n.t)::bigint as n_chars, sha256(e.t) as edited_sha256, coalesce(o.print, '') as fingerprint,
  coalesce(p.print, '') as edited_fingerprint, {like("o", "p")} as near_edited, {like("o", "x")} as near_next,
  coalesce(len(o.sigs), 0)::bigint as n_signatures,
  floor(ln(greatest(coalesce(len(o.sigs), 0), 1)) / {-math.log(0.8)!r})::bigint as length_class
from nexts n join edits e using (r) left join own o on o.r = n.r left join edited p on p.r = n.r left join own x on x.r = n.next_r
"""
