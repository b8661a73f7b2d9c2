"""Validity intervals: reading them from text, merging, and joining points to them.

Points and intervals meet on the key and on a calendar-year bucket. Each interval is
repeated once for every year it touches, so a pair is found exactly once, in the year of
its point, and the points of one hot key spread over many buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import date_lit, parse_dm_any_year
from ..functions.text import col, strip_lower

# How a period is written in a remark.
PERIOD_PATTERN = r"from \d{2}/\d{2}/\d{2,4} to \d{2}/\d{2}/\d{2,4}"
FROM_FULL_YEAR = r"from (\d{2}/\d{2}/(?:\d{4}|\d{2}))"
TO_FULL_YEAR = r"to (\d{2}/\d{2}/(?:\d{4}|\d{2}))"
FROM_TWO_DIGITS = r"from (\d{2}/\d{2}/\d{2})"
TO_TWO_DIGITS = r"to (\d{2}/\d{2}/\d{2})"

_BUCKET = "__year"


def extract_periods(
    df: DataFrame, text: str, start: str = "from_date", end: str = "to_date", strict: bool = False
) -> DataFrame:
    """Periods named in a text column; rows without one, or not from < to, are dropped.

    By default four-digit years are read in full. `strict` reads the first two digits of
    any year, so that 2016 becomes 2020.
    """
    patterns = (FROM_TWO_DIGITS, TO_TWO_DIGITS) if strict else (FROM_FULL_YEAR, TO_FULL_YEAR)
    remark = strip_lower(text)
    # where nothing matches, the extracted text is empty and so is no date
    first, last = (parse_dm_any_year(F.regexp_extract("__remark", p, 1)) for p in patterns)
    return (
        df.withColumn("__remark", remark)
        .where(F.col("__remark").rlike(PERIOD_PATTERN))
        .withColumns({start: first, end: last})
        .drop("__remark")
        .where(F.col(start) < F.col(end))
    )


def merge_periods(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Disjoint periods per key that cover the same days.

    The first step keeps one period per key and start day, so what a key brings to the
    window is bounded by the calendar however many rows it has.
    """
    longest = df.groupBy(*keys, start).agg(F.max(end).alias(end))
    before = Window.partitionBy(*keys).orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max(end).over(before)
    opens = F.when(reached >= F.col(start), 0).otherwise(1)
    upto = Window.partitionBy(*keys).orderBy(start)
    return (
        longest.withColumn("__opens", opens)
        .withColumn("__block", F.sum("__opens").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "__block")
        .agg(F.min(start).alias(start), F.max(end).alias(end))
        .drop("__block")
    )


def interval_join(
    points: DataFrame,
    periods: DataFrame,
    keys: Sequence[str],
    point: str,
    start: str,
    end: str,
    how: str = "inner",
) -> DataFrame:
    """Join each point to the periods of its key that contain it, both ends included.

    how='inner' gives every pair; how='left_semi' gives each point inside any period once.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(f"how must be 'inner' or 'left_semi', not {how!r}")
    if how == "left_semi":
        periods = merge_periods(periods, keys, start, end)
    p = points.withColumn(_BUCKET, F.year(point)).alias("p")
    years = F.sequence(F.year(start), F.year(end))
    q = (
        periods.where(F.col(start) <= F.col(end))
        .withColumn(_BUCKET, F.explode(years))
        .alias("q")
    )
    matches = F.col(f"p.{point}").between(F.col(f"q.{start}"), F.col(f"q.{end}"))
    for k in [*keys, _BUCKET]:
        matches = matches & (F.col(f"p.{k}") == F.col(f"q.{k}"))
    joined = p.join(q, matches, how)
    if how == "left_semi":
        return joined.select("p.*").drop(_BUCKET)
    extra = [c for c in periods.columns if c not in keys]
    return joined.select("p.*", *[f"q.{c}" for c in extra]).drop(_BUCKET)


def contains_day(day, start: Column | str, end: Column | str) -> Column:
    """Whether a fixed day lies in the period, both ends included."""
    return date_lit(day).between(col(start), col(end))
