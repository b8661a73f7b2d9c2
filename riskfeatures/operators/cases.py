"""Court cases: one record per case, and how many are open."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import date_lit

FILED, DISPOSED = "filed", "disposed"


def worked_out(df: DataFrame) -> DataFrame:
    """df, whose columns are worked out once for each row: a filter on them stays above and does
    not repeat their expressions, as it would below a projection."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def dedup_cases(
    df: DataFrame,
    keys: Sequence[str],
    filed: str = FILED,
    disposed: str = DISPOSED,
    flags: Sequence[str] = (),
) -> DataFrame:
    """One row per case: first filing, last disposal, and flags set by any of its rows."""
    return df.groupBy(*keys).agg(
        F.min(filed).alias(filed),
        F.max(disposed).alias(disposed),
        *[F.max(f).alias(f) for f in flags],
    )


def open_now(cases: DataFrame, group: Sequence[str], features: Mapping[str, Column | None]) -> DataFrame:
    """Filed minus disposed cases per group. Each feature may have a condition on cases."""
    return _open(cases, group, features, lambda c: F.count(c(FILED)) - F.count(c(DISPOSED)))


def open_as_of(
    cases: DataFrame, group: Sequence[str], day: dt.date, features: Mapping[str, Column | None]
) -> DataFrame:
    """Cases filed up to a day minus those disposed up to it; no daily series is built."""
    upto = lambda c: F.when(c <= date_lit(day), 1)
    return _open(
        cases, group, features, lambda c: F.count(upto(c(FILED))) - F.count(upto(c(DISPOSED)))
    )


def _open(cases, group, features, formula) -> DataFrame:
    aggs = []
    for name, condition in features.items():
        if condition is None:
            aggs.append(formula(F.col).alias(name))
            continue
        hit = F.when(condition, 1)
        column = lambda c, hit=hit: F.when(hit == 1, F.col(c))
        # a group without any such case has no value, as if it had no row
        aggs.append(F.when(F.count(hit) > 0, formula(column)).alias(name))
    return cases.groupBy(*group).agg(*aggs)


def open_daily(
    cases: DataFrame, group: Sequence[str], start: dt.date, end: dt.date, out: str, text: bool = False
) -> DataFrame:
    """Open cases per group and day: every day from start to end, and earlier event days.

    Running totals are taken over the days on which something happened; the quiet days
    after each are then filled in by repeating its total, so the dense series is neither
    shuffled nor sorted. The cases are read once. `text` gives the days as text, cut from
    one list of all days, which is cheaper than writing out each of them.
    """
    per_day = [*group, "as_on_date"]

    def on(day: Column, change: int) -> Column:
        return F.struct(day.cast("date").alias("as_on_date"), F.lit(change).cast("bigint").alias("change"))

    upto_end = lambda c: F.when(F.col(c) <= date_lit(end), F.col(c))
    opening, filed, closed = on(date_lit(start), 0), on(upto_end(FILED), 1), on(upto_end(DISPOSED), -1)
    events = (
        cases.select(*group, F.inline(F.array(opening, filed, closed)))
        .where(F.col("as_on_date").isNotNull())
        .groupBy(*per_day)
        .agg(F.sum("change").alias("change"))
    )
    w = Window.partitionBy(*group).orderBy("as_on_date")
    running = events.select(
        *per_day,
        F.sum("change").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(out),
        F.coalesce(F.lead("as_on_date").over(w), date_lit(end + dt.timedelta(days=1))).alias("__next"),
    )
    early = F.col("as_on_date") < date_lit(start)
    if not text:
        days = F.sequence("as_on_date", F.when(early, F.col("as_on_date")).otherwise(F.date_sub("__next", 1)))
    else:
        # a constant, which Spark splits once
        listed = ",".join(str(start + dt.timedelta(days=i)) for i in range((end - start).days + 1))
        days = F.when(early, F.array(F.col("as_on_date").cast("string"))).otherwise(
            F.slice(F.split(F.lit(listed), ","), F.date_diff("as_on_date", date_lit(start)) + 1, F.date_diff("__next", "as_on_date"))
        )
    return running.select(*group, F.explode(days).alias("as_on_date"), out)
