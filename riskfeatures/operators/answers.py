"""Scores of audit-report answers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The answers that decide a score, and the score of each outcome.
ADVERSE_ANSWERS = ("unfavourable", "disclaimer")
GOOD_ANSWER = "favourable"
ADVERSE_SCORE, GOOD_SCORE, NEUTRAL_SCORE = 0.0, 1.0, 0.5

_ADVERSE, _GOOD = 2, 1


def answer_level(answer: str) -> Column:
    """2 for an adverse answer, 1 for a good one, null for any other (not trimmed)."""
    text = F.lower(F.col(answer))
    return F.when(text.isin(*ADVERSE_ANSWERS), _ADVERSE).when(text == GOOD_ANSWER, _GOOD)


def score_of_level(level: Column) -> Column:
    return (
        F.when(level == _ADVERSE, ADVERSE_SCORE)
        .when(level == _GOOD, GOOD_SCORE)
        .otherwise(NEUTRAL_SCORE)
    )


def answer_scores(df: DataFrame, keys: Sequence[str], answers: Mapping[str, str]) -> DataFrame:
    """One score per key and answer column: 0 if any answer is adverse, else 1 if any is
    good, else 0.5. `answers` maps score names to answer columns."""
    levels = [F.max(answer_level(a)).alias(s) for s, a in answers.items()]
    best = df.dropna(subset=list(keys)).groupBy(*keys).agg(*levels)
    return best.select(*keys, *[score_of_level(F.col(s)).alias(s) for s in answers])


def answer_scores_by_year(
    df: DataFrame, company: str, year: str, years: Sequence[str], answers: Mapping[str, str]
) -> DataFrame:
    """`{score}_{n}yrs` per company: mean score of the last n of the given years.

    One aggregation by company holds all years side by side. A year without rows scores
    0.5, so this equals completing the years, scoring each and rolling over n rows.
    """
    # levels and the year's position are projected first, so each is computed once per row
    nth = F.lit(None).cast("int")
    for i, label in enumerate(years):
        nth = F.when(F.col(year) == label, i).otherwise(nth)
    leveled = df.dropna(subset=[company]).select(
        company, nth.alias("__nth"), *[answer_level(a).alias(s) for s, a in answers.items()]
    )
    wide = leveled.groupBy(company).agg(
        *[
            F.max(F.when(F.col("__nth") == i, F.col(s))).alias(f"{s}_{i}")
            for s in answers
            for i in range(len(years))
        ]
    )
    scored = wide.select(
        company, *[score_of_level(F.col(c)).alias(c) for c in wide.columns if c != company]
    )
    means = []
    for s in answers:
        total = F.lit(0.0)
        for n, i in enumerate(reversed(range(len(years))), start=1):
            total = total + F.col(f"{s}_{i}")
            means.append((total / n).alias(f"{s}_{n}yrs"))
    return scored.select(company, *means)
