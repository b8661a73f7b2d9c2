"""Arithmetic whose missing-value rules follow floating-point frames, as SQL expressions.

A missing number is null. A division by zero gives an infinity (or null for 0/0) in
`ieee_div`, and null in `safe_div`. Neither raises under ANSI mode. All helpers take and
return expression text, so that they nest and a whole block of formulas reaches Spark in
one call; `columns` turns a block into Column objects.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

INF = "double('Infinity')"


def columns(formulas: Mapping[str, str]) -> dict[str, Column]:
    return {name: F.expr(text) for name, text in formulas.items()}


def to_num(c: str, dtype: str = "double") -> str:
    """Cast that gives null where the text is not a number."""
    return f"try_cast({c} as {dtype})"


def ieee_div(a: str, b: str) -> str:
    """a / b on doubles; x/0 is +inf or -inf by the signs of x and of the zero, 0/0 is missing."""
    sign_of_zero = f"(case when cast({b} as string) = '-0.0' then -1D else 1D end)"
    by_zero = f"case when {a} > 0 then {INF} when {a} < 0 then -{INF} end * {sign_of_zero}"
    return f"(case when {b} = 0 then {by_zero} else try_divide({a}, {b}) end)"


def safe_div(a: str, b: str) -> str:
    """a / b, missing when the divisor is zero or missing."""
    return f"try_divide({a}, {b})"


def rel_change(cur: str, prev: str) -> str:
    """(cur - prev) / prev, missing when prev is zero or missing."""
    return safe_div(f"({cur} - {prev})", prev)


def growth_rate(cur: str, prev: str, years: int) -> str:
    """Compound growth per year as a fraction; missing unless cur/prev is positive."""
    ratio = nan_to_null(ieee_div(cur, prev))
    return f"case when {ratio} > 0 then power({ratio}, {1.0 / years!r}D) - 1 end"


def nan_to_null(c: str) -> str:
    """NaN compares as the largest number in Spark; a missing value is null here."""
    return f"nullif({c}, double('NaN'))"


def inf_to_null(c: str) -> str:
    """Drop infinities (and NaN) from a double column."""
    return f"(case when abs({c}) < {INF} then {c} end)"


def zero_if_null(c: str) -> str:
    return f"coalesce({c}, 0D)"


def sum_cols(cols: Sequence[str], nulls: str = "propagate") -> str:
    """Sum of columns. 'propagate': a missing addend makes the sum missing; 'skip': it
    counts as zero."""
    if nulls not in ("propagate", "skip"):
        raise ValueError(f"nulls must be 'propagate' or 'skip', not {nulls!r}")
    terms = cols if nulls == "propagate" else [zero_if_null(c) for c in cols]
    return "(" + " + ".join(terms) + ")"
