"""One row per key: the latest, the preferred, or any declared one.

All of them are `row_number() == 1`, which Spark prunes on the map side: each task ships
at most one row per key, so a key that holds a third of all rows shuffles one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_ROW = "__row"


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose key columns are all present (a null key drops its group)."""
    return df.dropna(subset=list(cols))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each non-null key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (
        not_null(df, keys)
        .withColumn(_ROW, F.row_number().over(w))
        .where(F.col(_ROW) == 1)
        .drop(_ROW)
    )


def ascending(cols: Sequence[str]) -> list[Column]:
    return [F.asc_nulls_last(c) for c in cols]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    ties: Sequence[str] = (),
    nulls: str = "drop",
) -> DataFrame:
    """The row with the greatest `by` of each key.

    nulls='drop': rows without `by` never win. nulls='last': they win only when the key
    has no other row. `ties` are ascending tie-break columns.
    """
    if nulls not in ("drop", "last"):
        raise ValueError(f"nulls must be 'drop' or 'last', not {nulls!r}")
    if nulls == "drop":
        df = not_null(df, [by])
    return first_per_key(df, keys, [F.desc_nulls_last(by), *ascending(ties)])


def prefer_consolidated(
    df: DataFrame,
    keys: Sequence[str],
    statement: str = "is_consolidated_standalone_stmt",
    ties: Sequence[str] = (),
) -> DataFrame:
    """One statement per key: anything but a standalone one wins over a standalone one."""
    standalone = F.when(F.col(statement) == "standalone", 1).otherwise(0)
    return first_per_key(df, keys, [standalone.asc(), *ascending([statement, *ties])])


def any_per_key(df: DataFrame, keys: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """One row per key, made repeatable by the declared tie-break columns."""
    return first_per_key(df, keys, ascending(ties))
