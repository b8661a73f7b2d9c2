"""Lists held in a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import strip


def explode_ids(df: DataFrame, ids: str, out: str, strict: bool = False) -> DataFrame:
    """One row per id of a comma list; quotes go away, empty parts are dropped.

    Blanks around an id are removed too, unless `strict`.
    """
    parts = F.split(F.replace(F.replace(F.col(ids), F.lit("'")), F.lit('"')), ",")
    one = df.withColumn(out, F.explode(parts))
    if not strict:
        one = one.withColumn(out, strip(out))
    return (one if ids == out else one.drop(ids)).where(F.col(out) != "")
