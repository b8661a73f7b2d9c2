"""Registration of queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .views import expand

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None):
    """Register a function as a query under its name; `sql` must give the same rows."""

    def register(fn):
        name = fn.__name__
        QUERIES[name] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = expand(sql)
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Dates as text, whole numbers as bigint and fractions as double, as the SQL gives them."""
    out = []
    for name, dtype in df.dtypes:
        c = F.col(f"`{name}`")
        if dtype == "date" or dtype.startswith("timestamp"):
            c = c.cast("date").cast("string")
        elif dtype == "boolean":
            c = c.cast("int").cast("bigint")
        elif dtype in ("tinyint", "smallint", "int"):
            c = c.cast("bigint")
        elif dtype == "float" or dtype.startswith("decimal"):
            c = c.cast("double")
        out.append(c.alias(name))
    return df.select(*out)
