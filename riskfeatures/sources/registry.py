"""Named sources: where each table is read from, and typed, pruned, filtered reads."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.numbers import nan_to_null, to_num
from .schemas import CONNECTION_OF, CONNECTIONS, TABLES


IDS_PER_QUERY = 1000  # ids that one query of a database names


def key_predicates(column: str, ids: Iterable[int], size: int = IDS_PER_QUERY) -> list[str]:
    """Conditions that admit each id exactly once; a database answers each with a query of its own."""
    listed = sorted({int(i) for i in ids})
    chunks = [listed[i : i + size] for i in range(0, len(listed), size)]
    return [f"{column} IN ({', '.join(map(str, chunk))})" for chunk in chunks] or ["1 = 0"]


class Sources:
    """Resolves table names to DataFrames.

    A connection is a directory of files (one entry per table) or a JDBC database. Single
    tables can also be given as DataFrames, which then win over their connection.
    """

    def __init__(self, spark: SparkSession, frames: Mapping[str, DataFrame] | None = None):
        self.spark = spark
        self._frames = dict(frames or {})
        self._readers: dict[str, object] = {}

    # --- registration ---------------------------------------------------------------------

    def add_files(self, connection: str, directory: str, fmt: str = "parquet", suffix: str = "", **options) -> "Sources":
        """Tables as `{directory}/{table}{suffix}` in any format Spark reads."""

        def read(table: str, only: Mapping[str, Sequence[int]]) -> DataFrame:
            reader = self.spark.read.format(fmt).options(**options)
            # text files carry no types: their values are read as text and cast afterwards
            if fmt == "json" or (fmt == "csv" and "header" not in options):
                reader = reader.schema(", ".join(f"{c} string" for c in TABLES[table]))
            return reader.load(f"{directory.rstrip('/')}/{table}{suffix}")

        return self._add(connection, read)

    def add_jdbc(
        self,
        connection: str,
        url: str,
        user: str | None = None,
        password: str | None = None,
        driver: str | None = None,
        schema: str | None = None,
        partition: Mapping[str, Mapping[str, object] | None] | None = None,
        fetchsize: int = 10_000,
    ) -> "Sources":
        """Tables of a database. `partition` has for each table that is read its
        partitionColumn, lowerBound, upperBound and numPartitions, so that executors read
        slices in parallel, or None for a table to be read by one task. A read that names the
        ids it wants is sliced by them instead, so that only their rows leave the database."""
        slices = dict(partition or {})

        def read(table: str, only: Mapping[str, Sequence[int]]) -> DataFrame:
            for column, ids in only.items():
                options = self.jdbc_options(table, url, user, password, driver, schema, None, fetchsize)
                place, name = options.pop("url"), options.pop("dbtable")
                properties = {k: str(v) for k, v in options.items()}
                return self.spark.read.jdbc(place, name, predicates=key_predicates(column, ids), properties=properties)
            if table not in slices:
                raise ValueError(f"partition says nothing about {table!r}; give None to read it in one task")
            return self.spark.read.format("jdbc").options(
                **self.jdbc_options(table, url, user, password, driver, schema, slices[table], fetchsize)
            ).load()

        return self._add(connection, read)

    @staticmethod
    def jdbc_options(table, url, user=None, password=None, driver=None, schema=None, partition=None, fetchsize=10_000) -> dict:
        needed = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"}
        if partition and set(partition) != needed:
            raise ValueError(f"partition must hold exactly {sorted(needed)}")
        if partition and table in TABLES and partition["partitionColumn"] not in TABLES[table]:
            raise ValueError(f"table {table!r} has no column {partition['partitionColumn']!r}")
        options = {
            "url": url,
            "dbtable": f"{schema}.{table}" if schema else table,
            "fetchsize": fetchsize,
            "user": user,
            "password": password,
            "driver": driver,
            **(partition or {}),
        }
        return {k: v for k, v in options.items() if v is not None}

    def _add(self, connection, read) -> "Sources":
        if connection not in CONNECTIONS:
            raise ValueError(f"unknown connection {connection!r}, expected one of {CONNECTIONS}")
        self._readers[connection] = read
        return self

    # --- reading --------------------------------------------------------------------------

    def raw(self, table: str, only: Mapping[str, Sequence[int]] | None = None) -> DataFrame:
        """A table as it is. only: the ids wanted of one column; a database leaves out others,
        files and frames need not."""
        if only and (len(only) > 1 or not set(only) <= set(TABLES.get(table, only))):
            raise ValueError(f"ids can be named for one column of {table!r}, not for {sorted(only)}")
        if table in self._frames:
            return self._frames[table]
        connection = CONNECTION_OF.get(table)
        if connection is None:
            raise ValueError(f"unknown table {table!r}")
        if connection not in self._readers:
            raise ValueError(f"table {table!r} needs connection {connection!r}, which is not registered")
        return self._readers[connection](table, only or {})

    def read(
        self,
        table: str,
        columns: Sequence[str] | None = None,
        filters: Mapping[str, Iterable] | None = None,
        keys: DataFrame | None = None,
        limit: int | None = None,
        strict: bool = False,
        observation: Observation | None = None,
        only: Mapping[str, Sequence[int]] | None = None,
    ) -> DataFrame:
        """Columns of a table in their declared types.

        filters: column -> admitted values, all of which must hold; they reach the scan.
        keys: a DataFrame of key columns; only rows whose key occurs in it remain.
        strict: a value that its declared type cannot hold fails the job instead of being null.
        observation: counts, in the pass that reads the rows, the values lost in each column.
        only: ids wanted of one column, so that a database sends no others; the caller still
        restricts the rows, since other sources may.
        """
        df = self.raw(table, only)
        if table in TABLES:
            if observation is not None:
                lost = lost_values(df, TABLES[table], columns)
                df = df.observe(observation, *(lost or [F.lit(0).alias("none")]))
            df = typed(df, TABLES[table], columns, strict)
        if columns is not None:
            df = df.select(*columns)
        return narrow(df, filters, keys, limit)


def _casts(df: DataFrame, schema: Mapping[str, str], columns: Sequence[str] | None) -> dict[str, str | None]:
    """For each column wanted the expression that casts it, or None where its type is declared."""
    have = dict(df.dtypes)
    out: dict[str, str | None] = {}
    for name in columns if columns is not None else [c for c in schema if c in have]:
        if name not in schema:
            raise ValueError(f"unknown column {name!r}")
        if name not in have:
            raise ValueError(f"the source lacks column {name!r}")
        out[name] = None if have[name] == schema[name] else to_num(name, schema[name])
    return out


def typed(df: DataFrame, schema: Mapping[str, str], columns: Sequence[str] | None = None, strict: bool = False) -> DataFrame:
    """Cast to the declared types; what cannot be cast becomes null, or fails the job if
    `strict`. NaN becomes null in any case."""
    out = []
    for name, cast in _casts(df, schema, columns).items():
        c = cast or name
        if cast and strict:
            told = f"raise_error(concat('{name}: not a {schema[name]}: ', cast({name} as string)))"
            c = f"case when {name} is not null and {cast} is null then cast({told} as {schema[name]}) else {cast} end"
        out.append(f"{nan_to_null(c)} as {name}" if schema[name] == "double" else f"{c} as {name}")
    return df.selectExpr(*out)


def lost_values(df: DataFrame, schema: Mapping[str, str], columns: Sequence[str] | None = None) -> list[Column]:
    """How many values of each column that needs a cast are lost by it, as aggregates."""
    return [
        F.expr(f"count_if({name} is not null and {cast} is null)").alias(name)
        for name, cast in _casts(df, schema, columns).items()
        if cast
    ]


def cast_losses(df: DataFrame, schema: Mapping[str, str], columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, lost, total) of the columns that need a cast, in one aggregation."""
    lost = lost_values(df, schema, columns)
    names = [name for name, cast in _casts(df, schema, columns).items() if cast]
    counted = df.agg(*lost, F.count(F.lit(1)).alias("__total"))
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("lost")) for n in names])
    if not names:
        pairs = F.array().cast("array<struct<column_name: string, lost: bigint>>")
    return counted.select(F.inline(pairs), F.col("__total").alias("total"))


def narrow(
    df: DataFrame,
    filters: Mapping[str, Iterable] | None = None,
    keys: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Key filters, semi join with a key frame, and row limit of a scan."""
    for column, values in (filters or {}).items():
        if column not in df.columns:
            raise ValueError(f"filter on unknown column {column!r}")
        df = df.where(F.col(column).isin(list(values)))
    if keys is not None:
        df = df.join(keys, keys.columns, "left_semi")
    return df if limit is None else df.limit(limit)
