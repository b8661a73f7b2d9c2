"""The company universe: membership flags, zero fill, company x year spine, row limits."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

COMPANY = "company_master_id"


class Universe:
    """The companies to report on.

    However it is given, every read keeps the universe's companies alone: by a semi join,
    whose small side Spark broadcasts by its own size check, and for a list of ids also by
    bounds or values that reach the scan.
    """

    def __init__(self, ids: DataFrame, literal_ids: Sequence[int] | None = None):
        self.ids = ids
        self.literal_ids = literal_ids

    @classmethod
    def of(cls, spark: SparkSession, companies: "Universe | DataFrame | Iterable[int]") -> "Universe":
        if isinstance(companies, Universe):
            return companies
        if isinstance(companies, DataFrame):
            name = COMPANY if COMPANY in companies.columns else companies.columns[0]
            if name != COMPANY and len(companies.columns) > 1:
                raise ValueError(f"companies need a column {COMPANY!r} or a single column, not {companies.columns}")
            return cls(companies.select(F.col(name).cast("bigint").alias(COMPANY)).dropna().distinct())
        listed = sorted({int(c) for c in companies})
        ids = spark.createDataFrame([(c,) for c in listed], f"{COMPANY} bigint")
        return cls(ids, literal_ids=listed)

    @property
    def wanted(self) -> dict[str, Sequence[int]]:
        """The ids, where they are known beforehand, for sources that can leave out others."""
        return {} if self.literal_ids is None else {COMPANY: self.literal_ids}

    def restrict(self, df: DataFrame) -> DataFrame:
        """Rows of the universe's companies."""
        if self.literal_ids:
            # how the ids reach the scan depends on their number, which rows remain does not
            df = df.where(F.col(COMPANY).between(self.literal_ids[0], self.literal_ids[-1]))
            if len(self.literal_ids) <= 1000:
                return df.where(F.col(COMPANY).isin(self.literal_ids))
        return df.join(self.ids, COMPANY, "left_semi")

    def flag(self, members: DataFrame, name: str) -> DataFrame:
        """The universe with a 0/1 column: is the company among the members?"""
        return membership_flag(self.ids, members, COMPANY, name)

    def zero_fill(self, df: DataFrame, zeros: Sequence[str]) -> DataFrame:
        """The universe with the rows of df; companies without one get zeros."""
        return self.ids.join(df, COMPANY, "left").fillna({c: 0 for c in zeros})


def membership_flag(base: DataFrame, members: DataFrame, key: str, name: str) -> DataFrame:
    """base with a byte column: 1 if the key occurs among the members, else 0."""
    present = members.select(key).distinct().withColumn(name, F.lit(1))
    return base.join(present, key, "left").withColumn(
        name, F.coalesce(F.col(name), F.lit(0)).cast("byte")
    )


def company_years(companies: DataFrame, years: Sequence[str], company: str = COMPANY) -> DataFrame:
    """Every company with every year: a spine of one row each."""
    labels = F.array(*[F.lit(y) for y in years])
    return companies.select(company, F.explode(labels).alias("financial_year"))


def complete_with(
    df: DataFrame, spine: DataFrame, keys: Sequence[str], present: DataFrame | None = None
) -> DataFrame:
    """df plus one row, empty but for the keys, for each spine row that it lacks.

    Only distinct keys meet the spine, so a key with many rows costs one. `present` is a
    cheaper frame with the same keys as df, if there is one.
    """
    have = (df if present is None else present).select(*keys).distinct()
    missing = spine.join(have, list(keys), "left_anti")
    return df.unionByName(missing, allowMissingColumns=True)


def side_by_side(blocks: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer combination of blocks that hold one row per key, in one aggregation."""
    stacked = blocks[0]
    for b in blocks[1:]:
        stacked = stacked.unionByName(b, allowMissingColumns=True)
    features = [c for c in stacked.columns if c not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in features])


def conditional_distinct(
    df: DataFrame, group: Sequence[str], item: str, conditions: Mapping[str, object]
) -> DataFrame:
    """Distinct non-null items per group for each condition, one named count for each.

    Items are made unique first, so the counts are sums that combine on the map side and
    a large group is spread by item.
    """
    hits = {n: F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in conditions.items()}
    per_item = df.dropna(subset=[*group, item]).groupBy(*group, item).agg(*hits.values())
    return per_item.groupBy(*group).agg(*[F.sum(n).alias(n) for n in conditions])
