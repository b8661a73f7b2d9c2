"""All feature blocks side by side, one row per company of the universe."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ..operators.members import COMPANY, Universe, side_by_side
from ..sources.registry import Sources
from .audit import AuditorFeatures
from .directors import DirectorsFeatures
from .enterprise import EfFinancialFeatures
from .financial_services import FsFinancialFeatures
from .litigation import LitigationFeatures


def scorecard(sources: Sources, companies, as_on_date: dt.date, today: dt.date | None = None) -> DataFrame:
    """The widest result: one row for every company of the universe.

    Column names of the two financial blocks overlap, so theirs get an `ef_` or `fs_` prefix.
    All blocks hold at most one row per company. They are stacked and meet in one aggregation
    by company, together with the universe; what a company lacks is filled in once, at the end.
    """
    universe = Universe.of(sources.spark, companies)
    args = (sources, universe, as_on_date, today)
    directors = DirectorsFeatures(*args).found()
    blocks = [universe.ids, *AuditorFeatures(*args).found(), *directors]
    for prefix, block in (
        ("ef_", EfFinancialFeatures(*args).get_ef_financials()),
        ("fs_", FsFinancialFeatures(*args).get_fs_financials()),
    ):
        block = block.drop("financial_year", "financial_year_start")
        blocks.append(block.withColumnsRenamed({c: prefix + c for c in block.columns if c != COMPANY}))
    blocks += [counts.drop("as_on_date") for counts in LitigationFeatures(*args).found()]
    zeros = [c for block in directors for c in block.columns if c != COMPANY]
    return side_by_side(blocks, [COMPANY]).fillna(dict.fromkeys(zeros, 0))
