"""Court cases of companies: how many there were, and how many are open.

With an as-on date before today the counts are those of that date, and a case without a
disposal counts as disposed today. Otherwise they are the current ones, and such a case is
open.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import (
    EARLIEST_SANE_DATE,
    AsOn,
    date_lit,
    first_of_january,
    is_sane,
    parse_day_first,
    parse_iso,
)
from ..functions.text import strip_lower
from ..operators.cases import DISPOSED, FILED, dedup_cases, open_as_of, open_daily, open_now, worked_out
from ..operators.members import COMPANY, Universe, side_by_side
from ..sources.registry import Sources

CASE = "case_number"

# Statuses, section and act texts that select or close cases, and the first
# day of the daily series.
BIFR_DISPOSED_STATUSES = (
    "Abated",
    "Dismissed as Non Maintainable",
    "Dropped (N/W Positive)",
    "Winding up Reccomended /Confirmed",
    "Winding up Notice",
)
NCLT_SECTION = "ibc under sec 7"
NCLT_STATUSES = ("disposed off", "disposed", "pending")
COURT_STATUSES = ("pending", "case pending", "disposed")
CHEQUE_BOUNCE_ACT = "%negotiable instruments act%"
SERIES_START = dt.date(2017, 1, 1)


class LitigationFeatures:
    def __init__(
        self,
        sources: Sources,
        companies,
        as_on_date: dt.date,
        today: dt.date | None = None,
        series_start: dt.date = SERIES_START,
    ):
        self.sources = sources
        self.universe = Universe.of(sources.spark, companies)
        self.as_on = AsOn(as_on_date, today or dt.date.today())
        self.series_start = series_start

    # --- shared rules -----------------------------------------------------------------------

    @property
    def _report_date(self) -> dt.date:
        return self.as_on.date if self.as_on.is_past else self.as_on.today

    def _or_today(self, disposed: Column) -> Column:
        """Disposal date; in the past view an undisposed case counts as disposed today."""
        return F.coalesce(disposed, date_lit(self.as_on.today)) if self.as_on.is_past else disposed

    def _sane(self, df: DataFrame, ordered: Column | None, now_ordered: Column | None) -> DataFrame:
        """Rows with sane dates. `ordered` is the order rule of the past view; `now_ordered`
        that of the current view, in which a case without a disposal is always valid."""
        df = worked_out(df)  # the tests name the dates many times, the texts are parsed once
        sane = is_sane(FILED, self.as_on.today) & is_sane(DISPOSED, self.as_on.today)
        if self.as_on.is_past:
            return df.where(sane & ordered)
        return df.where(F.col(DISPOSED).isNull() | (sane & now_ordered))

    def _report(self, open_cases: DataFrame, features: list[str]) -> DataFrame:
        counts = [F.col(f).cast("int").alias(f) for f in features]
        return open_cases.select(COMPANY, date_lit(self._report_date).alias("as_on_date"), *counts)

    def _count(self, cases: DataFrame, features: Mapping[str, Column | None]) -> DataFrame:
        if self.as_on.is_past:
            counted = open_as_of(cases, [COMPANY], self.as_on.date, features)
        else:
            counted = open_now(cases, [COMPANY], features)
        return self._report(counted, list(features))

    def _read(self, table: str, *columns: str) -> DataFrame:
        return self.universe.restrict(self.sources.read(table, [COMPANY, *columns], only=self.universe.wanted)).dropna(subset=[COMPANY])

    # --- cases by court ---------------------------------------------------------------------

    def bifr_case_records(self) -> DataFrame:
        rows = self._read("yml_bifr_litigation_data", "case_year", "status", "d_date_of_last_order", CASE)
        closed = F.coalesce(F.col("status").isin(*BIFR_DISPOSED_STATUSES), F.lit(False))
        still_open = date_lit(self.as_on.today) if self.as_on.is_past else F.lit(None).cast("date")
        dated = rows.select(
            COMPANY,
            CASE,
            first_of_january("case_year").alias(FILED),
            F.when(closed, F.col("d_date_of_last_order")).otherwise(still_open).alias(DISPOSED),
        )
        before_today = F.col(DISPOSED) < date_lit(self.as_on.today)
        valid = self._sane(dated, F.col(FILED) <= F.col(DISPOSED), before_today)
        return dedup_cases(valid.dropna(subset=[CASE]), [COMPANY, CASE])

    def nclt_case_records(self) -> DataFrame:
        rows = self._read("yml_nclt_litigation_data", "cpno", "case_status", "sections", "d_order_date", "disposed_date")
        dated = rows.where(
            (F.lower("sections") == NCLT_SECTION) & strip_lower("case_status").isin(*NCLT_STATUSES)
        ).select(
            COMPANY,
            F.col("cpno").alias(CASE),
            F.col("d_order_date").alias(FILED),
            self._or_today(parse_day_first("disposed_date")).alias(DISPOSED),
        )
        valid = self._sane(dated, F.col(FILED) <= F.col(DISPOSED), F.col(FILED) < F.col(DISPOSED))
        return dedup_cases(valid, [COMPANY, CASE])

    def court_case_records(self) -> DataFrame:
        """High and district court cases with what makes them criminal or a bounced cheque."""
        high = self._read(
            "yml_high_court_litigation_data", "case_no", "case_year", "case_status", "crawl_dispose_date", "act", "is_criminal"
        ).withColumnsRenamed({"case_no": CASE, "crawl_dispose_date": "d_decision_date"})
        district = self._read(
            "yml_district_court_litigation_data", CASE, "case_year", "case_status", "d_decision_date", "act", "is_criminal"
        )
        both = high.withColumn("court", F.lit("high")).unionByName(district.withColumn("court", F.lit("district")))
        dated = both.where(strip_lower("case_status").isin(*COURT_STATUSES)).select(
            "court",
            COMPANY,
            CASE,
            first_of_january("case_year").alias(FILED),
            self._or_today(parse_iso("d_decision_date")).alias(DISPOSED),
            F.col("is_criminal").try_cast("int").alias("is_criminal"),
            strip_lower("act").like(CHEQUE_BOUNCE_ACT).alias("is_cheque"),
        )
        in_order = F.col(FILED) <= F.col(DISPOSED)
        valid = self._sane(dated, in_order, in_order)
        return dedup_cases(valid, ["court", COMPANY, CASE], flags=["is_criminal", "is_cheque"])

    # --- features ---------------------------------------------------------------------------

    def sat_cases(self) -> DataFrame:
        """Distinct case links per company up to the as-on date."""
        rows = self._read("yml_sat_litigation_data", "d_date", "link").where(
            F.col("d_date") > date_lit(EARLIEST_SANE_DATE)
        )
        if self.as_on.is_past:
            rows = rows.where(F.col("d_date") <= date_lit(self.as_on.date))
        counted = rows.groupBy(COMPANY).agg(F.count_distinct("link").alias("number_of_past_sat_cases"))
        return self._report(counted, ["number_of_past_sat_cases"])

    def bifr_cases(self) -> DataFrame:
        return self._count(self.bifr_case_records(), {"number_of_bifr_cases": None})

    def nclt_cases(self) -> DataFrame:
        return self._count(self.nclt_case_records(), {"number_of_nclt_cases": None})

    def court_cases(self) -> DataFrame:
        """Criminal and cheque-bounce counts from one pass over both courts."""
        return self._count(
            self.court_case_records(),
            {"no_of_criminal_cases": F.col("is_criminal") == 1, "no_of_check_bounce_cases": F.col("is_cheque")},
        )

    def get_criminal_case(self) -> DataFrame:
        records = self.court_case_records().where(F.col("is_criminal") == 1)
        return self._count(records, {"no_of_criminal_cases": None})

    def get_check_bounce_cases(self) -> DataFrame:
        return self._count(self.court_case_records().where("is_cheque"), {"no_of_check_bounce_cases": None})

    def daily_series(self, records: DataFrame, name: str, text: bool = False) -> DataFrame:
        """Open cases on every day from the series start to today."""
        return open_daily(records, [COMPANY], self.series_start, self.as_on.today, name, text)

    def found(self) -> list[DataFrame]:
        """The counts kind by kind, of companies with cases of the kind."""
        return [self.bifr_cases(), self.sat_cases(), self.nclt_cases(), self.court_cases()]

    def get_litigation_features(self) -> DataFrame:
        """All five counts; a company without cases of a kind has no value for it."""
        found = side_by_side(self.found(), [COMPANY, "as_on_date"])
        counts = [c for c in found.columns if c not in (COMPANY, "as_on_date")]
        any_value = F.coalesce(*counts).isNotNull()
        return found.where(any_value).join(self.universe.ids, COMPANY, "left_semi")
