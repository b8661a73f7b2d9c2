"""Director resignations and director risk flags."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import AsOn, cap_at, date_lit, indian_financial_year, parse_dmy, report_period
from ..functions.numbers import to_num
from ..functions.text import contains, strip, strip_lower
from ..operators.intervals import contains_day, extract_periods, interval_join
from ..operators.key_filter import key_bits, may_be_among
from ..operators.latest import latest_per_key
from ..operators.members import COMPANY, Universe, side_by_side
from ..operators.rolling import next_event_date
from ..sources.registry import Sources

DIRECTOR = "director_master_id"

# Look-back days of the resignation counts and of the liability tail.
LOOK_BACK_DAYS, ONE_YEAR_DAYS, TWO_YEAR_DAYS, LIABILITY_DAYS = 730, 364, 729, 182

RESIGNATION_COUNTS = [
    f"n_{who}dir_resigned_in_{years}_yr" for who in ("indep_", "promoter_", "") for years in (1, 2)
]


class DirectorsFeatures:
    def __init__(self, sources: Sources, companies, as_on_date: dt.date, today: dt.date | None = None, strict: bool = False):
        """`strict` reads only the first two digits of the years in remarks."""
        self.sources = sources
        self.universe = Universe.of(sources.spark, companies)
        self.as_on = AsOn(as_on_date, today or dt.date.today())
        self.strict = strict

    # --- tenures ----------------------------------------------------------------------------

    def tenures(self, of_universe: bool = True, directors: DataFrame | None = None) -> DataFrame:
        """Director history with parsed dates and normalised designation, of the companies of
        the universe or of the directors in a bitmap."""
        history = self.sources.read(
            "director_history_details",
            [COMPANY, DIRECTOR, "designation", "appointment_original_date", "date_cessation"],
            only=self.universe.wanted if of_universe else None,
        )
        if of_universe:
            history = self.universe.restrict(history)
        if directors is not None:
            history = may_be_among(history, DIRECTOR, directors)
        return history.withColumns(
            {
                "designation": strip_lower("designation"),
                "appointment_original_date": parse_dmy("appointment_original_date"),
                "date_cessation": parse_dmy("date_cessation"),
            }
        )

    def _master(self, rows: DataFrame) -> DataFrame:
        """The master rows of the directors of some rows, and hardly any others."""
        master = self.sources.read("director_master", [DIRECTOR, "DIN"]).withColumnRenamed("DIN", "din")
        return may_be_among(master, DIRECTOR, key_bits(rows, DIRECTOR))

    def _with_din(self, df: DataFrame) -> DataFrame:
        return df.join(self._master(df), DIRECTOR).drop(DIRECTOR)

    # --- resignations -----------------------------------------------------------------------

    def categories(self) -> DataFrame:
        """The latest category of each director of a company."""
        rows = self.universe.restrict(
            self.sources.read(
                "dir12_director_dtls",
                [COMPANY, "director_din", "t_dir_category", "appt_chng_desig_date"],
                only=self.universe.wanted,
            )
        ).select(
            COMPANY,
            F.expr(to_num("director_din", "bigint")).alias("din"),
            strip_lower("t_dir_category").alias("t_dir_category"),
            "appt_chng_desig_date",
        )
        latest = latest_per_key(rows, [COMPANY, "din"], "appt_chng_desig_date", ties=["t_dir_category"])
        return latest.drop("appt_chng_desig_date")

    def _resigned(self) -> DataFrame:
        """Resignation counts of the companies that have any.

        A director counts once per company and day of leaving, so the counts are sums over
        distinct (company, day, director) rows.
        """
        day = self.as_on.date
        first_day = day - dt.timedelta(days=LOOK_BACK_DAYS)
        left = self.tenures().where(F.col("date_cessation").between(date_lit(first_day), date_lit(day)))
        rows = (
            self._with_din(left.select(COMPANY, DIRECTOR, "date_cessation"))
            .dropna()
            .distinct()
            .join(self.categories(), [COMPANY, "din"], "left")
        )
        kinds = {
            "indep_": F.col("t_dir_category") == "independent",
            "promoter_": F.col("t_dir_category") == "promoter",
            "": F.lit(True),
        }
        aggs = []
        for who, kind in kinds.items():
            for years, days in ((1, ONE_YEAR_DAYS), (2, TWO_YEAR_DAYS)):
                recent = F.col("date_cessation") >= date_lit(day - dt.timedelta(days=days))
                aggs.append(F.count_if(kind & recent).cast("int").alias(f"n_{who}dir_resigned_in_{years}_yr"))
        return rows.groupBy(COMPANY).agg(*aggs)

    def resigned_director_feat(self) -> DataFrame:
        """Directors who left in the last one and two years, by category; zeros for none."""
        return self.universe.zero_fill(self._resigned(), RESIGNATION_COUNTS)

    # --- disqualification -------------------------------------------------------------------

    def disqualifications(self, dins: DataFrame | None = None) -> DataFrame:
        """(din, from_date, to_date) periods named in the remarks on directors, on those in a
        bitmap if there is one."""
        remarks = self.sources.read("director_remarks", ["din", "remarks"])
        rows = remarks.select(strip("din").try_cast("bigint").alias("din"), "remarks").dropna()
        if dins is not None:
            rows = may_be_among(rows, "din", dins)
        return extract_periods(rows, "remarks", strict=self.strict).drop("remarks")

    def _tenure_ends(self) -> tuple[Column, Column]:
        """The two days on which a tenure is tested, null where the test does not apply:
        its end up to the as-on date, and its end within the as-on financial year."""
        left = F.col("date_cessation")
        capped = cap_at("date_cessation", self.as_on.date)
        served = F.col("appointment_original_date") < capped
        if self.as_on.date == self.as_on.today:
            served = served & left.isNull()
        start, end = (date_lit(d) for d in indian_financial_year(self.as_on.date))
        return F.when(served, capped), F.when(left.between(start, end), left)

    def _disqualified(self, ends: dict[str, Column]) -> DataFrame:
        """Flags of companies with a tenure end inside a disqualification of the director.

        All flags share one scan of the tenures and one interval join. Master and remarks are
        read for the directors of these tenures alone.
        """
        tests = F.array_compact(
            F.array(*[F.when(day.isNotNull(), F.struct(F.lit(n).alias("flag"), day.alias("day"))) for n, day in ends.items()])
        )
        points = self.tenures().select(COMPANY, DIRECTOR, F.inline(tests)).distinct()
        master = self._master(points)
        hits = interval_join(
            points.join(master, DIRECTOR).drop(DIRECTOR),
            self.disqualifications(key_bits(master, "din")),
            ["din"], "day", "from_date", "to_date", how="left_semi",
        )
        return self._flags(hits, {n: F.col("flag") == n for n in ends})

    def _flags(self, hits: DataFrame, conditions: dict[str, Column]) -> DataFrame:
        """One 0/1 column per condition, of companies with a hit: does any hit meet it?"""
        met = [F.max(F.when(c, 1).otherwise(0)).cast("byte").alias(n) for n, c in conditions.items()]
        return hits.groupBy(COMPANY).agg(*met)

    def _filled(self, found: DataFrame) -> DataFrame:
        return self.universe.zero_fill(found, [c for c in found.columns if c != COMPANY])

    def disq_dir_active(self) -> DataFrame:
        """1 if a director was disqualified at the end of a tenure, an open one ending on
        the as-on date. With the as-on date today only open tenures are looked at."""
        return self._filled(self._disqualified({"disqualified_director_active": self._tenure_ends()[0]}))

    def disq_dir_resigned(self) -> DataFrame:
        """1 if a director left in the financial year of the as-on date while disqualified."""
        return self._filled(self._disqualified({"disqualified_director_resigned": self._tenure_ends()[1]}))

    def _both_disqualified(self) -> DataFrame:
        active, resigned = self._tenure_ends()
        return self._disqualified(
            {"disqualified_director_active": active, "disqualified_director_resigned": resigned}
        )

    def disqualified_directors(self) -> DataFrame:
        """Both disqualification flags from one pass."""
        return self._filled(self._both_disqualified())

    # --- other companies of the directors ---------------------------------------------------

    def _liable(self, tenures: DataFrame) -> DataFrame:
        """Non-nominee tenures that still answer for the company on the as-on date."""
        day, left = date_lit(self.as_on.date), F.col("date_cessation")
        liable = left.isNull() | (F.date_add(left, LIABILITY_DAYS) > day)
        return tenures.where(~contains("designation", "nominee") & liable).dropna(subset=[COMPANY, DIRECTOR])

    def _in_office(self) -> Column:
        return F.col("date_cessation").isNull() | (F.col("date_cessation") > date_lit(self.as_on.date))

    def liable_directors(self, directors: DataFrame | None = None) -> DataFrame:
        """Non-nominee (company, director) pairs that still answer for the company on the
        as-on date: in office, or left less than the liability tail ago. `in_office` tells
        which. All companies, since the other boards of a director matter; of the directors
        in a bitmap, if there is one."""
        return (
            self._liable(self.tenures(of_universe=False, directors=directors))
            .groupBy(COMPANY, DIRECTOR)
            .agg(F.max(self._in_office()).alias("in_office"))
        )

    def _on_other_board(self, bad: dict) -> DataFrame:
        """Flags of companies with a director who also answers for a bad other company.

        `bad` gives for each flag the bad companies among those in a bitmap. Each read depends
        on the one before: the directors in office in the universe decide which tenures are
        read, and the companies of these which ratings and defaults.

        A director's bad companies are reduced to the smallest and the greatest id: there
        is one other than the company at hand unless both are that company. So no pairs of
        companies are formed, however many boards a director sits on.
        """
        directors = key_bits(self._liable(self.tenures()).where(self._in_office()), DIRECTOR)
        liable = self.liable_directors(directors)
        # asks for every column of the pairs, so that their exchange serves here as well
        boards = key_bits(liable.where("in_office is not null"), COMPANY)
        marked = side_by_side([of(boards).select(COMPANY, F.lit(1).alias(n)) for n, of in bad.items()], [COMPANY])
        ends = []
        for n in bad:
            company = F.when(F.col(n) == 1, F.col(COMPANY))
            ends += [F.min(company).alias(f"first_{n}"), F.max(company).alias(f"last_{n}")]
        span = liable.join(marked, COMPANY).groupBy(DIRECTOR).agg(*ends)
        other = {
            n: (F.col(f"first_{n}") != F.col(COMPANY)) | (F.col(f"last_{n}") != F.col(COMPANY)) for n in bad
        }
        current = self.universe.restrict(liable.where("in_office"))
        return self._flags(current.join(span, DIRECTOR), other)

    def rating_periods(self, companies: DataFrame | None = None) -> DataFrame:
        """Periods in which a company had the worst rating, up to the agency's next rating; of
        the companies in a bitmap, if there is one."""
        ratings = self.sources.read(
            "credit_rating_data",
            [COMPANY, "credit_rating_agency", "derived_long_term_rating", "d_date_of_last_rating"],
        )
        if companies is not None:
            ratings = may_be_among(ratings, COMPANY, companies)
        rows = ratings.select(
            COMPANY,
            strip("credit_rating_agency").alias("credit_rating_agency"),
            strip_lower("derived_long_term_rating").alias("d_rating"),
            F.col("d_date_of_last_rating").alias("rt_from_date"),
        ).dropna(subset=[COMPANY, "rt_from_date"])
        dated = next_event_date(
            rows.distinct(),
            [COMPANY, "credit_rating_agency"],
            "rt_from_date",
            "rt_to_date",
            date_lit(self.as_on.today),
            ties=["d_rating"],
        )
        return dated.where((F.col("d_rating") == "d") & (F.col("rt_from_date") <= F.col("rt_to_date")))

    def is_dir_in_d_rated_company(self) -> DataFrame:
        """1 if a director in office answers for another company that is D-rated as on the
        date. A liable tenure ends on that date, so only periods around it can match."""
        return self._filled(self._on_other_board({"director_in_d_rated_comp": self.d_rated_companies}))

    def d_rated_companies(self, companies: DataFrame | None = None) -> DataFrame:
        return self.rating_periods(companies).where(contains_day(self.as_on.date, "rt_from_date", "rt_to_date"))

    def default_periods(self, companies: DataFrame | None = None) -> DataFrame:
        """Reported defaults whose quarter or month contains the as-on date; of the companies
        in a bitmap, if there is one."""
        reports = self.sources.read("cibil_defaulter_data", [COMPANY, "credit_bureau", "d_quarter"])
        if companies is not None:
            reports = may_be_among(reports, COMPANY, companies)
        rows = reports.select(COMPANY, strip_lower("credit_bureau").alias("credit_bureau"), "d_quarter").dropna()
        start, end = report_period("d_quarter", "credit_bureau")
        return (
            rows.withColumns({"default_from_date": start, "default_to_date": end})
            .drop("d_quarter")
            .where(contains_day(self.as_on.date, "default_from_date", "default_to_date"))
            .distinct()
        )

    def is_dir_in_cibil_defaulted_company(self) -> DataFrame:
        """1 if a director in office answers for another company in default on the date."""
        return self._filled(self._on_other_board({"director_in_defaulted_comp": self.default_periods}))

    def _both_on_bad_boards(self) -> DataFrame:
        return self._on_other_board(
            {"director_in_d_rated_comp": self.d_rated_companies, "director_in_defaulted_comp": self.default_periods}
        )

    def directors_on_bad_boards(self) -> DataFrame:
        """Both two-hop flags from one pass over the tenures."""
        return self._filled(self._both_on_bad_boards())

    def found(self) -> list[DataFrame]:
        """The features block by block, of companies that have any; all others are zero."""
        return [self._resigned(), self._both_disqualified(), self._both_on_bad_boards()]

    def get_director_features(self) -> DataFrame:
        """All ten director features, one row per company."""
        return self._filled(side_by_side([self.universe.ids, *self.found()], [COMPANY]))
