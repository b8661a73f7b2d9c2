"""Date parsing, the April-to-March financial year, quarters and the as-on calendar."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from .text import col

# Fixed value: dates before this one are treated as not sane.
EARLIEST_SANE_DATE = dt.date(1900, 1, 1)


def date_lit(d: dt.date) -> Column:
    return F.lit(d).cast("date")


# --- parsing -----------------------------------------------------------------------------


def parse_dmy(c: Column | str) -> Column:
    """`d/M/yyyy` text with one or two digit day and month; null when it is not a date."""
    return _parse_day_first(c, "/")


def parse_iso(c: Column | str) -> Column:
    """`yyyy-MM-dd` text; null when it is not a date."""
    # the pattern leaves out a bare year or month and a trailing time, which a cast accepts
    return F.regexp_extract(col(c), r"^\d{4}-\d{1,2}-\d{1,2}$", 0).try_cast("date")


def _parse_day_first(c: Column | str, sep: str) -> Column:
    """Turn the parts round and cast: cheaper than a date pattern, above all on other texts,
    of which only the two hyphens remain. The text is named once, since filters repeat it."""
    day_first = rf"(?s)^(?:(\d{{1,2}}){sep}(\d{{1,2}}){sep}(\d{{4}})|.*)$"
    return F.regexp_replace(col(c), day_first, "$3-$2-$1").try_cast("date")


def parse_day_first(c: Column | str) -> Column:
    """`dd-MM-yyyy` text; null when it is not a date."""
    return _parse_day_first(c, "-")


def parse_dm_any_year(c: Column | str) -> Column:
    """`dd/MM/yyyy` or `dd/MM/yy` text; two-digit years 69-99 belong to the twentieth century."""
    since_1969 = F.regexp_replace(col(c), r"^(\d{2}/\d{2}/)(69|[7-9]\d)$", "$119$2")
    full = F.regexp_replace(since_1969, r"^(\d{2}/\d{2}/)(\d{2})$", "$120$2")
    return F.try_to_date(full, "dd/MM/yyyy")


def first_of_january(year: Column | str) -> Column:
    """1 January of a year; null for a missing or impossible year."""
    y = col(year).try_cast("int")
    return F.when(y.between(1, 9999), F.make_date(y, F.lit(1), F.lit(1)))


def is_sane(c: Column | str, today: dt.date) -> Column:
    """Between 1 January 1900 and today."""
    return col(c).between(date_lit(EARLIEST_SANE_DATE), date_lit(today))


# --- financial year ----------------------------------------------------------------------


def fy_start_year(d: Column | str) -> Column:
    """Calendar year in which the April-to-March year of a date starts."""
    return F.year(F.add_months(col(d), -3))


def financial_year(d: Column | str) -> Column:
    """Label such as '2019-2020' of the financial year of a date."""
    y = fy_start_year(d)
    return F.when(y.isNotNull(), F.concat_ws("-", y.cast("string"), (y + 1).cast("string")))


def year_of_label(c: Column | str) -> Column:
    """First part of 'YYYY-YYYY' as a number; null when it is not one."""
    return F.split_part(col(c), F.lit("-"), F.lit(1)).try_cast("int")


def fy_bounds(d: Column | str, n: int = 0) -> tuple[Column, Column]:
    """First and last day of the n-th financial year before the one of a date."""
    if n < 0:
        raise ValueError("n must not be negative")
    y = fy_start_year(d) - n
    return (
        F.make_date(y, F.lit(4), F.lit(1)),
        F.make_date(y + 1, F.lit(3), F.lit(31)),
    )


# --- quarter and month -------------------------------------------------------------------


def quarter_bounds(d: Column | str, n: int = 0, strict: bool = False) -> tuple[Column, Column]:
    """First and last day of the n-th calendar quarter before the one of a date.

    `strict` shifts the end day by whole months instead of taking the last day of the
    quarter, so that 30 June gives 30 March.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    first = F.trunc(col(d), "QUARTER")
    start = F.add_months(first, -3 * n)
    if strict:
        end = F.add_months(F.last_day(F.add_months(first, 2)), -3 * n)
    else:
        end = F.last_day(F.add_months(start, 2))
    return start, end


def report_period(d: Column | str, bureau: Column | str) -> tuple[Column, Column]:
    """Period covered by a default report: a quarter for 'cibil', else a month."""
    d, quarterly = col(d), col(bureau) == "cibil"
    q_start, q_end = quarter_bounds(d)
    return (
        F.when(quarterly, q_start).otherwise(F.trunc(d, "MM")),
        F.when(quarterly, q_end).otherwise(F.last_day(d)),
    )


def cap_at(c: Column | str, as_on: dt.date) -> Column:
    """End date capped at the as-on date; an open end counts as the as-on date."""
    day = date_lit(as_on)
    return F.least(F.coalesce(col(c), day), day)


# --- driver-side calendar ----------------------------------------------------------------


def first_of_april(d: dt.date) -> dt.date:
    """The first of April on or before a date: where its financial year starts."""
    same_year = dt.date(d.year, 4, 1)
    return same_year if same_year <= d else dt.date(d.year - 1, 4, 1)


def indian_financial_year(d: dt.date, n: int = 0) -> tuple[dt.date, dt.date]:
    """Same as :func:`fy_bounds` for one Python date."""
    if n < 0:
        raise ValueError("n must not be negative")
    start = first_of_april(d)
    start = start.replace(year=start.year - n)
    return start, start.replace(year=start.year + 1) - dt.timedelta(days=1)


@dataclass(frozen=True)
class AsOn:
    """The as-on date of a run with the financial years that belong to it."""

    date: dt.date
    today: dt.date = field(default_factory=dt.date.today)

    def _complete(self) -> list[tuple[dt.date, dt.date]]:
        """The four complete financial years before the as-on date, oldest first."""
        return [indian_financial_year(self.date, n) for n in (4, 3, 2, 1)]

    @property
    def first_day(self) -> dt.date:
        return self._complete()[0][0]

    @property
    def last_day(self) -> dt.date:
        return self._complete()[-1][1]

    @property
    def valid_years(self) -> list[str]:
        """Labels of the complete financial years."""
        return [f"{first.year}-{last.year}" for first, last in self._complete()]

    @property
    def financial_year(self) -> str:
        """The latest complete financial year."""
        return self.valid_years[-1]

    @property
    def is_past(self) -> bool:
        return self.date < self.today
