"""Audit-quality scores over the last one to four financial years."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.dates import AsOn, date_lit, financial_year, parse_iso
from ..functions.text import is_one_of_years, strip, strip_lower, strip_upper
from ..operators.answers import NEUTRAL_SCORE, answer_scores_by_year
from ..operators.latest import any_per_key, first_per_key, latest_per_key
from ..operators.lists import explode_ids
from ..operators.members import COMPANY, Universe, company_years, side_by_side
from ..operators.rolling import rolling_rows
from ..operators.slices import SLICE_ROWS
from ..sources.registry import Sources

FY, STMT = "financial_year", "is_consolidated_standalone_stmt"
STATEMENT = [COMPANY, FY, STMT]

# Answer columns behind each score, and flag columns behind each score.
ANSWER_SCORES = {
    "fixed_assets_score": "t_fixed_assets",
    "fraud_score": "t_fraud_noticed",
    "statutory_due_score": "t_statutory_dues",
    "financial_due_score": "t_accept_public_deposits",
    "term_loans_score": "t_term_loans",
    "inventories_score": "t_inventories",
}
FLAG_SCORES = {
    "adv_qual_score": "adv_qualified",
    "auditor_resigned_score": "has_auditor_resigned",
    "adv_qual_and_resigned_score": "adverse_qualf_and_resigned",
}
WINDOWS = (1, 2, 3, 4)

_NEUTRAL, _NTH = "__neutral", "__nth"


class AuditorFeatures:
    def __init__(self, sources: Sources, companies, as_on_date: dt.date, today: dt.date | None = None, strict: bool = False, slice_rows: int = SLICE_ROWS):
        """`strict` keeps the blanks around ids in auditor lists. Windows over the auditor
        rows of a company run in slices of about `slice_rows` rows."""
        self.slice_rows = slice_rows
        self.sources = sources
        self.universe = Universe.of(sources.spark, companies)
        self.as_on = AsOn(as_on_date, today or dt.date.today())
        self.strict = strict

    def _scan(self, table: str, *columns: str) -> DataFrame:
        """Cleaned statement rows of the valid years."""
        df = self.universe.restrict(self.sources.read(table, columns, only=self.universe.wanted))
        df = df.where(is_one_of_years(FY, self.as_on.valid_years)).withColumn(FY, strip(FY))
        return df.withColumn(STMT, strip_lower(STMT)) if STMT in columns else df

    def form_headers(self) -> DataFrame:
        """The latest valid form per company, year and statement."""
        forms = (
            self._scan("form_aoc4_dtls", *STATEMENT, "valid_data", "inserted_at", "wthr_fin_statement_qualify")
            .where(F.col("valid_data") == 1)
            .select(*STATEMENT, "inserted_at", strip_lower("wthr_fin_statement_qualify").alias("wthr_qualified"))
        )
        return latest_per_key(forms, STATEMENT, "inserted_at", ties=["wthr_qualified"]).drop("inserted_at")

    def _form_auditors(self) -> DataFrame:
        rows = self._scan("aoc4_auditor_dtls", *STATEMENT, "pan_no", "t_category")
        return rows.withColumns({"pan_no": strip_upper("pan_no"), "t_category": strip_lower("t_category")})

    def _xbrl_auditors(self) -> DataFrame:
        rows = self._scan("aoc4xbrl_auditor_dtls", *STATEMENT, "aud_firm_pan", "category", "wthr_qualified")
        return rows.select(
            *STATEMENT,
            strip_upper("aud_firm_pan").alias("pan_no"),
            strip_lower("category").alias("t_category"),
            strip_lower("wthr_qualified").alias("wthr_qualified"),
        )

    def auditor_rows(self) -> DataFrame:
        """Auditor rows of both sources; `source` tells which one they come from."""
        cols = [*STATEMENT, "pan_no", "t_category", "wthr_qualified"]
        form = self._form_auditors().distinct().join(self.form_headers(), STATEMENT, "left")
        xbrl = self._xbrl_auditors().distinct()
        return form.select(*cols, F.lit(0).alias("source")).unionByName(xbrl.select(*cols, F.lit(1).alias("source")))

    def resignations(self) -> DataFrame:
        """One row per company, auditor and financial year of the resignation date."""
        first, last = self.as_on.first_day, self.as_on.last_day
        rows = (
            self._scan("adt3_general_resignation_dtls", COMPANY, FY, "auditor_pan", "auditor_firm", "auditor_resignation_date")
            .select(
                COMPANY,
                strip_upper("auditor_pan").alias("auditor_pan"),
                strip("auditor_firm").alias("auditor_firm"),
                parse_iso("auditor_resignation_date").alias("auditor_resignation_date"),
            )
            # the days of the valid years, which saves working out the year of every row
            .where(F.col("auditor_resignation_date").between(date_lit(first), date_lit(last)))
            .withColumn(FY, financial_year("auditor_resignation_date"))
        )
        one = any_per_key(rows, [COMPANY, FY, "auditor_pan"], ties=["auditor_resignation_date", "auditor_firm"])
        return one.withColumn("has_auditor_resigned", F.lit(1))

    def auditor_facts(self) -> DataFrame:
        """One row per company, auditor, statement and year with its three flags."""
        each = explode_ids(self.auditor_rows(), "pan_no", "auditor_pan", self.strict)
        key = [COMPANY, "auditor_pan", STMT, FY]
        # the form source comes first, so its row wins where both name an auditor
        one = first_per_key(
            each, key, [F.asc("source"), F.asc_nulls_last("wthr_qualified"), F.asc_nulls_last("t_category")]
        )
        not_qualified = F.coalesce(F.col("wthr_qualified") == "no", F.lit(False))
        return (
            one.join(self.resignations(), [COMPANY, FY, "auditor_pan"], "left")
            .withColumns({"not_qualified": not_qualified, "has_auditor_resigned": F.coalesce("has_auditor_resigned", F.lit(0))})
            .withColumn("adv_qualified", F.col("not_qualified").cast("int"))
            .withColumn("adverse_qualf_and_resigned", F.col("has_auditor_resigned") * F.col("adv_qualified"))
            .select(
                COMPANY, FY, "t_category", "auditor_pan", "auditor_firm", STMT, "wthr_qualified", "not_qualified",
                "auditor_resignation_date", "has_auditor_resigned", "adv_qualified", "adverse_qualf_and_resigned",
            )
        )

    def _scored_rows(self) -> DataFrame:
        """The flags of all facts, and a neutral row of every company and valid year.

        A neutral row stands for a year without facts. It is the only row of its year without
        statement and auditor; where a year has facts, the row is void and dropped later on,
        by its neighbour. So no second pass over the tables has to tell which years those are.
        """
        flags = list(FLAG_SCORES.values())
        facts = self.auditor_facts().select(
            COMPANY, FY, STMT, "auditor_pan", *[F.col(c).cast("double").alias(c) for c in flags], F.lit(False).alias(_NEUTRAL)
        )
        spine = company_years(self.universe.ids, self.as_on.valid_years)
        neutral = spine.withColumns({**{c: F.lit(NEUTRAL_SCORE) for c in flags}, _NEUTRAL: F.lit(True)})
        return facts.unionByName(neutral, allowMissingColumns=True)

    def _latest(self, rows: DataFrame, keys: list[str], most: int) -> DataFrame:
        """At most the `most` last rows of each key that are not void, numbered from the last.

        The limit is pruned before the exchange, so a key of any size sends a few rows a task.
        """
        down = Window.partitionBy(*keys).orderBy(F.desc(FY), F.asc(_NEUTRAL), F.desc_nulls_last(STMT), F.desc_nulls_last("auditor_pan"))
        # besides the rows sought there are as many void ones as there are years
        top = rows.withColumn(_NTH, F.row_number().over(down)).where(F.col(_NTH) <= most + len(self.as_on.valid_years))
        void = F.col(_NEUTRAL) & F.coalesce(F.lag(FY).over(down) == F.col(FY), F.lit(False))
        known = top.withColumn("__void", void).where("not __void").drop("__void")
        return known.withColumn(_NTH, F.row_number().over(down)).where(F.col(_NTH) <= most)

    def auditor_history(self) -> DataFrame:
        """Facts of the as-on year with means over the last 1-4 rows of the company.

        Of the years before, a company's last three rows are all that a mean can reach. They
        are found in the same pass as the rows of the as-on year, which stand for themselves.
        """
        depth = max(WINDOWS) - 1
        current = F.col(FY) == self.as_on.financial_year
        rows = self._scored_rows().withColumn("__own", F.when(current, F.struct(STMT, "auditor_pan")))
        reached = self._latest(rows, [COMPANY, "__own"], depth).drop("__own", _NTH)
        rolled = rolling_rows(
            reached.withColumn("__current", current.cast("double")),
            [COMPANY],
            [FY, STMT, "auditor_pan"],
            {**FLAG_SCORES, "__current": "__current"},
            windows=WINDOWS,
            slice_rows=self.slice_rows,
        )
        # the neutral row comes last in its year, and is void if the row before is of that year
        void = F.col(_NEUTRAL) & (F.col("__current_2yrs") == 1)
        return rolled.where(current & ~void).drop(*[f"__current_{n}yrs" for n in WINDOWS], "__current", _NEUTRAL)

    def flag_scores(self) -> DataFrame:
        """All distinct score rows of the as-on year, each score combined with the others."""
        # A score over 1-4 flags takes at most 3 + 9 + 27 + 81 different rows, which bounds
        # the sets; they are built in one pass and combined without a join.
        rows = {s: F.struct(*[f"{s}_{n}yrs" for n in WINDOWS]) for s in FLAG_SCORES}
        out = self.auditor_history().groupBy(COMPANY).agg(*[F.collect_set(r).alias(s) for s, r in rows.items()])
        for score in FLAG_SCORES:
            out = out.withColumn(score, F.explode(score))
        return out.select(COMPANY, *[f"{score}.*" for score in FLAG_SCORES])

    def last_flag_scores(self) -> DataFrame:
        """Scores at the last row of the as-on year: one row per company, from its last four."""
        last = self._latest(self._scored_rows(), [COMPANY], max(WINDOWS))
        flags = list(FLAG_SCORES.values())
        places = range(1, max(WINDOWS) + 1)
        wide = last.groupBy(COMPANY).agg(
            *[F.max(F.when(F.col(_NTH) == i, F.col(c))).alias(f"{c}_{i}") for c in flags for i in places]
        )
        means = []
        for score, flag in FLAG_SCORES.items():
            total = F.lit(0.0)
            for n in places:
                total = total + F.col(f"{flag}_{n}")
                means.append((total / n).alias(f"{score}_{n}yrs"))
        return wide.select(COMPANY, *means)

    def caro_scores(self) -> DataFrame:
        """Scores of the answers in standalone statements; every company has a row."""
        answers = (
            self._scan("aoc4_caro_dtls", *STATEMENT, *ANSWER_SCORES.values())
            .where(F.col(STMT) == "standalone")
            .select(COMPANY, FY, *ANSWER_SCORES.values())
            .unionByName(self.universe.ids, allowMissingColumns=True)
        )
        return answer_scores_by_year(answers, COMPANY, FY, self.as_on.valid_years, ANSWER_SCORES)

    def get_auditor_features(self, one_row: bool = True) -> DataFrame:
        """36 scores per company, of its last row of the as-on year; without `one_row`, one
        row for each combination of the distinct flag scores in that year."""
        if one_row:
            return side_by_side(self.found(), [COMPANY])
        return self.caro_scores().join(self.flag_scores(), COMPANY, "left")

    def found(self) -> list[DataFrame]:
        """Both score blocks, each with a row for every company of the universe."""
        return [self.caro_scores(), self.last_flag_scores()]
