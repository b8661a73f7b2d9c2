"""Ratios and changes of financial-services companies."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.dates import AsOn, year_of_label
from ..functions.numbers import columns, inf_to_null, rel_change, safe_div, sum_cols
from ..functions.text import is_one_of_years, strip, strip_lower
from ..operators.latest import latest_per_key, prefer_consolidated
from ..operators.members import COMPANY, Universe
from ..sources.registry import Sources

FY, STMT = "financial_year", "is_consolidated_standalone_stmt"
STATEMENT = [COMPANY, FY, STMT]

# Form ids, source columns and returned features.
NBFC_FORMS = (37, 38)
TOTAL_ASSET_FORMS = (3, 39)


def _both(names: str) -> list[str]:
    return [f"{n}_{period}" for n in names.split() for period in ("curr", "prev")]


BALANCE_SHEET = [
    *_both("t_tot_assets tot_assets t_networth t_tot_share_hold_fund dep loan subordinated_liab borrowings"),
    *_both("debt_security lng_term_borrow shrt_term_borrow t_cash_eqv_bank t_tot_fixed_assets"),
    "t_tot_fin_liab_curr",
]
PROFIT_LOSS = _both("t_othr_exp fince_cost t_tot_profit_loss_for_period intreset_inc")
RATIOS = _both("imp_loa_ratio")

FEATURES = (
    "total_assets_cur networth_curr roa roe_curr spread nim leverage yield cost_of_funds credit_costs pat "
    "other_expenses cash fixed_assets total_assets_change networth_change roe_change spread_change yield_change "
    "cost_of_funds_change credit_costs_change pat_change other_expenses_change cash_change fixed_assets_change roe"
).split()


def statement_ratios(df: DataFrame, form: str = "form_id", nulls: str = "propagate") -> DataFrame:
    """Ratios within one statement; a zero or missing divisor gives a missing ratio.

    nulls='skip' lets a missing addend count as zero in the sums of borrowings.
    """
    nbfc = f"{form} in {NBFC_FORMS}"

    def if_nbfc(value: str, otherwise: str = "null") -> str:
        return f"case when {nbfc} then {value} else {otherwise} end"

    def borrowings(period: str) -> str:
        return sum_cols([f"lng_term_borrow_{period}", f"shrt_term_borrow_{period}"], nulls)

    def funding(period: str) -> str:
        names = ("debt_security", "borrowings", "dep", "subordinated_liab")
        return sum_cols([f"{n}_{period}" for n in names], nulls)

    levels, ratios = {}, {}
    for period, assets, suffix in (("curr", "total_assets_cur", ""), ("prev", "total_assets_prev", "_prev")):
        levels[assets] = (
            f"case when {form} in {TOTAL_ASSET_FORMS} then t_tot_assets_{period} else tot_assets_{period} end"
        )
        levels[f"networth_{period}"] = if_nbfc(f"t_networth_{period}", f"t_tot_share_hold_fund_{period}")
        profit, interest, loan, cost = (
            f"{n}_{period}" for n in ("t_tot_profit_loss_for_period", "intreset_inc", "loan", "fince_cost")
        )
        ratios[f"roe_{period}"] = safe_div(profit, f"networth_{period}")
        ratios[f"spread{suffix}"] = if_nbfc(f"{safe_div(interest, loan)} - {safe_div(cost, funding(period))}")
        ratios[f"nim{suffix}"] = if_nbfc(safe_div(f"({interest} - {cost})", loan))
        ratios[f"yield{suffix}"] = safe_div(interest, loan)
        ratios[f"cost_of_funds{suffix}"] = if_nbfc(safe_div(cost, loan), safe_div(cost, borrowings(period)))
    all_assets = sum_cols(["total_assets_cur", "total_assets_prev"], nulls)
    ratios |= {
        "roa": f"2 * {safe_div('t_tot_profit_loss_for_period_curr', all_assets)}",
        "roe": safe_div("t_tot_profit_loss_for_period_curr", "networth_curr"),
        "leverage": safe_div(if_nbfc("t_tot_fin_liab_curr", borrowings("curr")), "networth_curr"),
        "credit_costs": if_nbfc("imp_loa_ratio_curr"),
        "pat": "t_tot_profit_loss_for_period_curr",
        "other_expenses": "t_othr_exp_curr",
        "cash": "t_cash_eqv_bank_curr",
        "fixed_assets": "t_tot_fixed_assets_curr",
    }
    changes = {
        "total_assets": ("total_assets_cur", "total_assets_prev"),
        "networth": ("networth_curr", "networth_prev"),
        "roe": ("roe_curr", "roe_prev"),
        "spread": ("spread", "spread_prev"),
        "yield": ("yield", "yield_prev"),
        "cost_of_funds": ("cost_of_funds", "cost_of_funds_prev"),
        "credit_costs": ("imp_loa_ratio_curr", "imp_loa_ratio_prev"),
        "pat": ("t_tot_profit_loss_for_period_curr", "t_tot_profit_loss_for_period_prev"),
        "other_expenses": ("t_othr_exp_curr", "t_othr_exp_prev"),
        "cash": ("t_cash_eqv_bank_curr", "t_cash_eqv_bank_prev"),
        "fixed_assets": ("t_tot_fixed_assets_curr", "t_tot_fixed_assets_prev"),
    }
    changed = {f"{name}_change": rel_change(cur, prev) for name, (cur, prev) in changes.items()}
    return df.withColumns(columns(levels)).withColumns(columns(ratios)).withColumns(columns(changed))


class FsFinancialFeatures:
    def __init__(
        self,
        sources: Sources,
        companies,
        as_on_date: dt.date,
        today: dt.date | None = None,
        form_id_source: str = "ratio",
        nulls: str = "propagate",
    ):
        """form_id_source: 'ratio' takes the form id of the ratio table, which is missing
        without a ratio row; 'balance_sheet' takes that of the balance sheet."""
        if form_id_source not in ("ratio", "balance_sheet"):
            raise ValueError("form_id_source must be 'ratio' or 'balance_sheet'")
        self.sources = sources
        self.universe = Universe.of(sources.spark, companies)
        self.as_on = AsOn(as_on_date, today or dt.date.today())
        self.form_id_source = form_id_source
        self.nulls = nulls

    def _scan(self, table: str, row_id: str, amounts: Sequence[str]) -> DataFrame:
        """Statement rows of the as-on financial year only."""
        df = self.sources.read(table, [*STATEMENT, row_id, "form_id", *amounts], only=self.universe.wanted)
        return self.universe.restrict(df).where(is_one_of_years(FY, [self.as_on.financial_year])).withColumn(FY, strip(FY))

    def extract_financial(self, balance: DataFrame, profit: DataFrame, ratio: DataFrame) -> DataFrame:
        latest = []
        for df, row_id in (
            (balance, "accord_mca_balance_sheet_dtls_id"),
            (profit, "accord_mca_profit_loss_id"),
            (ratio, "financial_ratios_id"),
        ):
            clean = df.withColumn(STMT, strip_lower(STMT))
            amounts = [c for c in df.columns if c not in (*STATEMENT, row_id)]
            latest.append(latest_per_key(clean, STATEMENT, row_id, ties=amounts).drop(row_id))
        balance, profit, ratio = latest
        if self.form_id_source == "ratio":
            balance = balance.drop("form_id")
        else:
            ratio = ratio.drop("form_id")
        joined = balance.join(profit.drop("form_id"), STATEMENT).join(ratio, STATEMENT, "left")
        one = prefer_consolidated(joined, [COMPANY, FY])
        rated = statement_ratios(one, nulls=self.nulls)
        finite = [f"{inf_to_null(f)} as {f}" for f in FEATURES]
        return rated.selectExpr(COMPANY, FY, *finite).withColumn("financial_year_start", year_of_label(FY))

    def get_fs_financials(self) -> DataFrame:
        return self.extract_financial(
            self._scan("accord_mca_balance_sheet", "accord_mca_balance_sheet_dtls_id", BALANCE_SHEET),
            self._scan("accord_mca_profit_loss", "accord_mca_profit_loss_id", PROFIT_LOSS),
            self._scan("financial_ratios", "financial_ratios_id", RATIOS),
        )
