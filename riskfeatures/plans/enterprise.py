"""Ratios and trends of companies outside financial services."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import AsOn, year_of_label
from ..functions.numbers import columns, ieee_div, nan_to_null, sum_cols, zero_if_null
from ..functions.text import is_one_of_years, strip, strip_lower
from ..operators.latest import latest_per_key, prefer_consolidated
from ..operators.members import COMPANY, Universe
from ..operators.rolling import history_features, history_names
from ..sources.registry import Sources

FY, STMT, FY_START = "financial_year", "is_consolidated_standalone_stmt", "financial_year_start"
STATEMENT = [COMPANY, FY, STMT]

# Source columns read, and features returned.
BALANCE_SHEET = (
    "tot_curr_assets_curr tot_curr_liability_curr share_cap_curr rsrv_surp_curr money_share_warrnt_curr "
    "t_tot_non_curr_liability_curr t_tot_curr_liability_curr cash_eqv_curr tot_assets_curr t_tot_assets_curr "
    "shrt_term_borrow_curr lng_term_borrow_curr t_tot_fixed_assets_curr trade_pay_curr"
).split()
PROFIT_LOSS = (
    "tot_profit_bfr_tax_curr t_tot_profit_bfr_tax_prev tot_tax_exp_curr tot_tax_exp_prev "
    "t_tot_rev_frm_operation_curr t_rev_frm_serv_sale_curr t_rev_frm_prod_sale_curr t_editda_curr t_editda_prev "
    "t_tot_rev_curr gross_sales_curr tot_depr_depl_amor_curr tot_depr_depl_amor_prev "
    "t_tot_profit_loss_for_period_curr invent_stck_in_trade_curr material_cost_consumd_curr "
    "t_invent_chng_fg_wip_stck_in_trade_curr"
).split()
RATIOS = (
    "inventory_days receivables_days return_on_cap_employed current_ratio quick_ratio ebidta_margins_per pat_margins_per"
).split()

TREND_FEATURES = (
    "inventory_days receivables_days networth pat ebitda ebitda_by_sales roa roe ebitda_margin tot_fixed_asset "
    "revenue_from_operations"
).split()
GROWTH_FEATURES = ["total_revenue"]
YEARS_BACK = 4


def _over_years(*stems: str) -> list[str]:
    return [f"{s}_{i}_yrs" for s in stems for i in range(1, YEARS_BACK + 1)]


FEATURES = [
    *"total_debt_by_pat current_ratio quick_ratio pat ebitda ebitda_by_sales".split(),
    *_over_years("inventory_days_diff", "receivables_days_diff"),
    *_over_years("networth_diff_perc", "pat_diff_perc", "ebitda_by_sales_diff"),
    *"working_capital_by_asset short_term_debt_by_cash_eqv short_term_debt_by_networth roa roe".split(),
    "working_capital_turnover_ratio",
    *_over_years("tot_fixed_asset_diff_perc", "roa_diff", "roe_diff", "total_revenue_diff_perc"),
    *_over_years("revenue_from_operations_diff_perc"),
    *"growth_in_operating_income operating_income roce debt_by_gross_accrual ltborrowing_by_gross_accrual".split(),
    *"ltborrowing_by_ebitda debt_by_ebitda creditor_period working_capital_cycle ebidta_margins_per".split(),
    *"pat_margins_per inventory_days receivables_days".split(),
]

# Computed on the way and not among the returned features.
OTHER_FEATURES = (
    "networth total_liabilities est_rev total_revenue pat_prev growth_in_pat ebitda_margin working_capital "
    "total_borrow pat_by_ebitda revenue_from_operations tot_fixed_asset"
).split()


def statement_ratios(df: DataFrame) -> DataFrame:
    """Ratios within one statement. Divisions by zero give infinities, missing stays missing."""
    gross_accrual = "(t_tot_profit_loss_for_period_curr + tot_depr_depl_amor_curr)"
    cost_of_goods = sum_cols(
        ["t_invent_chng_fg_wip_stck_in_trade_curr", "material_cost_consumd_curr", "invent_stck_in_trade_curr"]
    )
    operating_income_prev = "(t_editda_prev - tot_depr_depl_amor_prev)"
    amounts = {
        "networth": zero_if_null(sum_cols(["share_cap_curr", "rsrv_surp_curr", "money_share_warrnt_curr"])),
        "total_liabilities": "t_tot_non_curr_liability_curr + t_tot_curr_liability_curr",
        "est_rev": "t_rev_frm_prod_sale_curr + t_rev_frm_serv_sale_curr",
        "total_revenue": "t_tot_rev_curr",
        "pat": "tot_profit_bfr_tax_curr - tot_tax_exp_curr",
        "pat_prev": "t_tot_profit_bfr_tax_prev - tot_tax_exp_prev",
        "ebitda": "t_editda_curr",
        "working_capital": "tot_curr_assets_curr - tot_curr_liability_curr",
        "total_borrow": "lng_term_borrow_curr + shrt_term_borrow_curr",
        "revenue_from_operations": "t_tot_rev_frm_operation_curr",
        "tot_fixed_asset": "t_tot_fixed_assets_curr",
        "operating_income": "t_editda_curr - tot_depr_depl_amor_curr",
        "roce": "return_on_cap_employed",
    }
    ratios = {
        "growth_in_pat": ieee_div("(pat - pat_prev)", "pat_prev"),
        "ebitda_by_sales": ieee_div("ebitda", "gross_sales_curr"),
        "ebitda_margin": ieee_div("ebitda", "total_revenue"),
        "working_capital_by_asset": ieee_div("working_capital", "tot_assets_curr"),
        "short_term_debt_by_cash_eqv": ieee_div("shrt_term_borrow_curr", "cash_eqv_curr"),
        "short_term_debt_by_networth": ieee_div("shrt_term_borrow_curr", "networth"),
        "roa": ieee_div("pat", "t_tot_assets_curr"),
        "roe": ieee_div("pat", "networth"),
        "total_debt_by_pat": ieee_div("total_borrow", "pat"),
        "pat_by_ebitda": ieee_div("pat", "ebitda"),
        "growth_in_operating_income": f"({ieee_div('operating_income', operating_income_prev)} - 1) * 100",
        "debt_by_gross_accrual": ieee_div("total_borrow", gross_accrual),
        "ltborrowing_by_gross_accrual": ieee_div("lng_term_borrow_curr", gross_accrual),
        "ltborrowing_by_ebitda": ieee_div("lng_term_borrow_curr", "ebitda"),
        "debt_by_ebitda": ieee_div("total_borrow", "ebitda"),
        "working_capital_turnover_ratio": ieee_div("revenue_from_operations", "working_capital"),
        "creditor_period": ieee_div("(trade_pay_curr * 365)", cost_of_goods),
    }
    cycle = {"working_capital_cycle": nan_to_null("inventory_days + receivables_days - creditor_period")}
    # an infinite input can still give NaN, which is a missing value
    ratios = {name: nan_to_null(text) for name, text in ratios.items()}
    return df.withColumns(columns(amounts)).withColumns(columns(ratios)).withColumns(columns(cycle))


class EfFinancialFeatures:
    def __init__(self, sources: Sources, companies, as_on_date: dt.date, today: dt.date | None = None):
        self.sources = sources
        self.universe = Universe.of(sources.spark, companies)
        self.as_on = AsOn(as_on_date, today or dt.date.today())

    def _scan(self, table: str, amounts: Sequence[str]) -> DataFrame:
        df = self.sources.read(table, [*STATEMENT, "document_date", *amounts], only=self.universe.wanted)
        return self.universe.restrict(df).where(is_one_of_years(FY, self.as_on.valid_years)).withColumn(FY, strip(FY))

    def source_frames(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Balance sheets, profit and loss statements and ratios of the valid years."""
        return (
            self._scan("accord_mca_balance_sheet", BALANCE_SHEET),
            self._scan("accord_mca_profit_loss", PROFIT_LOSS),
            self._scan("accord_mca_financial_ratio", RATIOS),
        )

    def statements(self, balance: DataFrame, profit: DataFrame, ratio: DataFrame) -> DataFrame:
        """Latest filings of the three tables joined, one statement per company and year."""
        latest = []
        for df in (balance, profit, ratio):
            amounts = [c for c in df.columns if c not in (*STATEMENT, "document_date")]
            clean = df.withColumn(STMT, strip_lower(STMT))
            # two filings of one day are told apart by their amounts, to be repeatable
            latest.append(
                latest_per_key(clean, STATEMENT, "document_date", ties=amounts, nulls="last").drop("document_date")
            )
        joined = latest[0].join(latest[1], STATEMENT).join(latest[2], STATEMENT)
        return prefer_consolidated(joined, [COMPANY, FY]).withColumn(FY_START, year_of_label(FY))

    def extract_financial(
        self, balance: DataFrame, profit: DataFrame, ratio: DataFrame, all_features: bool = False
    ) -> DataFrame:
        """Features of the as-on financial year; at most one row per company."""
        rated = statement_ratios(self.statements(balance, profit, ratio))
        names = list(FEATURES)
        if all_features:
            history = history_names(TREND_FEATURES, GROWTH_FEATURES, YEARS_BACK)
            names += OTHER_FEATURES + [c for c in history if c not in FEATURES]
        # one row per company and year, so a company has as many rows as there are years
        rolled = history_features(
            rated, [COMPANY], [FY_START, FY], TREND_FEATURES, GROWTH_FEATURES, YEARS_BACK, wanted=names
        )
        return rolled.where(F.col(FY) == self.as_on.financial_year).select(COMPANY, FY, FY_START, *names)

    def get_ef_financials(self, all_features: bool = False) -> DataFrame:
        return self.extract_financial(*self.source_frames(), all_features)
