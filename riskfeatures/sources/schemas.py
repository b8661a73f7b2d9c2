"""Columns and types of the source tables."""

from __future__ import annotations

KEYS = "company_master_id bigint, financial_year string, is_consolidated_standalone_stmt string"


def _doubles(names: str, suffixes: tuple[str, ...] = ("",)) -> str:
    return ", ".join(f"{n}{s} double" for n in names.split() for s in suffixes)


_CURR_PREV = ("_curr", "_prev")

# Table and column names of the sources.
_DDL = {
    "form_aoc4_dtls": f"{KEYS}, valid_data int, inserted_at timestamp, wthr_fin_statement_qualify string",
    "aoc4_auditor_dtls": f"{KEYS}, pan_no string, t_category string",
    "aoc4xbrl_auditor_dtls": f"{KEYS}, aud_firm_pan string, category string, wthr_qualified string",
    "adt3_general_resignation_dtls": (
        "company_master_id bigint, financial_year string, auditor_pan string, "
        "auditor_firm string, auditor_resignation_date string"
    ),
    "aoc4_caro_dtls": (
        f"{KEYS}, t_fixed_assets string, t_fraud_noticed string, t_statutory_dues string, "
        "t_accept_public_deposits string, t_term_loans string, t_inventories string"
    ),
    "director_history_details": (
        "company_master_id bigint, director_master_id bigint, designation string, "
        "appointment_original_date string, date_cessation string"
    ),
    "director_master": "director_master_id bigint, DIN bigint",
    "dir12_director_dtls": (
        "company_master_id bigint, director_din string, t_dir_category string, appt_chng_desig_date date"
    ),
    "director_remarks": "din string, remarks string",
    "credit_rating_data": (
        "company_master_id bigint, credit_rating_agency string, derived_long_term_rating string, "
        "d_date_of_last_rating date"
    ),
    "cibil_defaulter_data": "company_master_id bigint, credit_bureau string, d_quarter date",
    "accord_mca_balance_sheet": f"{KEYS}, document_date date, accord_mca_balance_sheet_dtls_id bigint, form_id int, "
    + _doubles("tot_assets t_tot_assets t_tot_share_hold_fund lng_term_borrow shrt_term_borrow t_tot_fixed_assets", _CURR_PREV)
    + ", "
    + _doubles("t_networth dep loan subordinated_liab borrowings debt_security t_cash_eqv_bank", _CURR_PREV)
    + ", "
    + _doubles(
        "tot_curr_assets_curr tot_curr_liability_curr share_cap_curr rsrv_surp_curr money_share_warrnt_curr "
        "t_tot_non_curr_liability_curr t_tot_curr_liability_curr cash_eqv_curr trade_pay_curr t_tot_fin_liab_curr"
    ),
    "accord_mca_profit_loss": f"{KEYS}, document_date date, accord_mca_profit_loss_id bigint, form_id int, "
    + _doubles("tot_tax_exp t_editda tot_depr_depl_amor t_tot_profit_loss_for_period", _CURR_PREV)
    + ", "
    + _doubles("t_othr_exp fince_cost intreset_inc", _CURR_PREV)
    + ", "
    + _doubles(
        "tot_profit_bfr_tax_curr t_tot_profit_bfr_tax_prev t_tot_rev_frm_operation_curr t_rev_frm_serv_sale_curr "
        "t_rev_frm_prod_sale_curr t_tot_rev_curr gross_sales_curr invent_stck_in_trade_curr "
        "material_cost_consumd_curr t_invent_chng_fg_wip_stck_in_trade_curr"
    ),
    "accord_mca_financial_ratio": f"{KEYS}, document_date date, "
    + _doubles(
        "inventory_days receivables_days return_on_cap_employed current_ratio quick_ratio ebidta_margins_per pat_margins_per"
    ),
    "financial_ratios": f"{KEYS}, financial_ratios_id bigint, form_id int, "
    + _doubles("imp_loa_ratio", _CURR_PREV),
    "yml_sat_litigation_data": "company_master_id bigint, d_date date, link string",
    "yml_bifr_litigation_data": (
        "company_master_id bigint, case_year int, status string, d_date_of_last_order date, case_number string"
    ),
    "yml_nclt_litigation_data": (
        "company_master_id bigint, cpno string, case_status string, sections string, d_order_date date, "
        "disposed_date string"
    ),
    "yml_high_court_litigation_data": (
        "company_master_id bigint, case_no string, case_year int, case_status string, "
        "crawl_dispose_date string, act string, is_criminal string"
    ),
    "yml_district_court_litigation_data": (
        "company_master_id bigint, case_number string, case_year int, case_status string, "
        "d_decision_date string, act string, is_criminal string"
    ),
}

# table -> column -> type
TABLES: dict[str, dict[str, str]] = {
    name: dict(column.split(" ") for column in ddl.split(", ")) for name, ddl in _DDL.items()
}

# The named connections and the tables that live in each.
CONNECTIONS = ("etl_crawler_ext", "etl_etl_data", "live_crawler_output")

_LIVE = (
    "director_history_details",
    "director_master",
    "director_remarks",
    "credit_rating_data",
    "cibil_defaulter_data",
    "yml_sat_litigation_data",
    "yml_bifr_litigation_data",
    "yml_nclt_litigation_data",
    "yml_high_court_litigation_data",
    "yml_district_court_litigation_data",
)
CONNECTION_OF = {
    name: "live_crawler_output" if name in _LIVE else "etl_etl_data" for name in TABLES
}
