"""The source tables of the feature plans, derived from the given order tables.

Each view is one SQL text that Spark and DuckDB both run. Views cover the whole of the
tables they read.
"""

from __future__ import annotations

import datetime as dt
import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.registry import Sources
from ..sources.schemas import TABLES

AS_ON = dt.date(2000, 8, 20)
TODAY = dt.date(2001, 12, 31)
SERIES_START = dt.date(1995, 1, 1)  # of the first filing

BASE_TABLES = ("customer", "orders", "lineitem", "part", "events")


def fy_label(day: str) -> str:
    start = f"(year({day}) - case when month({day}) <= 3 then 1 else 0 end)"
    return f"(cast({start} as string) || '-' || cast({start} + 1 as string))"


def dmy(day: str, sep: str = "/") -> str:
    """d/M/yyyy text."""
    return " || ".join([f"cast(day({day}) as string)", f"'{sep}'", f"cast(month({day}) as string)", f"'{sep}'", f"cast(year({day}) as string)"])


def ddmmyyyy(day: str, sep: str = "/") -> str:
    two = [f"lpad(cast({part}({day}) as string), 2, '0')" for part in ("day", "month")]
    return f" || '{sep}' || ".join([*two, f"cast(year({day}) as string)"])


def ddmmyy(day: str) -> str:
    """dd/MM/yy text."""
    return ddmmyyyy(day).replace(f"cast(year({day}) as string)", f"substring(cast(year({day}) as string), 3, 2)")


def _doubles(columns: dict[str, str]) -> str:
    return ", ".join(f"cast({e} as double) as {c}" for c, e in columns.items())


_WITH_LINES = "orders left join lineitem on l_orderkey = o_orderkey"
_STMT = "case o_orderstatus when 'F' then ' Standalone ' when 'O' then 'CONSOLIDATED' end"
_LINES = "lineitem join orders on l_orderkey = o_orderkey"

# Amounts are whole numbers, so both engines compute the same doubles from them.
_ORDER_SUMS = f"""
select o_orderkey, o_custkey as company_master_id, {fy_label('o_orderdate')} as financial_year,
  {_STMT} as is_consolidated_standalone_stmt, o_orderpriority as priority,
  case when o_orderpriority = '4-NOT SPECIFIED' then null else cast(o_orderdate as date) end as document_date,
  case o_orderpriority when '1-URGENT' then 37 when '2-HIGH' then 38 when '3-MEDIUM' then 3
    when '4-NOT SPECIFIED' then 39 else 1 end as form_id,
  sum(cast(round(l_extendedprice * 100) as bigint)) as price, sum(cast(l_quantity as bigint)) as qty,
  sum(cast(round(l_discount * 100) as bigint)) as disc, sum(cast(round(l_tax * 100) as bigint)) as tax
from orders left join lineitem on l_orderkey = o_orderkey
group by o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_orderpriority"""

_STATEMENT = "company_master_id, financial_year, is_consolidated_standalone_stmt, document_date"

_BALANCE = {
    "tot_curr_assets_curr": "price",
    "tot_curr_liability_curr": "qty * 40000",
    "share_cap_curr": "qty * 500",
    "rsrv_surp_curr": "price - qty * 30000",
    "money_share_warrnt_curr": "case when priority = '5-LOW' then null else disc end",
    "t_tot_non_curr_liability_curr": "tax * 100",
    "t_tot_curr_liability_curr": "qty * 1000",
    "cash_eqv_curr": "tax",
    "trade_pay_curr": "disc * 77",
    "t_tot_fin_liab_curr": "qty * 9",
    "tot_assets_curr": "price + qty",
    "tot_assets_prev": "price - disc * 1000",
    "t_tot_assets_curr": "disc",
    "t_tot_assets_prev": "disc - tax",
    "t_tot_share_hold_fund_curr": "qty - 100",
    "t_tot_share_hold_fund_prev": "qty - 98",
    "lng_term_borrow_curr": "tax * 5000",
    "lng_term_borrow_prev": "tax * 4000",
    "shrt_term_borrow_curr": "disc * 1000",
    "shrt_term_borrow_prev": "disc * 900",
    "t_tot_fixed_assets_curr": "case when priority = '2-HIGH' then null else price + tax end",
    "t_tot_fixed_assets_prev": "disc * 7",
    "t_networth_curr": "tax - 4",
    "t_networth_prev": "tax - 5",
    "dep_curr": "disc",
    "dep_prev": "tax",
    "loan_curr": "tax * 3",
    "loan_prev": "disc * 3",
    "subordinated_liab_curr": "case when priority = '1-URGENT' and disc = 10 then null else 0 end",
    "subordinated_liab_prev": "0",
    "borrowings_curr": "tax",
    "borrowings_prev": "disc",
    "debt_security_curr": "-tax",
    "debt_security_prev": "qty",
    "t_cash_eqv_bank_curr": "tax + 1",
    "t_cash_eqv_bank_prev": "tax",
}
_PROFIT = {
    "tot_profit_bfr_tax_curr": "price - qty * 50000",
    "t_tot_profit_bfr_tax_prev": "price - qty * 45000",
    "tot_tax_exp_curr": "tax * 10",
    "tot_tax_exp_prev": "tax * 9",
    "t_tot_rev_frm_operation_curr": "price - tax",
    "t_rev_frm_serv_sale_curr": "qty",
    "t_rev_frm_prod_sale_curr": "price",
    "t_editda_curr": "tax * 1000 - disc * 500",
    "t_editda_prev": "disc * 600",
    "t_tot_rev_curr": "case when priority = '3-MEDIUM' then -price else price end",
    "gross_sales_curr": "disc",
    "tot_depr_depl_amor_curr": "tax * 100",
    "tot_depr_depl_amor_prev": "disc * 600 - tax",
    "t_tot_profit_loss_for_period_curr": "disc - tax * 90",
    "t_tot_profit_loss_for_period_prev": "disc - tax",
    "invent_stck_in_trade_curr": "tax",
    "material_cost_consumd_curr": "case when priority = '5-LOW' then -tax else disc end",
    "t_invent_chng_fg_wip_stck_in_trade_curr": "0",
    "t_othr_exp_curr": "tax",
    "t_othr_exp_prev": "disc",
    "fince_cost_curr": "qty",
    "fince_cost_prev": "qty + disc",
    "intreset_inc_curr": "case when tax = 7 then null else price end",
    "intreset_inc_prev": "price - tax",
}
_RATIO = {
    "inventory_days": "qty",
    "receivables_days": "disc * 3",
    "return_on_cap_employed": "tax",
    "current_ratio": "qty * 2",
    "quick_ratio": "case when priority = '1-URGENT' then null else qty end",
    "ebidta_margins_per": "disc * 2",
    "pat_margins_per": "tax - disc",
}

_TENURE = """
select o_custkey as company_master_id, cast(floor(o_orderkey / 3) as bigint) as director_master_id,
  case when sum(l_quantity) > 200 then ' Nominee Director' when o_orderpriority = '5-LOW' then null
    else 'Director ' end as designation,
  cast(o_orderdate as date) as appointed,
  case when o_orderstatus = 'O' then null else cast(max(l_shipdate) as date) end as ceased
from orders left join lineitem on l_orderkey = o_orderkey
group by o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_orderpriority"""

_BAN_START = "(date '1996-01-01' + 30 * p_size)"
_BAN_END = "(date '1996-01-01' + (30 * p_size + 1826))"

VIEWS: dict[str, str] = {
    "order_sums": _ORDER_SUMS,
    "tenure": _TENURE,
    "companies": "select c_custkey as company_master_id from customer",
    "segment_companies": "select c_custkey as company_master_id from customer where c_mktsegment = 'BUILDING'",
    "form_aoc4_dtls": f"""
select o_custkey as company_master_id, {fy_label('o_orderdate')} || ' ' as financial_year,
  {_STMT} as is_consolidated_standalone_stmt, case when o_orderpriority = '5-LOW' then 0 else 1 end as valid_data,
  o_orderdate as inserted_at,
  case when o_orderpriority in ('1-URGENT', '2-HIGH') then ' No' else 'Yes ' end as wthr_fin_statement_qualify
from orders""",
    "aoc4_auditor_dtls": f"""
select o_custkey as company_master_id, {fy_label('o_orderdate')} as financial_year,
  {_STMT} as is_consolidated_standalone_stmt,
  '"' || cast(l_suppkey as string) || '", ' || cast(l_partkey as string) || ', ' as pan_no, l_returnflag as t_category
from {_LINES} where l_linestatus = 'F'""",
    "aoc4xbrl_auditor_dtls": f"""
select o_custkey as company_master_id, {fy_label('l_shipdate')} as financial_year,
  {_STMT} as is_consolidated_standalone_stmt, cast(l_suppkey as string) as aud_firm_pan, l_returnflag as category,
  case l_returnflag when 'R' then 'No ' when 'A' then 'yes' end as wthr_qualified
from {_LINES} where l_linestatus = 'O'""",
    "adt3_general_resignation_dtls": f"""
select o_custkey as company_master_id, {fy_label('o_orderdate')} as financial_year,
  cast(l_suppkey as string) as auditor_pan, ' Firm ' || cast(l_suppkey as string) as auditor_firm,
  case when l_returnflag = 'R' then cast(cast(l_shipdate as date) as string) end as auditor_resignation_date
from {_LINES}""",
    "aoc4_caro_dtls": f"""
select o_custkey as company_master_id, {fy_label('o_orderdate')} as financial_year,
  case o_orderstatus when 'O' then 'Consolidated' else ' STANDALONE' end as is_consolidated_standalone_stmt,
  case o_orderstatus when 'F' then 'Favourable' else 'Unfavourable' end as t_fixed_assets,
  case o_orderpriority when '1-URGENT' then 'DISCLAIMER' when '2-HIGH' then 'favourable' else 'not applicable' end as t_fraud_noticed,
  case when o_totalprice > 400000 then 'Unfavourable' when o_totalprice > 200000 then 'Favourable' end as t_statutory_dues,
  case o_orderpriority when '5-LOW' then ' unfavourable' else 'favourable' end as t_accept_public_deposits,
  case when o_orderpriority = '3-MEDIUM' then 'Favourable' end as t_term_loans,
  case when o_totalprice < 100000 then 'unfavourable' else 'FAVOURABLE' end as t_inventories
from orders""",
    "director_history_details": f"""
select company_master_id, director_master_id, designation, {dmy('appointed')} as appointment_original_date,
  {dmy('ceased')} as date_cessation from tenure""",
    "director_master": """
select distinct cast(floor(o_orderkey / 3) as bigint) as director_master_id, cast(floor(o_orderkey / 3) as bigint) as DIN
from orders""",
    "dir12_director_dtls": """
select o_custkey as company_master_id,
  case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then 'unknown'
    else ' ' || cast(cast(floor(o_orderkey / 3) as bigint) as string) end as director_din,
  case o_orderpriority when '1-URGENT' then 'Independent ' when '2-HIGH' then 'independent' when '3-MEDIUM' then ' promoter'
    when '5-LOW' then 'other' end as t_dir_category,
  cast(o_orderdate as date) as appt_chng_desig_date
from orders""",
    "director_remarks": f"""
select ' ' || cast(p_partkey as string) || ' ' as din,
  case p_type
    when 'ECONOMY' then 'No remark'
    when 'PROMO' then 'Disqualified from ' || {ddmmyyyy(_BAN_END)} || ' to ' || {ddmmyyyy(_BAN_START)}
    when 'SMALL' then ' DISQUALIFIED From ' || {ddmmyy(_BAN_START)}
      || ' to ' || {ddmmyyyy(_BAN_END)} || ' under the act'
    else 'Disqualified from ' || {ddmmyyyy(_BAN_START)} || ' to ' || {ddmmyyyy(_BAN_END)} end as remarks
from part""",
    "credit_rating_data": """
select o_custkey as company_master_id,
  case when o_orderpriority = '4-NOT SPECIFIED' then null else ' ' || o_orderpriority end as credit_rating_agency,
  case when o_orderstatus = 'F' and o_totalprice > 250000 then 'D ' else 'A' end as derived_long_term_rating,
  cast(o_orderdate as date) as d_date_of_last_rating
from orders""",
    "cibil_defaulter_data": """
select o_custkey as company_master_id,
  case o_orderpriority when '1-URGENT' then ' CIBIL' when '5-LOW' then null else 'other' end as credit_bureau,
  cast(o_orderdate as date) as d_quarter
from orders""",
    "accord_mca_balance_sheet": f"""
select {_STATEMENT}, o_orderkey as accord_mca_balance_sheet_dtls_id, form_id, {_doubles(_BALANCE)} from order_sums""",
    "accord_mca_profit_loss": f"""
select {_STATEMENT}, o_orderkey as accord_mca_profit_loss_id, form_id, {_doubles(_PROFIT)} from order_sums""",
    "accord_mca_financial_ratio": f"select {_STATEMENT}, {_doubles(_RATIO)} from order_sums",
    "financial_ratios": f"""
select company_master_id, financial_year,
  case when priority = '2-HIGH' then 'draft' else is_consolidated_standalone_stmt end as is_consolidated_standalone_stmt,
  o_orderkey as financial_ratios_id, form_id,
  {_doubles({"imp_loa_ratio_curr": "disc", "imp_loa_ratio_prev": "tax"})}
from order_sums""",
    "yml_sat_litigation_data": """
select o_custkey as company_master_id, cast(o_orderdate as date) as d_date, o_orderpriority || o_orderstatus as link
from orders""",
    "yml_bifr_litigation_data": f"""
select o_custkey as company_master_id, case when l_tax = 0 then 1899 else cast(year(o_orderdate) as int) end as case_year,
  case l_returnflag when 'R' then 'Abated' when 'A' then 'Winding up Notice' else 'Pending' end as status,
  case when l_discount = 0 then null else cast(l_shipdate as date) end as d_date_of_last_order,
  cast(o_orderkey as string) as case_number
from {_LINES}""",
    "yml_nclt_litigation_data": f"""
select o_custkey as company_master_id, cast(o_orderkey as string) as cpno,
  case l_linestatus when 'F' then ' Disposed Off' else 'Pending' end as case_status,
  case l_returnflag when 'N' then 'other' else 'IBC under Sec 7' end as sections, cast(o_orderdate as date) as d_order_date,
  case when l_linestatus = 'F' then {ddmmyyyy('l_shipdate', '-')} end as disposed_date
from {_LINES}""",
    "yml_high_court_litigation_data": f"""
select o_custkey as company_master_id, cast(o_orderkey as string) as case_no, cast(year(o_orderdate) as int) as case_year,
  case l_returnflag when 'R' then 'Pending ' when 'A' then 'Disposed' else 'transferred' end as case_status,
  case when l_returnflag = 'A' then cast(cast(l_shipdate as date) as string) end as crawl_dispose_date,
  case when l_discount < 0.025 then ' The Negotiable Instruments Act, 1881' else 'Companies Act' end as act,
  case when l_tax < 0.025 then '1' else '0' end as is_criminal
from {_LINES} where l_linestatus = 'O'""",
    "yml_district_court_litigation_data": f"""
select o_custkey as company_master_id, cast(o_orderkey as string) as case_number, cast(year(o_orderdate) as int) as case_year,
  case l_returnflag when 'R' then 'Case Pending' when 'A' then ' disposed' else 'transferred' end as case_status,
  case when l_returnflag = 'A' then cast(cast(l_shipdate as date) as string) end as d_decision_date,
  case when l_discount < 0.025 then 'NEGOTIABLE INSTRUMENTS ACT' else 'Companies Act' end as act,
  case when l_tax < 0.025 then '1' else 'no' end as is_criminal
from {_LINES} where l_linestatus = 'F'""",
}


def _names_in(sql: str) -> list[str]:
    words = set(re.findall(r"\w+", sql))
    return [v for v in VIEWS if v in words]


def expand(sql: str) -> str:
    """A query over views as one SQL text over the given tables."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name in _names_in(text):
            if name not in needed:
                add(VIEWS[name])
                needed.append(name)

    add(sql)
    ctes = [f"{n} as ({VIEWS[n]})" for n in needed]
    body = sql.strip()
    if not ctes:
        return body
    if body.lower().startswith("with "):
        return "with " + ",\n".join(ctes) + ",\n" + body[5:]
    return "with " + ",\n".join(ctes) + "\n" + body


def view(spark: SparkSession, sf_dir: str, name: str, by_company: bool = False) -> DataFrame:
    return run_sql(spark, sf_dir, f"select * from {name}", by_company)


@lru_cache(maxsize=64)
def base_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table; the handle is kept so that its schema is read once per session."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@lru_cache(maxsize=8)
def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines, dealt by company, with all columns that a view of both names.

    Every view that reads them takes the same exchange: no filter, semi join or choice of
    columns of a view may reach below it. So a test that every row passes names a row number,
    below which nothing moves, and all columns. What groups rows by company, or by company and
    more, finds them together.
    """
    named = " ".join(text for text in VIEWS.values() if "lineitem" in text)
    orders, lines = (
        df.select(*[c for c in df.columns if re.search(rf"\b{c}\b", named)])
        for df in (base_table(spark, sf_dir, t) for t in ("orders", "lineitem"))
    )
    both = orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left").repartition("o_custkey")
    passed = "__n >= 0 or " + " and ".join(f"{c} is null" for c in both.columns)
    return both.withColumn("__n", F.monotonically_increasing_id()).where(passed).drop("__n")


def run_sql(spark: SparkSession, sf_dir: str, sql: str, by_company: bool = False) -> DataFrame:
    """by_company: orders and lines are joined and dealt by company once for all such queries."""
    text = expand(sql)
    if by_company and ("from " + _WITH_LINES in text or "from " + _LINES in text):
        text = text.replace("from " + _WITH_LINES, "from {order_lines}").replace("from " + _LINES, "from {placed_lines}")
        lines = order_lines(spark, sf_dir)
        dealt = {"order_lines": lines, "placed_lines": lines.where("l_orderkey is not null")}
        dealt = {name: df for name, df in dealt.items() if f"{{{name}}}" in text}
    else:
        dealt = {}
    tables = {t: base_table(spark, sf_dir, t) for t in BASE_TABLES if re.search(rf"\b(from|join) {t}\b", text)}
    for t in tables:
        text = re.sub(rf"\b(from|join) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **tables, **dealt)


def sources(spark: SparkSession, sf_dir: str, *tables: str, by_company: bool = False) -> Sources:
    """The named source tables, or all of them."""
    return Sources(spark, {t: view(spark, sf_dir, t, by_company) for t in tables or TABLES})
