"""One query per feature block, each over whole tables, with the SQL that must agree."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..plans.audit import ANSWER_SCORES, FLAG_SCORES, AuditorFeatures
from ..plans.directors import DirectorsFeatures
from ..plans.enterprise import BALANCE_SHEET as EF_BALANCE
from ..plans.enterprise import FEATURES as EF_FEATURES
from ..plans.enterprise import GROWTH_FEATURES, OTHER_FEATURES, TREND_FEATURES, EfFinancialFeatures, statement_ratios
from ..plans.enterprise import PROFIT_LOSS as EF_PROFIT
from ..plans.enterprise import RATIOS as EF_RATIOS
from ..plans.financial_services import BALANCE_SHEET as FS_BALANCE
from ..plans.financial_services import FEATURES as FS_FEATURES
from ..plans.financial_services import PROFIT_LOSS as FS_PROFIT
from ..plans.financial_services import RATIOS as FS_RATIOS
from ..plans.financial_services import FsFinancialFeatures
from ..plans.litigation import BIFR_DISPOSED_STATUSES, LitigationFeatures
from ..plans.scorecard import scorecard as scorecard_plan
from ..session import tune_together
from .operator_queries import COMPANY, DAY, FY, NOW, YEARS, YEARS_SQL, answer_score_sql, periods_sql
from .registry import query
from .views import AS_ON, SERIES_START, TODAY, fy_label, sources, view

WINDOWS = (1, 2, 3, 4)


def _plan(cls, spark, d, *tables, as_on: dt.date = AS_ON, companies: str = "companies", **options):
    return cls(sources(spark, d, *tables), view(spark, d, companies), as_on, TODAY, **options)


def _segment(sql: str) -> str:
    """Rows of the companies of a market segment, which is a universe of its own."""
    return f"select * from ({sql}) where company_master_id in (select company_master_id from segment_companies)"


# --- audit ----------------------------------------------------------------------------------

AUDIT_TABLES = (
    "form_aoc4_dtls", "aoc4_auditor_dtls", "aoc4xbrl_auditor_dtls", "adt3_general_resignation_dtls", "aoc4_caro_dtls",
)
_FY_UNNESTED = f"unnest([{YEARS_SQL[1:-1]}]) as financial_year"
_KEYS = "company_master_id, financial_year, stmt"

_FACT_CTES = f"""forms as (
  select company_master_id, trim(financial_year) as financial_year, lower(trim(is_consolidated_standalone_stmt)) as stmt,
    lower(trim(wthr_fin_statement_qualify)) as wthr_qualified
  from form_aoc4_dtls where valid_data = 1 and trim(financial_year) in {YEARS_SQL} and is_consolidated_standalone_stmt is not null
  qualify row_number() over (partition by company_master_id, trim(financial_year), lower(trim(is_consolidated_standalone_stmt))
    order by inserted_at desc, lower(trim(wthr_fin_statement_qualify))) = 1),
auditors as (
  select distinct company_master_id, trim(a.financial_year) as financial_year, lower(trim(a.is_consolidated_standalone_stmt)) as stmt,
    upper(trim(a.pan_no)) as pans, lower(trim(a.t_category)) as t_category, null as own_answer, 0 as source
  from aoc4_auditor_dtls a where trim(a.financial_year) in {YEARS_SQL}
  union all
  select distinct company_master_id, trim(financial_year), lower(trim(is_consolidated_standalone_stmt)), upper(trim(aud_firm_pan)),
    lower(trim(category)), lower(trim(wthr_qualified)), 1
  from aoc4xbrl_auditor_dtls where trim(financial_year) in {YEARS_SQL}),
pans as (
  select {_KEYS}, trim(pan) as auditor_pan, t_category, coalesce(own_answer, wthr_qualified) as wthr_qualified, source
  from (select a.*, case when source = 0 then f.wthr_qualified end as wthr_qualified,
      unnest(string_split(replace(replace(pans, '"', ''), '''', ''), ',')) as pan
    from auditors a left join forms f using ({_KEYS})) where trim(pan) <> ''),
resigned as (
  select company_master_id, financial_year, auditor_pan, min(auditor_resignation_date) as auditor_resignation_date,
    arg_min(auditor_firm, (auditor_resignation_date, auditor_firm)) as auditor_firm
  from (select company_master_id, upper(trim(auditor_pan)) as auditor_pan, trim(auditor_firm) as auditor_firm, auditor_resignation_date,
      {fy_label("cast(auditor_resignation_date as date)")} as financial_year
    from adt3_general_resignation_dtls where auditor_resignation_date is not null and financial_year in {YEARS_SQL})
  where financial_year in {YEARS_SQL} group by 1, 2, 3),
facts as (
  select p.company_master_id, p.financial_year, p.stmt, p.auditor_pan, p.t_category, p.wthr_qualified, r.auditor_firm, r.auditor_resignation_date,
    case when r.auditor_pan is null then 0 else 1 end as has_auditor_resigned, case when wthr_qualified = 'no' then 1 else 0 end as adv_qualified,
    case when r.auditor_pan is not null and wthr_qualified = 'no' then 1 else 0 end as adverse_qualf_and_resigned
  from (select * from pans where stmt is not null qualify row_number() over (partition by company_master_id, auditor_pan, stmt, financial_year
      order by source, wthr_qualified nulls last, t_category nulls last) = 1) p
  left join resigned r using (company_master_id, financial_year, auditor_pan))"""


def _mean(value: str, n: int, order: str) -> str:
    frame = f"(partition by company_master_id order by {order} rows between {n - 1} preceding and current row)"
    return f"case when count(*) over {frame} = {n} then avg({value}) over {frame} end"


_ROLLED_CTES = f"""{_FACT_CTES},
spine as (select company_master_id, {_FY_UNNESTED} from companies),
completed as (select company_master_id, financial_year, stmt, auditor_pan, {', '.join(f'coalesce(cast({f} as double), 0.5) as {f}' for f in FLAG_SCORES.values())}
  from spine left join facts using (company_master_id, financial_year)),
rolled as (select *, {', '.join(
    f"{_mean(flag, n, 'financial_year, stmt nulls last, auditor_pan nulls last')} as {score}_{n}yrs"
    for score, flag in FLAG_SCORES.items() for n in WINDOWS)} from completed),
latest as (select * from rolled where financial_year = '{YEARS[-1]}')"""


def _names(score: str) -> str:
    return ", ".join(f"{score}_{n}yrs" for n in WINDOWS)


CARO_SQL = f"""select company_master_id, {', '.join(_names(s) for s in ANSWER_SCORES)} from (
  select company_master_id, financial_year, {', '.join(
    f"{_mean(s, n, 'financial_year')} as {s}_{n}yrs" for s in ANSWER_SCORES for n in WINDOWS)}
  from (select company_master_id, financial_year, {', '.join(f'{answer_score_sql(a)} as {s}' for s, a in ANSWER_SCORES.items())}
    from (select company_master_id, {_FY_UNNESTED} from companies) left join (
      select * from aoc4_caro_dtls where lower(trim(is_consolidated_standalone_stmt)) = 'standalone') using (company_master_id, financial_year)
    group by 1, 2))
where financial_year = '{YEARS[-1]}'"""

AUDIT_SQL = f"""with {_ROLLED_CTES}, caro as ({CARO_SQL})
select company_master_id, {', '.join(_names(s) for s in [*ANSWER_SCORES, *FLAG_SCORES])} from caro
{' '.join(f'left join (select distinct company_master_id, {_names(s)} from latest) using (company_master_id)' for s in FLAG_SCORES)}"""

AUDIT_ONE_ROW_SQL = f"""with {_ROLLED_CTES}, caro as ({CARO_SQL})
select company_master_id, {', '.join(_names(s) for s in [*ANSWER_SCORES, *FLAG_SCORES])} from caro left join (
  select * from latest qualify row_number() over (partition by company_master_id order by stmt desc nulls last, auditor_pan desc nulls last) = 1)
using (company_master_id)"""


@query(f"""with {_FACT_CTES} select company_master_id, financial_year, t_category, auditor_pan, auditor_firm, stmt as is_consolidated_standalone_stmt,
  wthr_qualified, cast(adv_qualified as bigint) as not_qualified, auditor_resignation_date, cast(has_auditor_resigned as bigint) as has_auditor_resigned,
  cast(adv_qualified as bigint) as adv_qualified, cast(adverse_qualf_and_resigned as bigint) as adverse_qualf_and_resigned from facts""")
def auditor_facts(spark, d):
    return _plan(AuditorFeatures, spark, d, *AUDIT_TABLES).auditor_facts()


@query(CARO_SQL)
def caro_scores(spark, d):
    return _plan(AuditorFeatures, spark, d, "aoc4_caro_dtls").caro_scores()


@query(AUDIT_SQL)
def audit_scorecard(spark, d):
    return _plan(AuditorFeatures, spark, d, *AUDIT_TABLES).get_auditor_features(one_row=False)


@query(AUDIT_ONE_ROW_SQL)
def audit_scorecard_one_row(spark, d):
    return _plan(AuditorFeatures, spark, d, *AUDIT_TABLES).get_auditor_features()


@query(AUDIT_SQL)
def audit_scorecard_sliced(spark, d):
    """All score rows, with nearly every company's auditor rows cut into slices."""
    return _plan(AuditorFeatures, spark, d, *AUDIT_TABLES, slice_rows=3).get_auditor_features(one_row=False)


@query(_segment(AUDIT_ONE_ROW_SQL))
def audit_scorecard_of_universe(spark, d):
    return _plan(AuditorFeatures, spark, d, *AUDIT_TABLES, companies="segment_companies").get_auditor_features()


# --- directors ------------------------------------------------------------------------------

DIRECTOR_TABLES = ("director_history_details", "director_master")

_HISTORY = """(select company_master_id, director_master_id, lower(trim(designation)) as designation,
  cast(try_strptime(appointment_original_date, '%d/%m/%Y') as date) as appointed,
  cast(try_strptime(date_cessation, '%d/%m/%Y') as date) as ceased from director_history_details)"""

_CATEGORY = """(select company_master_id, din, kind from (select company_master_id, try_cast(trim(director_din) as bigint) as din,
    lower(trim(t_dir_category)) as kind, appt_chng_desig_date as since from dir12_director_dtls)
  where din is not null and since is not null
  qualify row_number() over (partition by company_master_id, din order by since desc, kind nulls last) = 1)"""


def _resigned_sql() -> str:
    kinds = {"indep_": "indep", "promoter_": "promoter", "": "everyone"}
    sums = [
        f"cast(coalesce(sum({col}) filter (ceased >= {DAY} - {days}), 0) as bigint) as n_{who}dir_resigned_in_{years}_yr"
        for who, col in kinds.items()
        for years, days in ((1, 364), (2, 729))
    ]
    return f"""select company_master_id, {', '.join(sums)} from companies left join (
  select h.company_master_id, h.ceased, count(distinct m.DIN) filter (kind = 'independent') as indep,
    count(distinct m.DIN) filter (kind = 'promoter') as promoter, count(distinct m.DIN) as everyone
  from {_HISTORY} h join director_master m using (director_master_id)
  left join {_CATEGORY} k on k.company_master_id = h.company_master_id and k.din = m.DIN
  where h.ceased between {DAY} - 730 and {DAY} group by 1, 2) using (company_master_id) group by 1"""


RESIGNED_SQL = _resigned_sql()


def _flag_sql(name: str, hits: str) -> str:
    return f"""select company_master_id, cast(case when company_master_id in ({hits}) then 1 else 0 end as bigint) as {name} from companies"""


def _disqualified(ended: str, where: str) -> str:
    return f"""select h.company_master_id from (select company_master_id, director_master_id, {ended} as ended from {_HISTORY} where {where}) h
  join director_master m using (director_master_id) join ({periods_sql()}) p on p.din = m.DIN and h.ended between p_from and p_to"""


_CAPPED = f"least(coalesce(ceased, {DAY}), {DAY})"
DISQ_ACTIVE_SQL = _flag_sql("disqualified_director_active", _disqualified(_CAPPED, f"appointed < {_CAPPED}"))
DISQ_RESIGNED_SQL = _flag_sql(
    "disqualified_director_resigned", _disqualified("ceased", "ceased between date '2000-04-01' and date '2001-03-31'")
)


def _two_hop_sql(name: str, bad: str) -> str:
    in_office, liable = (
        f"coalesce({who}.designation not like '%nominee%', true) and ({who}.ceased is null or {who}.ceased + {days} > {DAY})"
        for who, days in (("here", 0), ("there", 182))
    )
    return _flag_sql(
        name,
        f"""select here.company_master_id from {_HISTORY} here join {_HISTORY} there using (director_master_id)
  where here.company_master_id <> there.company_master_id and {in_office} and {liable} and there.company_master_id in ({bad})""",
    )


RATING_SQL = _two_hop_sql(
    "director_in_d_rated_comp",
    f"""select company_master_id from (
    select company_master_id, rating, day as rt_from, case when agency is null then {NOW}
      else coalesce(lead(day) over (partition by company_master_id, agency order by day, rating), {NOW}) end as rt_to
    from (select distinct company_master_id, trim(credit_rating_agency) as agency, lower(trim(derived_long_term_rating)) as rating,
      d_date_of_last_rating as day from credit_rating_data))
  where rating = 'd' and {DAY} between rt_from and rt_to""",
)
DEFAULT_SQL = _two_hop_sql(
    "director_in_defaulted_comp",
    f"""select company_master_id from (select company_master_id, lower(trim(credit_bureau)) as bureau, d_quarter from cibil_defaulter_data)
  where bureau is not null and case when bureau = 'cibil' then date_trunc('quarter', d_quarter) = date_trunc('quarter', {DAY})
    else date_trunc('month', d_quarter) = date_trunc('month', {DAY}) end""",
)


@query(RESIGNED_SQL)
def conditional_distinct_sums(spark, d):
    return _plan(DirectorsFeatures, spark, d, *DIRECTOR_TABLES, "dir12_director_dtls").resigned_director_feat()


@query(DISQ_ACTIVE_SQL)
def disqualified_active(spark, d):
    return _plan(DirectorsFeatures, spark, d, *DIRECTOR_TABLES, "director_remarks").disq_dir_active()


@query(DISQ_RESIGNED_SQL)
def disqualified_resigned(spark, d):
    return _plan(DirectorsFeatures, spark, d, *DIRECTOR_TABLES, "director_remarks").disq_dir_resigned()


@query(RATING_SQL)
def two_hop_rating(spark, d):
    return _plan(DirectorsFeatures, spark, d, *DIRECTOR_TABLES, "credit_rating_data").is_dir_in_d_rated_company()


@query(DEFAULT_SQL)
def two_hop_default(spark, d):
    return _plan(DirectorsFeatures, spark, d, *DIRECTOR_TABLES, "cibil_defaulter_data").is_dir_in_cibil_defaulted_company()


# --- financials -----------------------------------------------------------------------------

_ROW_KEY = "company_master_id, financial_year, is_consolidated_standalone_stmt"


def _latest_sql(table: str, columns: list[str], order: str, where: str) -> str:
    cleaned = f"""select company_master_id, financial_year, lower(trim(is_consolidated_standalone_stmt)) as stmt, {', '.join(columns)},
      row_number() over (partition by {_ROW_KEY} order by {order}, {', '.join(f'{c} nulls last' for c in columns)}) as nth
    from {table} where is_consolidated_standalone_stmt is not null and {where}"""
    return f"(select * exclude (nth) from ({cleaned}) where nth = 1)"


def _prefer_sql(rows: str) -> str:
    return f"""select * from ({rows}) qualify row_number() over (partition by company_master_id, financial_year
  order by case when stmt = 'standalone' then 1 else 0 end, stmt) = 1"""


def _ef_statements() -> str:
    where, order = f"financial_year in {YEARS_SQL}", "document_date desc nulls last"
    return _prefer_sql(
        f"""select * from {_latest_sql('accord_mca_balance_sheet', list(EF_BALANCE), order, where)}
  join {_latest_sql('accord_mca_profit_loss', list(EF_PROFIT), order, where)} using ({_KEYS})
  join {_latest_sql('accord_mca_financial_ratio', list(EF_RATIOS), order, where)} using ({_KEYS})"""
    )


def _ef_rated() -> str:
    divided = {
        "growth_in_pat": "(pat - pat_prev) / pat_prev",
        "ebitda_by_sales": "t_editda_curr / gross_sales_curr",
        "ebitda_margin": "t_editda_curr / t_tot_rev_curr",
        "working_capital_by_asset": "working_capital / tot_assets_curr",
        "short_term_debt_by_cash_eqv": "shrt_term_borrow_curr / cash_eqv_curr",
        "short_term_debt_by_networth": "shrt_term_borrow_curr / networth",
        "roa": "pat / t_tot_assets_curr",
        "roe": "pat / networth",
        "total_debt_by_pat": "total_borrow / pat",
        "pat_by_ebitda": "pat / t_editda_curr",
        "growth_in_operating_income": "((t_editda_curr - tot_depr_depl_amor_curr) / (t_editda_prev - tot_depr_depl_amor_prev) - 1) * 100",
        "debt_by_gross_accrual": "total_borrow / (t_tot_profit_loss_for_period_curr + tot_depr_depl_amor_curr)",
        "ltborrowing_by_gross_accrual": "lng_term_borrow_curr / (t_tot_profit_loss_for_period_curr + tot_depr_depl_amor_curr)",
        "ltborrowing_by_ebitda": "lng_term_borrow_curr / t_editda_curr",
        "debt_by_ebitda": "total_borrow / t_editda_curr",
        "working_capital_turnover_ratio": "t_tot_rev_frm_operation_curr / working_capital",
        "creditor_period": "trade_pay_curr * 365 / (t_invent_chng_fg_wip_stck_in_trade_curr + material_cost_consumd_curr + invent_stck_in_trade_curr)",
    }
    known = ", ".join(f"case when isnan({q}) then null else {q} end as {n}" for n, q in divided.items())
    return f"""select *, inventory_days + receivables_days - creditor_period as working_capital_cycle from (select *, {known} from (
  select *, coalesce(share_cap_curr + rsrv_surp_curr + money_share_warrnt_curr, 0) as networth,
    t_tot_non_curr_liability_curr + t_tot_curr_liability_curr as total_liabilities,
    t_rev_frm_prod_sale_curr + t_rev_frm_serv_sale_curr as est_rev, t_tot_rev_curr as total_revenue,
    tot_profit_bfr_tax_curr - tot_tax_exp_curr as pat, t_tot_profit_bfr_tax_prev - tot_tax_exp_prev as pat_prev, t_editda_curr as ebitda,
    tot_curr_assets_curr - tot_curr_liability_curr as working_capital, lng_term_borrow_curr + shrt_term_borrow_curr as total_borrow,
    t_tot_rev_frm_operation_curr as revenue_from_operations, t_tot_fixed_assets_curr as tot_fixed_asset,
    t_editda_curr - tot_depr_depl_amor_curr as operating_income, return_on_cap_employed as roce,
    cast(left(financial_year, 4) as bigint) as financial_year_start
  from ({_ef_statements()})))"""


_STATEMENT_FEATURES = [f for f in [*EF_FEATURES, *OTHER_FEATURES] if not f.endswith("_yrs")]


def _ef_history_sql(names: list[str]) -> str:
    def known(x: str) -> str:
        return f"case when isnan({x}) then null else {x} end"

    cols = []
    for i in WINDOWS:
        for f in TREND_FEATURES:
            lag = f"lag({f}, {i}) over w"
            diff = f"({known(f'({f} - {lag})')})"
            perc = f"(100 * ({diff} / {lag}))"
            cols += [f"{lag} as {f}_prv_{i}_yrs", f"{diff} as {f}_diff_{i}_yrs", f"{known(perc)} as {f}_diff_perc_{i}_yrs"]
        for f in GROWTH_FEATURES:
            lag = f"lag({f}, {i}) over w"
            cols += [
                f"{lag} as {f}_prv_{i}_yrs",
                f"case when {f} / {lag} > 0 and not isnan({f} / {lag}) then round(pow({f} / {lag}, 1.0 / {i}) - 1, 6) end as {f}_diff_perc_{i}_yrs",
            ]
    return f"""select company_master_id, financial_year, financial_year_start, {', '.join(names)} from (
  select *, {', '.join(cols)} from ({_ef_rated()}) window w as (partition by company_master_id order by financial_year_start))
where financial_year = '{YEARS[-1]}'"""


def _round_growth(df):
    grown = [c for c in df.columns if c.startswith("total_revenue_diff_perc")]
    return df.withColumns({c: F.round(c, 6) for c in grown})


EF_TABLES = ("accord_mca_balance_sheet", "accord_mca_profit_loss", "accord_mca_financial_ratio")
_ALL_HISTORY = [
    f"{f}_{kind}_{i}_yrs" for f in TREND_FEATURES for kind in ("prv", "diff", "diff_perc") for i in WINDOWS
] + [f"{f}_{kind}_{i}_yrs" for f in GROWTH_FEATURES for kind in ("prv", "diff_perc") for i in WINDOWS]
EF_SQL = _ef_history_sql(EF_FEATURES)


@query(f"select company_master_id, financial_year, {', '.join(_STATEMENT_FEATURES)} from ({_ef_rated()})")
def ef_ratios(spark, d):
    plan = _plan(EfFinancialFeatures, spark, d, *EF_TABLES)
    frames = plan.source_frames()
    return statement_ratios(plan.statements(*frames)).select(COMPANY, FY, *_STATEMENT_FEATURES)


@query(EF_SQL)
def ef_history(spark, d):
    return _round_growth(_plan(EfFinancialFeatures, spark, d, *EF_TABLES).get_ef_financials())


@query(_segment(EF_SQL))
def ef_history_of_universe(spark, d):
    return _round_growth(_plan(EfFinancialFeatures, spark, d, *EF_TABLES, companies="segment_companies").get_ef_financials())


@query(_ef_history_sql([*EF_FEATURES, *OTHER_FEATURES, *[h for h in _ALL_HISTORY if h not in EF_FEATURES]]))
def ef_all_features(spark, d):
    return _round_growth(_plan(EfFinancialFeatures, spark, d, *EF_TABLES).get_ef_financials(all_features=True))


def _fs_sql(form: str = "ratio", extra: str = "") -> str:
    year = f"financial_year = '{YEARS[-1]}'"
    rows = _prefer_sql(
        f"""select * from {_latest_sql('accord_mca_balance_sheet', ['accord_mca_balance_sheet_dtls_id', 'form_id', *FS_BALANCE], 'accord_mca_balance_sheet_dtls_id desc', year).replace('form_id', 'form_id as bs_form', 1)}
  join {_latest_sql('accord_mca_profit_loss', ['accord_mca_profit_loss_id', *FS_PROFIT], 'accord_mca_profit_loss_id desc', year)} using ({_KEYS})
  left join {_latest_sql('financial_ratios', ['financial_ratios_id', 'form_id', *FS_RATIOS], 'financial_ratios_id desc', year).replace('form_id', 'form_id as r_form', 1)} using ({_KEYS})"""
    )
    form_id = "r_form" if form == "ratio" else "bs_form"

    def div(a: str, b: str) -> str:
        return f"(({a}) / nullif({b}, 0))"

    def change(cur: str, prev: str) -> str:
        return div(f"{cur} - {prev}", prev)

    first, second = [], []
    for p, assets, s in (("curr", "total_assets_cur", ""), ("prev", "total_assets_prev", "_prev")):
        profit, interest, loan, cost = (f"{n}_{p}" for n in ("t_tot_profit_loss_for_period", "intreset_inc", "loan", "fince_cost"))
        funding = f"debt_security_{p} + borrowings_{p} + dep_{p} + subordinated_liab_{p}"
        first += [
            f"case when form in (3, 39) then t_tot_assets_{p} else tot_assets_{p} end as {assets}",
            f"case when form in (37, 38) then t_networth_{p} else t_tot_share_hold_fund_{p} end as networth_{p}",
            f"case when form in (37, 38) then {div(interest, loan)} - {div(cost, funding)} end as spread{s}",
            f"case when form in (37, 38) then {div(f'{interest} - {cost}', loan)} end as nim{s}",
            f"{div(interest, loan)} as yield{s}",
            f"case when form in (37, 38) then {div(cost, loan)} else {div(cost, f'lng_term_borrow_{p} + shrt_term_borrow_{p}')} end as cost_of_funds{s}",
        ]
        second.append(f"{div(profit, f'networth_{p}')} as roe_{p}")
    second += [
        f"2 * {div('t_tot_profit_loss_for_period_curr', 'total_assets_cur + total_assets_prev')} as roa",
        f"{div('case when form in (37, 38) then t_tot_fin_liab_curr else lng_term_borrow_curr + shrt_term_borrow_curr end', 'networth_curr')} as leverage",
        "case when form in (37, 38) then imp_loa_ratio_curr end as credit_costs",
        "t_tot_profit_loss_for_period_curr as pat", "t_othr_exp_curr as other_expenses",
        "t_cash_eqv_bank_curr as cash", "t_tot_fixed_assets_curr as fixed_assets",
    ]
    pairs = {
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
    third = [f"{change(*pair)} as {name}_change" for name, pair in pairs.items()] + ["roe_curr as roe"]
    finite = ", ".join(f"case when isfinite({f}) then {f} end as {f}" for f in FS_FEATURES)
    return f"""select company_master_id, financial_year, {finite}, cast(left(financial_year, 4) as bigint) as financial_year_start from (
  select *, {', '.join(third)} from (select *, {', '.join(second)} from (select *, {', '.join(first)}
    from (select *, {form_id} as form from ({rows})))))"""


FS_TABLES = ("accord_mca_balance_sheet", "accord_mca_profit_loss", "financial_ratios")
FS_SQL = _fs_sql()


@query(FS_SQL)
def fs_ratios(spark, d):
    return _plan(FsFinancialFeatures, spark, d, *FS_TABLES).get_fs_financials()


@query(_segment(FS_SQL))
def fs_ratios_of_universe(spark, d):
    return _plan(FsFinancialFeatures, spark, d, *FS_TABLES, companies="segment_companies").get_fs_financials()


@query(_fs_sql("balance_sheet"))
def fs_ratios_by_balance_sheet_form(spark, d):
    return _plan(FsFinancialFeatures, spark, d, *FS_TABLES, form_id_source="balance_sheet").get_fs_financials()


# --- courts ---------------------------------------------------------------------------------

_SANE = f"between date '1900-01-01' and {NOW}"
_DISPOSED_LIST = ", ".join(f"'{s}'" for s in BIFR_DISPOSED_STATUSES)


def _records(court: str, past: bool) -> str:
    """One row per case with its first filing and last disposal."""
    open_date = NOW if past else "null"
    flags = "0 as crime, 0 as cheque"
    if court == "bifr":
        rows = f"""select company_master_id, case_number, make_date(case_year, 1, 1) as filed,
      case when status in ({_DISPOSED_LIST}) then d_date_of_last_order else {open_date} end as disposed, {flags} from yml_bifr_litigation_data"""
        in_order = "filed <= disposed" if past else f"disposed < {NOW}"
    elif court == "nclt":
        rows = f"""select company_master_id, cpno as case_number, d_order_date as filed,
      coalesce(cast(try_strptime(disposed_date, '%d-%m-%Y') as date), {open_date}) as disposed, {flags} from yml_nclt_litigation_data
    where lower(sections) = 'ibc under sec 7' and lower(trim(case_status)) in ('disposed off', 'disposed', 'pending')"""
        in_order = "filed <= disposed" if past else "filed < disposed"
    else:
        table, case, decided = {
            "high": ("yml_high_court_litigation_data", "case_no", "crawl_dispose_date"),
            "district": ("yml_district_court_litigation_data", "case_number", "d_decision_date"),
        }[court]
        rows = f"""select company_master_id, {case} as case_number, make_date(case_year, 1, 1) as filed,
      coalesce(try_cast({decided} as date), {open_date}) as disposed, coalesce(try_cast(is_criminal as int), 0) as crime,
      case when lower(trim(act)) like '%negotiable instruments act%' then 1 else 0 end as cheque from {table}
    where lower(trim(case_status)) in ('pending', 'case pending', 'disposed')"""
        in_order = "filed <= disposed"
    valid = f"filed {_SANE} and disposed {_SANE} and {in_order}"
    if not past:
        valid = f"disposed is null or ({valid})"
    return f"""select company_master_id, case_number, min(filed) as filed, max(disposed) as disposed, max(crime) as crime, max(cheque) as cheque
  from ({rows}) where {valid} group by 1, 2"""


def _open_sql(records: str, name: str, past: bool) -> str:
    on = DAY if past else NOW
    count = "count(filed) - count(disposed)"
    if past:
        count = f"count(*) filter (filed <= {DAY}) - count(*) filter (disposed <= {DAY})"
    return f"select company_master_id, cast({on} as varchar) as as_on_date, {count} as {name} from ({records}) group by 1"


def _courts_sql(flag: str, past: bool) -> str:
    both = [f"select * from ({_records(c, past)}) where {flag} = 1" for c in ("high", "district")]
    return " union all ".join(both)


def _sat_sql(past: bool) -> str:
    on = DAY if past else NOW
    upto = f"and d_date <= {DAY}" if past else ""
    return f"""select company_master_id, cast({on} as varchar) as as_on_date, count(distinct link) as number_of_past_sat_cases
from yml_sat_litigation_data where d_date > date '1900-01-01' {upto} group by 1"""


def _court_scorecard_sql(past: bool) -> str:
    blocks = [
        _open_sql(_records("bifr", past), "number_of_bifr_cases", past),
        _sat_sql(past),
        _open_sql(_records("nclt", past), "number_of_nclt_cases", past),
        _open_sql(_courts_sql("crime", past), "no_of_criminal_cases", past),
        _open_sql(_courts_sql("cheque", past), "no_of_check_bounce_cases", past),
    ]
    joined = f"({blocks[0]})" + "".join(f" full join ({b}) using (company_master_id, as_on_date)" for b in blocks[1:])
    return f"""select company_master_id, as_on_date, number_of_bifr_cases, number_of_past_sat_cases, number_of_nclt_cases,
  no_of_criminal_cases, no_of_check_bounce_cases from {joined} where company_master_id in (select company_master_id from companies)"""


COURT_TABLES = ("yml_high_court_litigation_data", "yml_district_court_litigation_data")
ALL_COURT_TABLES = ("yml_sat_litigation_data", "yml_bifr_litigation_data", "yml_nclt_litigation_data", *COURT_TABLES)


@query(_sat_sql(True))
def sat_cases_past(spark, d):
    return _plan(LitigationFeatures, spark, d, "yml_sat_litigation_data").sat_cases()


@query(_sat_sql(False))
def sat_cases_current(spark, d):
    return _plan(LitigationFeatures, spark, d, "yml_sat_litigation_data", as_on=TODAY).sat_cases()


@query(f"select company_master_id, case_number, cast(filed as varchar) as filed, cast(disposed as varchar) as disposed from ({_records('bifr', False)})")
def bifr_case_records(spark, d):
    return _plan(LitigationFeatures, spark, d, "yml_bifr_litigation_data", as_on=TODAY).bifr_case_records()


@query(_open_sql(_records("bifr", True), "number_of_bifr_cases", True))
def bifr_cases_past(spark, d):
    return _plan(LitigationFeatures, spark, d, "yml_bifr_litigation_data").bifr_cases()


@query(_segment(_open_sql(_records("bifr", True), "number_of_bifr_cases", True)))
def bifr_cases_of_universe(spark, d):
    return _plan(LitigationFeatures, spark, d, "yml_bifr_litigation_data", companies="segment_companies").bifr_cases()


@query(_open_sql(_records("bifr", False), "number_of_bifr_cases", False))
def bifr_cases_current(spark, d):
    return _plan(LitigationFeatures, spark, d, "yml_bifr_litigation_data", as_on=TODAY).bifr_cases()


@query(_open_sql(_records("nclt", True), "number_of_nclt_cases", True))
def nclt_cases_past(spark, d):
    return _plan(LitigationFeatures, spark, d, "yml_nclt_litigation_data").nclt_cases()


@query(_open_sql(_records("nclt", False), "number_of_nclt_cases", False))
def nclt_cases_current(spark, d):
    return _plan(LitigationFeatures, spark, d, "yml_nclt_litigation_data", as_on=TODAY).nclt_cases()


@query(_open_sql(_courts_sql("crime", True), "no_of_criminal_cases", True))
def criminal_cases_past(spark, d):
    return _plan(LitigationFeatures, spark, d, *COURT_TABLES).get_criminal_case()


@query(_open_sql(_courts_sql("crime", False), "no_of_criminal_cases", False))
def criminal_cases_current(spark, d):
    return _plan(LitigationFeatures, spark, d, *COURT_TABLES, as_on=TODAY).get_criminal_case()


@query(_open_sql(_courts_sql("cheque", True), "no_of_check_bounce_cases", True))
def cheque_bounce_cases_past(spark, d):
    return _plan(LitigationFeatures, spark, d, *COURT_TABLES).get_check_bounce_cases()


@query(_open_sql(_courts_sql("cheque", False), "no_of_check_bounce_cases", False))
def cheque_bounce_cases_current(spark, d):
    return _plan(LitigationFeatures, spark, d, *COURT_TABLES, as_on=TODAY).get_check_bounce_cases()


@query(f"""with cases as ({_records('bifr', True)}),
events as (select company_master_id, filed as day, 1 as n from cases union all select company_master_id, disposed, -1 from cases),
spine as (select company_master_id, unnest(generate_series(date '{SERIES_START}', {NOW}, interval 1 day))::date as day, 0 as n
  from (select distinct company_master_id from cases)),
per_day as (select company_master_id, day, sum(n) as n from (select * from events union all select * from spine) group by 1, 2)
select company_master_id, cast(day as varchar) as as_on_date,
  cast(sum(n) over (partition by company_master_id order by day rows between unbounded preceding and current row) as bigint) as open_cases
from per_day""")
def bifr_daily_series(spark, d):
    plan = _plan(LitigationFeatures, spark, d, "yml_bifr_litigation_data", series_start=SERIES_START)
    return plan.daily_series(plan.bifr_case_records(), "open_cases", text=True)


@query(_court_scorecard_sql(True))
def court_scorecard(spark, d):
    return _plan(LitigationFeatures, spark, d, *ALL_COURT_TABLES).get_litigation_features()


@query(_court_scorecard_sql(False))
def court_scorecard_current(spark, d):
    return _plan(LitigationFeatures, spark, d, *ALL_COURT_TABLES, as_on=TODAY).get_litigation_features()


# --- everything -----------------------------------------------------------------------------


def _scorecard_sql() -> str:
    audit = [f"{s}_{n}yrs" for s in [*ANSWER_SCORES, *FLAG_SCORES] for n in WINDOWS]
    resigned = [f"n_{w}dir_resigned_in_{y}_yr" for w in ("indep_", "promoter_", "") for y in (1, 2)]
    flags = "disqualified_director_active, disqualified_director_resigned, director_in_d_rated_comp, director_in_defaulted_comp"
    courts = "number_of_bifr_cases, number_of_past_sat_cases, number_of_nclt_cases, no_of_criminal_cases, no_of_check_bounce_cases"
    ef = ", ".join(f"ef.{f} as ef_{f}" for f in EF_FEATURES)
    fs = ", ".join(f"fs.{f} as fs_{f}" for f in FS_FEATURES)
    blocks = [AUDIT_ONE_ROW_SQL, RESIGNED_SQL, DISQ_ACTIVE_SQL, DISQ_RESIGNED_SQL, RATING_SQL, DEFAULT_SQL]
    joins = "".join(f" left join ({b}) using (company_master_id)" for b in blocks)
    return f"""select company_master_id, {', '.join(audit)}, {', '.join(resigned)}, {flags}, {ef}, {fs}, {courts}
from companies {joins} left join ({EF_SQL}) ef using (company_master_id) left join ({FS_SQL}) fs using (company_master_id)
left join ({_court_scorecard_sql(True)}) using (company_master_id)"""


@query(_scorecard_sql())
def scorecard(spark, d):
    out = scorecard_plan(sources(tune_together(spark), d, by_company=True), view(spark, d, "companies"), AS_ON, TODAY)
    grown = [c for c in out.columns if c.startswith("ef_total_revenue_diff_perc")]
    return out.withColumns({c: F.round(c, 6) for c in grown})
