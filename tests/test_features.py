"""Hand-computed rows for every feature block."""

import datetime as dt
import math

import pytest
from helpers import rows_of

from riskfeatures import (
    AuditorFeatures, DirectorsFeatures, EfFinancialFeatures, FsFinancialFeatures, LitigationFeatures, Sources, scorecard,
)
from riskfeatures.plans import enterprise, financial_services
from riskfeatures.sources import TABLES

AS_ON, TODAY = dt.date(2020, 8, 20), dt.date(2021, 12, 31)
FY = "2019-2020"
D = dt.date


def source(spark, **tables):
    """Sources with the given rows (dicts with the columns that matter) and empty others."""
    frames = {}
    for name, columns in TABLES.items():
        ddl = ", ".join(f"{c} {t}" for c, t in columns.items())
        rows = [tuple(r.get(c) for c in columns) for r in tables.get(name, [])]
        frames[name] = spark.createDataFrame(rows, ddl)
    return Sources(spark, frames)


def value(df, company, *names):
    row = df.where(f"company_master_id = {company}").first()
    return row[names[0]] if len(names) == 1 else tuple(row[n] for n in names)


# --- audit ----------------------------------------------------------------------------------


def _form(company, fy, stmt, answer, at, valid=1):
    return dict(
        company_master_id=company, financial_year=fy, is_consolidated_standalone_stmt=stmt, valid_data=valid,
        inserted_at=at, wthr_fin_statement_qualify=answer,
    )


def _auditor(company, fy, stmt, pans):
    return dict(company_master_id=company, financial_year=fy, is_consolidated_standalone_stmt=stmt, pan_no=pans, t_category="Firm ")


def _audit(spark, companies=(1, 2), **options):
    t = lambda n: dt.datetime(2020, 1, n)
    tables = source(
        spark,
        form_aoc4_dtls=[
            _form(1, FY, " Standalone", " NO ", t(2)),
            _form(1, FY, "standalone", "yes", t(1)),
            _form(1, FY, "standalone", "yes", t(3), valid=0),
            _form(1, "2018-2019", "Consolidated ", "yes", t(1)),
        ],
        aoc4_auditor_dtls=[
            _auditor(1, FY, "STANDALONE", "'aaa', \"bbb\","),
            _auditor(1, "2018-2019 ", "consolidated", "aaa"),
            _auditor(1, "2010-2011", "standalone", "old"),
            _auditor(1, FY, None, "ccc"),
        ],
        aoc4xbrl_auditor_dtls=[
            dict(company_master_id=1, financial_year=FY, is_consolidated_standalone_stmt="standalone", aud_firm_pan="AAA", category="x", wthr_qualified="yes"),
        ],
        adt3_general_resignation_dtls=[
            dict(company_master_id=1, financial_year=FY, auditor_pan=" bbb", auditor_firm=" F ", auditor_resignation_date="2020-03-31"),
            dict(company_master_id=1, financial_year=FY, auditor_pan="aaa", auditor_firm="F", auditor_resignation_date="2020-04-01"),
            dict(company_master_id=1, financial_year=FY, auditor_pan="aaa", auditor_firm="F", auditor_resignation_date=None),
        ],
        aoc4_caro_dtls=[
            dict(company_master_id=1, financial_year=FY, is_consolidated_standalone_stmt="Standalone ", t_fixed_assets="Favourable", t_fraud_noticed="Disclaimer"),
            dict(company_master_id=1, financial_year="2018-2019", is_consolidated_standalone_stmt="standalone", t_fixed_assets="unfavourable"),
            dict(company_master_id=1, financial_year="2017-2018", is_consolidated_standalone_stmt="consolidated", t_fixed_assets="unfavourable"),
        ],
    )
    return AuditorFeatures(tables, list(companies), AS_ON, TODAY, **options)


def test_auditor_facts(spark):
    got = _audit(spark).auditor_facts()
    facts = rows_of(got, "financial_year", "auditor_pan", "wthr_qualified", "has_auditor_resigned", "adv_qualified", "adverse_qualf_and_resigned", "auditor_firm")
    # the form source wins over the other one for AAA; 1 April belongs to the next year
    assert facts == [
        ("2018-2019", "AAA", "yes", 0, 0, 0, None),
        (FY, "AAA", "no", 0, 1, 0, None),
        (FY, "BBB", "no", 1, 1, 1, "F"),
    ]
    strict = _audit(spark, strict=True).auditor_facts().where(f"financial_year = '{FY}'")
    assert rows_of(strict, "auditor_pan", "has_auditor_resigned") == [(" BBB", 0), ("AAA", 0)]


def test_audit_scores(spark):
    got = _audit(spark).get_auditor_features(one_row=False)
    assert len(got.columns) == 37
    assert value(got, 1, "fixed_assets_score_1yrs", "fixed_assets_score_2yrs", "fixed_assets_score_4yrs", "fraud_score_1yrs") == (1.0, 0.5, 0.5, 0.0)
    # rows: 2016 and 2017 completed with 0.5, 2018 AAA 0, then AAA 1 and BBB 1
    ours = got.where("company_master_id = 1")
    assert rows_of(ours.select("adv_qual_score_1yrs", "adv_qual_score_4yrs").distinct()) == [(1.0, 0.5), (1.0, 0.625)]
    assert rows_of(ours.select("auditor_resigned_score_1yrs", "auditor_resigned_score_3yrs").distinct()) == [(0.0, 0.5 / 3), (1.0, 1 / 3)]
    assert ours.count() == 8  # two distinct rows of each of the three scores
    other = got.where("company_master_id = 2").first().asDict()
    assert other.pop("company_master_id") == 2 and set(other.values()) == {0.5}


def test_audit_one_row(spark):
    got = _audit(spark).get_auditor_features()
    assert got.count() == 2
    assert value(got, 1, "adv_qual_score_4yrs", "auditor_resigned_score_1yrs") == (0.625, 1.0)


# --- directors ------------------------------------------------------------------------------


def _tenure(company, director, start, end=None, designation="Director"):
    return dict(
        company_master_id=company, director_master_id=director, designation=designation,
        appointment_original_date=start, date_cessation=end,
    )


def _master(*directors):
    return [dict(director_master_id=d, DIN=1000 + d) for d in directors]


def test_resignations(spark):
    def at(days):
        d = AS_ON - dt.timedelta(days=days)
        return f"{d.day}/{d.month}/{d.year}"

    category = lambda c, d, kind, on: dict(company_master_id=c, director_din=str(1000 + d), t_dir_category=kind, appt_chng_desig_date=on)
    tables = source(
        spark,
        director_history_details=[
            _tenure(1, 1, "1/1/2010", at(0)),
            _tenure(1, 1, "1/1/2011", at(0)),  # same person, same day: once
            _tenure(1, 1, "1/1/2012", at(10)),  # another day: again
            _tenure(1, 2, "1/1/2010", at(364)),
            _tenure(1, 3, "1/1/2010", at(365)),
            _tenure(1, 4, "1/1/2010", at(729)),
            _tenure(1, 5, "1/1/2010", at(730)),  # in the look-back, in no count
            _tenure(1, 6, "1/1/2010", at(-1)),
            _tenure(1, 7, "1/1/2010"),
            _tenure(1, 8, "1/1/2010", at(1)),  # not in the master table
            _tenure(2, 9, "1/1/2010", at(900)),
        ],
        director_master=_master(1, 2, 3, 4, 5, 6, 7, 9),
        dir12_director_dtls=[
            category(1, 1, "Independent ", D(2019, 1, 1)),
            category(1, 1, "promoter", D(2018, 1, 1)),
            category(1, 2, "promoter", None),  # without a date: never the latest
            category(1, 4, " PROMOTER", D(2018, 1, 1)),
            dict(company_master_id=1, director_din="n/a", t_dir_category="independent", appt_chng_desig_date=D(2020, 1, 1)),
        ],
    )
    got = DirectorsFeatures(tables, [1, 2, 3], AS_ON, TODAY).resigned_director_feat()
    names = got.columns[1:]
    assert value(got, 1, *names) == (2, 2, 0, 1, 3, 5)
    assert value(got, 2, *names) == value(got, 3, *names) == (0, 0, 0, 0, 0, 0)


def test_disqualification(spark):
    remark = lambda d, text: dict(din=f" {1000 + d} ", remarks=text)
    tables = source(
        spark,
        director_history_details=[
            _tenure(1, 1, "1/1/2010"),  # open: ends on the as-on date
            _tenure(2, 2, "1/1/2010", "1/5/2017"),  # an old end inside a period counts too
            _tenure(3, 1, "20/8/2020"),  # appointed on the as-on date: no tenure yet
            _tenure(4, 3, "1/1/2010", "31/3/2021"),  # leaves in the as-on year, later
            _tenure(5, 4, "1/1/2010"),
            _tenure(6, 5, "1/1/2010", "1/1/2015"),
        ],
        director_master=_master(1, 2, 3, 4, 5),
        director_remarks=[
            remark(1, "Disqualified from 01/11/16 to 20/08/2020"),
            remark(2, "from 01/11/2016 to 31/10/2021"),
            remark(3, "from 31/03/2021 to 31/03/2022"),
            remark(4, "from 31/10/2021 to 01/11/2016"),
            remark(5, "from 01/11/2016 to 31/10/2021"),
            dict(din="n/a", remarks="from 01/11/2016 to 31/10/2021"),
        ],
    )
    companies = [1, 2, 3, 4, 5, 6]
    plan = DirectorsFeatures(tables, companies, AS_ON, TODAY)
    assert [r[1] for r in rows_of(plan.disq_dir_active())] == [1, 1, 0, 0, 0, 0]
    assert [r[1] for r in rows_of(plan.disq_dir_resigned())] == [0, 0, 0, 1, 0, 0]
    today = DirectorsFeatures(tables, companies, AS_ON, AS_ON)  # only open tenures
    assert [r[1] for r in rows_of(today.disq_dir_active())] == [1, 0, 0, 0, 0, 0]
    # read by two digits every period starts or ends in 2020, and none is left
    assert [r[1] for r in rows_of(DirectorsFeatures(tables, companies, AS_ON, TODAY, strict=True).disq_dir_active())] == [1, 0, 0, 0, 0, 0]


def test_two_hop_ratings_and_defaults(spark):
    rating = lambda c, agency, grade, on: dict(
        company_master_id=c, credit_rating_agency=agency, derived_long_term_rating=grade, d_date_of_last_rating=on
    )
    default = lambda c, bureau, on: dict(company_master_id=c, credit_bureau=bureau, d_quarter=on)
    tables = source(
        spark,
        director_history_details=[
            _tenure(1, 1, "1/1/2010"), _tenure(2, 1, "1/1/2010"),  # both companies share director 1
            _tenure(3, 2, "1/1/2010"), _tenure(2, 2, "1/1/2010", "1/3/2020"),  # left 2 less than 182 days ago
            _tenure(4, 3, "1/1/2010"), _tenure(2, 3, "1/1/2010", "20/2/2020"),  # exactly 182 days ago: free
            _tenure(5, 4, "1/1/2010", designation="Nominee Director"), _tenure(2, 4, "1/1/2010"),
            _tenure(6, 5, "1/1/2010", designation=None), _tenure(2, 5, "1/1/2010"),
            _tenure(7, 6, "1/1/2010", "20/8/2020"), _tenure(2, 6, "1/1/2010"),  # left on the as-on date
            _tenure(8, 7, "1/1/2010"), _tenure(9, 7, "1/1/2010"),
        ],
        credit_rating_data=[
            rating(2, "X", " D ", D(2019, 1, 1)), rating(2, "X", "A", D(2020, 8, 20)), rating(2, "X", "D", D(2021, 1, 1)),
            rating(9, "Y", "D", D(2019, 1, 1)), rating(9, "Y", "B", D(2019, 6, 1)),
            rating(8, None, "D", D(2021, 1, 1)),
        ],
        cibil_defaulter_data=[
            default(2, " CIBIL", D(2020, 9, 30)), default(9, "other", D(2020, 9, 30)), default(8, None, D(2020, 8, 1)),
            default(8, "other", D(2020, 8, 31)),
        ],
    )
    plan = DirectorsFeatures(tables, range(1, 10), AS_ON, TODAY)
    # company 2 is D-rated on the day; it is flagged only through another bad company
    assert [r[1] for r in rows_of(plan.is_dir_in_d_rated_company())] == [1, 0, 1, 0, 0, 1, 0, 0, 0]
    # 2 and 8 are in default: 8's director also sits in 9, 9's in 8
    assert [r[1] for r in rows_of(plan.is_dir_in_cibil_defaulted_company())] == [1, 0, 1, 0, 0, 1, 0, 0, 1]
    assert plan.get_director_features().count() == 9


# --- financials -----------------------------------------------------------------------------


def _statement(company, fy, stmt="Standalone", at=D(2020, 1, 1), **amounts):
    return dict(company_master_id=company, financial_year=fy, is_consolidated_standalone_stmt=stmt, document_date=at, **amounts)


def _ef(spark, rows):
    known = {c: 10.0 for c in [*enterprise.BALANCE_SHEET, *enterprise.PROFIT_LOSS, *enterprise.RATIOS]}
    rows = [{**known, **r} for r in rows]
    tables = source(spark, accord_mca_balance_sheet=rows, accord_mca_profit_loss=rows, accord_mca_financial_ratio=rows)
    return EfFinancialFeatures(tables, [1, 2], AS_ON, TODAY).get_ef_financials(all_features=True)


def test_enterprise_ratios(spark):
    got = _ef(
        spark,
        [
            _statement(1, FY, " standalone "),
            _statement(1, FY, "Consolidated", at=D(2020, 1, 2), share_cap_curr=0.0, tot_profit_bfr_tax_curr=30.0, cash_eqv_curr=0.0, gross_sales_curr=None, trade_pay_curr=3.0),
            _statement(1, FY, "Consolidated", at=None, share_cap_curr=999.0),
            _statement(1, FY, None, share_cap_curr=999.0),
        ],
    )
    assert got.count() == 1
    v = lambda *n: value(got, 1, *n)
    assert v("networth", "pat", "pat_prev", "roe", "total_debt_by_pat") == (20.0, 20.0, 0.0, 1.0, 1.0)
    assert v("growth_in_pat") == math.inf and v("short_term_debt_by_cash_eqv") == math.inf
    assert v("ebitda_by_sales") is None and v("working_capital", "working_capital_turnover_ratio") == (0.0, math.inf)
    assert v("creditor_period", "working_capital_cycle") == (3.0 * 365 / 30, 20.0 - 3.0 * 365 / 30)
    assert v("growth_in_operating_income") is None  # 0 / 0
    assert v("pat_diff_perc_1_yrs", "financial_year_start") == (None, 2019)


def test_enterprise_missing_networth_is_zero(spark):
    got = _ef(spark, [_statement(1, FY, rsrv_surp_curr=None, t_tot_share_hold_fund_curr=50.0)])
    assert value(got, 1, "networth", "roe") == (0.0, None)  # pat 0 / networth 0


def test_enterprise_history(spark):
    years = {"2015-2016": 7.0, "2016-2017": 2.0, "2018-2019": -4.0, FY: 16.0}
    got = _ef(spark, [_statement(1, fy, t_tot_rev_curr=x, inventory_days=x) for fy, x in years.items()])
    # 2015 is no valid year and 2017 is missing, so the earlier rows move up
    assert value(got, 1, *[f"inventory_days_diff_{i}_yrs" for i in (1, 2, 3, 4)]) == (20.0, 14.0, None, None)
    assert value(got, 1, "inventory_days_diff_perc_1_yrs") == -500.0
    assert value(got, 1, "total_revenue_diff_perc_1_yrs") is None  # negative ratio
    assert value(got, 1, "total_revenue_diff_perc_2_yrs") == pytest.approx(math.sqrt(8) - 1)


def _fs(spark, balance=None, profit=None, ratio=None, form=37, **options):
    key = dict(company_master_id=1, financial_year=FY, is_consolidated_standalone_stmt="Standalone", form_id=form)
    b = {c: 10.0 for c in financial_services.BALANCE_SHEET}
    p = {c: 10.0 for c in financial_services.PROFIT_LOSS}
    r = {c: 10.0 for c in financial_services.RATIOS}
    tables = source(
        spark,
        accord_mca_balance_sheet=[
            {**key, **b, **(balance or {}), "accord_mca_balance_sheet_dtls_id": 2},
            {**key, **b, "t_networth_curr": 999.0, "accord_mca_balance_sheet_dtls_id": 1},
        ],
        accord_mca_profit_loss=[{**key, **p, **(profit or {}), "accord_mca_profit_loss_id": 1}],
        financial_ratios=[] if ratio is None else [{**key, **r, **ratio, "financial_ratios_id": 1}],
    )
    return FsFinancialFeatures(tables, [1], AS_ON, TODAY, **options).get_fs_financials()


def test_financial_services_nbfc(spark):
    got = _fs(
        spark,
        dict(loan_curr=4.0, loan_prev=0.0, t_networth_curr=5.0, t_networth_prev=4.0, t_tot_share_hold_fund_curr=77.0, t_tot_fin_liab_curr=15.0),
        dict(intreset_inc_curr=8.0, t_tot_profit_loss_for_period_curr=20.0),
        dict(imp_loa_ratio_curr=3.0, imp_loa_ratio_prev=2.0),
    )
    assert got.columns[:2] == ["company_master_id", "financial_year"] and len(got.columns) == 29
    v = lambda *n: value(got, 1, *n)
    assert v("networth_curr", "roa", "roe", "roe_curr", "leverage") == (5.0, 2.0, 4.0, 4.0, 3.0)
    assert v("spread", "nim", "yield", "cost_of_funds") == (2.0 - 10.0 / 40.0, -0.5, 2.0, 2.5)
    assert v("credit_costs", "credit_costs_change", "networth_change", "pat_change") == (3.0, 0.5, 0.25, 1.0)
    assert v("spread_change", "yield_change") == (None, None)  # no previous loan


def test_financial_services_other_forms(spark):
    got = _fs(spark, dict(tot_assets_curr=1.0, t_tot_assets_curr=7.0, lng_term_borrow_curr=None), ratio={}, form=3)
    assert value(got, 1, "total_assets_cur", "spread", "nim", "leverage", "cost_of_funds", "credit_costs") == (7.0, None, None, None, None, None)
    skipping = _fs(spark, dict(lng_term_borrow_curr=None), ratio={}, form=3, nulls="skip")
    assert value(skipping, 1, "leverage", "cost_of_funds") == (1.0, 1.0)


def test_financial_services_form_comes_from_the_ratio_table(spark):
    balance = dict(t_networth_curr=5.0, t_tot_share_hold_fund_curr=8.0)
    assert value(_fs(spark, balance), 1, "networth_curr") == 8.0  # no ratio row: no form id
    assert value(_fs(spark, balance, form_id_source="balance_sheet"), 1, "networth_curr") == 5.0
    with pytest.raises(ValueError):
        _fs(spark, form_id_source="x")


def test_financial_services_zero_divisors(spark):
    zero = {c: 0.0 for c in financial_services.BALANCE_SHEET}
    got = _fs(spark, zero, ratio={}).first().asDict()
    assert all(got[n] is None for n in ("roa", "roe", "spread", "nim", "leverage", "yield", "cost_of_funds", "networth_change"))
    infinite = _fs(spark, dict(t_cash_eqv_bank_curr=math.inf), ratio={})
    assert value(infinite, 1, "cash", "cash_change") == (None, None)


# --- courts ---------------------------------------------------------------------------------


def _courts(spark):
    bifr = lambda c, n, year, status, last=None: dict(
        company_master_id=c, case_number=n, case_year=year, status=status, d_date_of_last_order=last
    )
    nclt = lambda n, status, filed, disposed=None, section="IBC under Sec 7": dict(
        company_master_id=1, cpno=n, case_status=status, sections=section, d_order_date=filed, disposed_date=disposed
    )
    high = lambda n, year, status, decided, act, crime: dict(
        company_master_id=1, case_no=n, case_year=year, case_status=status, crawl_dispose_date=decided, act=act, is_criminal=crime
    )
    return source(
        spark,
        yml_sat_litigation_data=[
            dict(company_master_id=1, d_date=d, link=x)
            for d, x in ((D(2019, 1, 1), "a"), (D(2019, 2, 1), "a"), (D(2021, 1, 1), "b"), (D(1899, 1, 1), "c"), (D(2020, 8, 20), "d"))
        ],
        yml_bifr_litigation_data=[
            bifr(1, "a", 2010, "Pending"), bifr(1, "a", 2008, "Abated", D(2021, 6, 1)),  # one case, disposed after the as-on date
            bifr(1, "b", 2012, "Winding up Notice", D(2015, 1, 1)),
            bifr(1, "c", 1899, "Pending"),  # no disposal: valid now, not sane in the past view
            bifr(1, "d", 2030, "Abated", D(2021, 1, 1)),
            bifr(2, "e", 2021, "Pending"),
            bifr(2, None, 2010, "Pending"),
        ],
        yml_nclt_litigation_data=[
            nclt("a", " Disposed ", D(2019, 1, 1), "01-02-2020"), nclt("b", "Pending", D(2019, 1, 1)),
            nclt("c", "disposed", D(2019, 1, 1), "01-01-2019"),  # same day: valid in the past view only
            nclt("d", "admitted", D(2019, 1, 1)), nclt("e", "pending", D(2019, 1, 1), section="other"),
            nclt("f", "pending", D(2019, 1, 1), "soon"),
        ],
        yml_high_court_litigation_data=[
            high("1", 2015, "Pending", None, "x", "1"), high("1", 2014, "disposed ", "2021-05-01", "The Negotiable Instruments Act", "0"),
            high("2", 2016, "Disposed", "2017-01-01", " NEGOTIABLE INSTRUMENTS ACT", "1"),
            high("3", 2016, "transferred", None, "negotiable instruments act", "1"),
            high("4", 2018, "disposed", "2017-01-01", "x", "1"),  # decided before it was filed
        ],
        yml_district_court_litigation_data=[
            dict(company_master_id=1, case_number="1", case_year=2015, case_status="case pending", d_decision_date=None, act=None, is_criminal="1"),
        ],
    )


def test_litigation_as_of_a_past_date(spark):
    plan = LitigationFeatures(_courts(spark), [1, 2, 3], AS_ON, TODAY)
    got = plan.get_litigation_features()
    names = ("number_of_past_sat_cases", "number_of_bifr_cases", "number_of_nclt_cases", "no_of_criminal_cases", "no_of_check_bounce_cases")
    assert value(got, 1, "as_on_date") == AS_ON
    # criminal: high 1 (any of its rows) and district 1 open, high 2 closed; cheque: high 1 open, 2 closed
    assert value(got, 1, *names) == (2, 1, 2, 2, 1)
    assert value(got, 2, *names) == (None, 0, None, None, None)
    assert got.count() == 2
    assert value(plan.get_criminal_case(), 1, "no_of_criminal_cases") == 2
    assert value(plan.get_check_bounce_cases(), 1, "no_of_check_bounce_cases") == 1
    series = plan.daily_series(plan.bifr_case_records(), "n")
    on_day = rows_of(series.where(f"as_on_date = '{AS_ON}'"), "company_master_id", "n")
    assert on_day == [(1, 1), (2, 0)]


def test_litigation_now(spark):
    got = LitigationFeatures(_courts(spark), [1, 2, 3], TODAY, TODAY).get_litigation_features()
    names = ("number_of_past_sat_cases", "number_of_bifr_cases", "number_of_nclt_cases", "no_of_criminal_cases", "no_of_check_bounce_cases")
    assert value(got, 1, "as_on_date") == TODAY
    # bifr: a has a disposal, c is open; nclt: b and f are open
    assert value(got, 1, *names) == (3, 1, 2, 1, 0)
    assert value(got, 2, "number_of_bifr_cases") == 1


def test_scorecard_has_one_row_per_company(spark):
    got = scorecard(_courts(spark), [1, 2, 3], AS_ON, TODAY)
    assert [r[0] for r in rows_of(got, "company_master_id")] == [1, 2, 3]
    assert len(got.columns) == 1 + 36 + 10 + 65 + 26 + 5
    assert value(got, 3, "fraud_score_4yrs", "n_dir_resigned_in_1_yr", "ef_roa", "number_of_bifr_cases") == (0.5, 0, None, None)
