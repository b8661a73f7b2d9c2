"""One query per operator, each over whole tables, with the SQL that must agree."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.numbers import columns, ieee_div, inf_to_null, nan_to_null, safe_div, sum_cols
from ..functions.text import contains, strip, strip_lower, strip_upper
from ..operators.answers import answer_scores
from ..operators.cases import dedup_cases, open_as_of, open_daily, open_now
from ..operators.intervals import extract_periods, interval_join, merge_periods
from ..operators.latest import any_per_key, latest_per_key, prefer_consolidated
from ..operators.lists import explode_ids
from ..operators.members import company_years, complete_with, conditional_distinct, membership_flag, side_by_side
from ..operators.rolling import history_features, next_event_date, rolling_rows, running_totals
from ..sources.registry import cast_losses as losses_of
from ..sources.registry import narrow
from ..sources.schemas import TABLES
from .registry import query
from .views import AS_ON, SERIES_START, TODAY, fy_label, run_sql, sources, view

COMPANY, FY, STMT = "company_master_id", "financial_year", "is_consolidated_standalone_stmt"
CALENDAR = D.AsOn(AS_ON, TODAY)
YEARS = CALENDAR.valid_years
YEARS_SQL = "(" + ", ".join(f"'{y}'" for y in YEARS) + ")"
DAY, NOW = f"date '{AS_ON}'", f"date '{TODAY}'"

# one statement row per order
STMT_SQL = f"""select company_master_id, financial_year, lower(trim(is_consolidated_standalone_stmt)) as stmt,
  document_date, o_orderkey as id, price, qty, tax, disc from order_sums"""


def _stmt(spark, d):
    rows = view(spark, d, "order_sums").withColumnRenamed("o_orderkey", "id")
    return rows.select(COMPANY, FY, strip_lower(STMT).alias("stmt"), "document_date", "id", "price", "qty", "tax", "disc")


# --- scans ----------------------------------------------------------------------------------


@query("""select company_master_id, financial_year, valid_data from form_aoc4_dtls
where is_consolidated_standalone_stmt in ('CONSOLIDATED', ' Standalone ') and valid_data in (1)
  and company_master_id in (select c_custkey from customer where c_mktsegment in ('MACHINERY', 'FURNITURE'))""")
def scan_filter_keys(spark, d):
    keys = run_sql(
        spark, d, f"select c_custkey as {COMPANY} from customer where c_mktsegment in ('MACHINERY', 'FURNITURE')"
    )
    return sources(spark, d, "form_aoc4_dtls").read(
        "form_aoc4_dtls",
        [COMPANY, FY, "valid_data", STMT],
        filters={STMT: ["CONSOLIDATED", " Standalone "], "valid_data": [1]},
        keys=keys,
    ).drop(STMT)


@query("select company_master_id, d_date_of_last_rating::varchar as d_date_of_last_rating from credit_rating_data")
def scan_unfiltered(spark, d):
    return sources(spark, d, "credit_rating_data").read("credit_rating_data", [COMPANY, "d_date_of_last_rating"])


# ratings as a text export would hold them: some ids and days are no ids and days
_RATING_TEXT = """select case when o_orderpriority = '2-HIGH' then 'n/a' else cast(o_custkey as string) end as company_master_id,
  ' agency' as credit_rating_agency, 'D' as derived_long_term_rating,
  case o_orderpriority when '5-LOW' then 'unknown' when '1-URGENT' then null else cast(cast(o_orderdate as date) as string) end as d_date_of_last_rating
from orders"""


@query("""select 'company_master_id' as column_name, count(*) filter (o_orderpriority = '2-HIGH') as lost, count(*) as total from orders
union all select 'd_date_of_last_rating', count(*) filter (o_orderpriority = '5-LOW'), count(*) from orders""")
def cast_losses(spark, d):
    return losses_of(run_sql(spark, d, _RATING_TEXT), TABLES["credit_rating_data"])


@query("select case_number, company_master_id from (select * from yml_bifr_litigation_data) "
       "order by company_master_id, case_number limit 100")
def scan_limit(spark, d):
    rows = view(spark, d, "yml_bifr_litigation_data").select("case_number", COMPANY)
    return narrow(rows.orderBy(COMPANY, "case_number"), limit=100)


# --- cleaning -------------------------------------------------------------------------------


@query("""select company_master_id, trim(financial_year) as fy, lower(trim(is_consolidated_standalone_stmt)) as stmt,
  upper(trim(wthr_fin_statement_qualify)) as qualified from form_aoc4_dtls""")
def normalise_text(spark, d):
    return view(spark, d, "form_aoc4_dtls").select(
        COMPANY,
        strip(FY).alias("fy"),
        strip_lower(STMT).alias("stmt"),
        strip_upper("wthr_fin_statement_qualify").alias("qualified"),
    )


@query("""select h.company_master_id, h.director_master_id,
  cast(cast(try_strptime(appointment_original_date, '%d/%m/%Y') as date) as varchar) as appointed,
  cast(cast(try_strptime(date_cessation, '%d/%m/%Y') as date) as varchar) as ceased
from director_history_details h""")
def parse_dates(spark, d):
    return view(spark, d, "director_history_details").select(
        COMPANY,
        "director_master_id",
        D.parse_dmy("appointment_original_date").alias("appointed"),
        D.parse_dmy("date_cessation").alias("ceased"),
    )


@query("""select company_master_id, try_cast(trim(director_din) as bigint) as din,
  cast(appt_chng_desig_date as varchar) as since, cast(split_part(cast(appt_chng_desig_date as varchar), '-', 1) as bigint) as since_year
from dir12_director_dtls""")
def parse_numbers(spark, d):
    return view(spark, d, "dir12_director_dtls").select(
        COMPANY,
        F.expr("try_cast(director_din as bigint)").alias("din"),
        F.col("appt_chng_desig_date").alias("since"),
        D.year_of_label(F.col("appt_chng_desig_date").cast("string")).alias("since_year"),
    )


@query("""select company_master_id, coalesce(wthr_qualified, 'unknown') as qualified,
  case when coalesce(trim(lower(wthr_qualified)) = 'no', false) then 1 else 0 end as not_qualified,
  coalesce(wthr_qualified, category) as first_known, 1 as marker,
  case when category = 'R' then 1 else 0 end * case when coalesce(trim(lower(wthr_qualified)) = 'no', false) then 1 else 0 end as both_flags
from aoc4xbrl_auditor_dtls""")
def null_defaults(spark, d):
    rows = view(spark, d, "aoc4xbrl_auditor_dtls")
    not_qualified = F.coalesce(strip_lower("wthr_qualified") == "no", F.lit(False))
    return rows.select(
        COMPANY,
        F.coalesce("wthr_qualified", F.lit("unknown")).alias("qualified"),
        not_qualified.alias("not_qualified"),
        F.coalesce("wthr_qualified", "category").alias("first_known"),
        F.lit(1).alias("marker"),
        (F.when(F.col("category") == "R", 1).otherwise(0) * not_qualified.cast("int")).alias("both_flags"),
    )


@query("""select id, case when isnan(q) then null else q end as ratio,
  case when isnan(q) or isinf(q) then null else q end as finite_ratio,
  case when tax = 0 then null else price / tax end as guarded, coalesce(price, 0) + coalesce(tax, 0) as skipping, price + tax as propagating
from (select o_orderkey as id, cast(price as double) as price, cast(tax as double) as tax,
  (cast(price as double) - 5000000) / cast(tax as double) as q from order_sums)""")
def inf_to_null_ratio(spark, d):
    rows = run_sql(
        spark, d, "select o_orderkey as id, cast(price as double) as price, cast(tax as double) as tax from order_sums"
    )
    ratio = ieee_div("(price - 5000000)", "tax")
    out = {
        "ratio": nan_to_null(ratio),
        "finite_ratio": inf_to_null(ratio),
        "guarded": safe_div("price", "tax"),
        "skipping": sum_cols(["price", "tax"], nulls="skip"),
        "propagating": sum_cols(["price", "tax"]),
    }
    return rows.withColumns(columns(out)).drop("price", "tax")


# --- predicates -----------------------------------------------------------------------------


@query(f"""select company_master_id, director_master_id, cast(appointed as varchar) as appointed, cast(ceased as varchar) as ceased
from tenure where not coalesce(lower(designation) like '%nominee%', false) and (ceased is null or ceased > {DAY})""")
def active_non_nominee(spark, d):
    in_office = F.col("ceased").isNull() | (F.col("ceased") > D.date_lit(AS_ON))
    rows = view(spark, d, "tenure").where(~contains(F.lower("designation"), "nominee") & in_office)
    return rows.drop("designation")


@query(f"""select company_master_id, director_master_id, cast(ceased as varchar) as ceased from tenure
where ceased between {DAY} - 730 and {DAY} and appointed < ceased""")
def date_predicates(spark, d):
    first = D.date_lit(AS_ON - dt.timedelta(days=730))
    rows = view(spark, d, "tenure").where(F.col("ceased").between(first, D.date_lit(AS_ON)))
    return rows.where(F.col("appointed") < F.col("ceased")).select(COMPANY, "director_master_id", "ceased")


@query(f"""select company_master_id, case_number, act from yml_district_court_litigation_data
where lower(trim(act)) like '%negotiable instruments act%' and lower(trim(case_status)) in ('pending', 'case pending', 'disposed')
  and make_date(case_year, 1, 1) between date '1900-01-01' and {NOW}""")
def text_predicates(spark, d):
    rows = view(spark, d, "yml_district_court_litigation_data").where(
        strip_lower("act").like("%negotiable instruments act%")
        & strip_lower("case_status").isin("pending", "case pending", "disposed")
        & D.is_sane(D.first_of_january("case_year"), TODAY)
    )
    return rows.select(COMPANY, "case_number", "act")


@query(f"""select company_master_id, filed, disposed, valid_now, valid_then from (
  select company_master_id, cast(f as varchar) as filed, cast(p as varchar) as disposed,
    case when p is null then 1 when p between date '1900-01-01' and {NOW} and f between date '1900-01-01' and {NOW} and p < {NOW} then 1 else 0 end as valid_now,
    case when f between date '1900-01-01' and {NOW} and f <= coalesce(p, {NOW}) then 1 else 0 end as valid_then
  from (select company_master_id, make_date(case_year, 1, 1) as f, d_date_of_last_order as p from yml_bifr_litigation_data))""")
def validity_flags(spark, d):
    rows = view(spark, d, "yml_bifr_litigation_data").select(
        COMPANY, D.first_of_january("case_year").alias("filed"), F.col("d_date_of_last_order").alias("disposed")
    )
    filed, disposed, today = F.col("filed"), F.col("disposed"), D.date_lit(TODAY)
    sane = D.is_sane("filed", TODAY) & D.is_sane("disposed", TODAY)
    return rows.withColumns(
        {
            "valid_now": disposed.isNull() | (sane & (disposed < today)),
            "valid_then": D.is_sane("filed", TODAY) & (filed <= F.coalesce(disposed, today)),
        }
    )


# --- calendar -------------------------------------------------------------------------------


def _dated_orders(spark, d):
    return run_sql(spark, d, "select o_orderkey, cast(o_orderdate as date) as day from orders")


@query(f"""select o_orderkey, {fy_label('o_orderdate')} as financial_year, cast(month(o_orderdate) as bigint) as month_no,
  cast(year(o_orderdate) as bigint) as year_no from orders""")
def fy_of_date(spark, d):
    return _dated_orders(spark, d).select(
        "o_orderkey", D.financial_year("day").alias(FY), F.month("day").alias("month_no"), F.year("day").alias("year_no")
    )


@query("""select o_orderkey, cast(make_date(y, 4, 1) as varchar) as fy_start, cast(make_date(y + 1, 3, 31) as varchar) as fy_end,
  cast(make_date(y - 2, 4, 1) as varchar) as prev_start, cast(make_date(y - 1, 3, 31) as varchar) as prev_end
from (select o_orderkey, year(o_orderdate) - case when month(o_orderdate) <= 3 then 1 else 0 end as y from orders)""")
def fy_bounds(spark, d):
    start, end = D.fy_bounds("day")
    prev_start, prev_end = D.fy_bounds("day", 2)
    return _dated_orders(spark, d).select(
        "o_orderkey",
        start.alias("fy_start"),
        end.alias("fy_end"),
        prev_start.alias("prev_start"),
        prev_end.alias("prev_end"),
    )


@query("""select o_orderkey, cast(cast(q as date) as varchar) as q_start, cast(cast(q + interval 3 month - interval 1 day as date) as varchar) as q_end,
  cast(cast(q - interval 9 month as date) as varchar) as prev_start, cast(cast(q - interval 6 month - interval 1 day as date) as varchar) as prev_end,
  cast(cast((q + interval 3 month - interval 1 day) - interval 9 month as date) as varchar) as prev_end_by_month
from (select o_orderkey, date_trunc('quarter', o_orderdate) as q from orders)""")
def quarter_bounds(spark, d):
    start, end = D.quarter_bounds("day")
    prev_start, prev_end = D.quarter_bounds("day", 3)
    return _dated_orders(spark, d).select(
        "o_orderkey",
        start.alias("q_start"),
        end.alias("q_end"),
        prev_start.alias("prev_start"),
        prev_end.alias("prev_end"),
        D.quarter_bounds("day", 3, strict=True)[1].alias("prev_end_by_month"),
    )


@query("""select company_master_id, cast(case when b = 'cibil' then date_trunc('quarter', d_quarter) else date_trunc('month', d_quarter) end as date)::varchar as p_start,
  cast(case when b = 'cibil' then date_trunc('quarter', d_quarter) + interval 3 month - interval 1 day
    else date_trunc('month', d_quarter) + interval 1 month - interval 1 day end as date)::varchar as p_end
from (select company_master_id, lower(trim(credit_bureau)) as b, d_quarter from cibil_defaulter_data) where b is not null""")
def report_periods(spark, d):
    rows = view(spark, d, "cibil_defaulter_data").withColumn("bureau", strip_lower("credit_bureau"))
    start, end = D.report_period("d_quarter", "bureau")
    return rows.where("bureau is not null").select(COMPANY, start.alias("p_start"), end.alias("p_end"))


@query(f"select company_master_id, financial_year from companies, (select unnest([{YEARS_SQL[1:-1]}]) as financial_year)")
def company_year_spine(spark, d):
    return company_years(view(spark, d, "companies"), YEARS)


@query(f"""select o_custkey as company_master_id, cast(least(coalesce(c, {DAY}), {DAY}) as varchar) as capped, cast(c + 182 as varchar) as liable_until
from (select company_master_id as o_custkey, ceased as c from tenure)""")
def cap_end_date(spark, d):
    return view(spark, d, "tenure").select(
        COMPANY, D.cap_at("ceased", AS_ON).alias("capped"), F.date_add("ceased", 182).alias("liable_until")
    )


# --- one row per key ------------------------------------------------------------------------

_KEYED = "stmt is not null"


def _first(order: str, where: str = "true", keys: str = "company_master_id, financial_year, stmt") -> str:
    return f"""select company_master_id, financial_year, stmt, id from ({STMT_SQL}) where {_KEYED} and {where}
qualify row_number() over (partition by {keys} order by {order}) = 1"""


@query(_first("document_date desc, id", "document_date is not null"))
def latest_by_value(spark, d):
    return latest_per_key(_stmt(spark, d), [COMPANY, FY, "stmt"], "document_date", ties=["id"]).select(COMPANY, FY, "stmt", "id")


@query(_first("document_date desc nulls last, id"))
def latest_by_date_nulls_last(spark, d):
    out = latest_per_key(_stmt(spark, d), [COMPANY, FY, "stmt"], "document_date", ties=["id"], nulls="last")
    return out.select(COMPANY, FY, "stmt", "id")


@query(_first("id desc"))
def latest_by_id(spark, d):
    return latest_per_key(_stmt(spark, d), [COMPANY, FY, "stmt"], "id").select(COMPANY, FY, "stmt", "id")


@query(_first("case when stmt = 'standalone' then 1 else 0 end, stmt, id", keys="company_master_id, financial_year"))
def prefer_consolidated_statement(spark, d):
    out = prefer_consolidated(_stmt(spark, d).where("stmt is not null"), [COMPANY, FY], "stmt", ties=["id"])
    return out.select(COMPANY, FY, "stmt", "id")


@query(_first("qty, id", keys="company_master_id, financial_year"))
def any_one_per_key(spark, d):
    out = any_per_key(_stmt(spark, d).where("stmt is not null"), [COMPANY, FY], ties=["qty", "id"])
    return out.select(COMPANY, FY, "stmt", "id")


# --- row-based windows ----------------------------------------------------------------------


def _rolling(agg: str) -> str:
    cols = []
    for n in (1, 2, 3, 4):
        frame = f"(partition by company_master_id order by financial_year, id rows between {n - 1} preceding and current row)"
        cols.append(f"case when count(amount) over {frame} = {n} then {agg}(amount) over {frame} end as amount_{n}yrs")
    return f"""select company_master_id, financial_year, id, {', '.join(cols)} from (
  select company_master_id, financial_year, o_orderkey as id, cast(qty as double) as amount from order_sums)"""


def _rolled(spark, d, agg, **options):
    rows = run_sql(
        spark, d, f"select {COMPANY}, {FY}, o_orderkey as id, cast(qty as double) as amount from order_sums"
    )
    return rolling_rows(rows, [COMPANY], [FY, "id"], {"amount": "amount"}, agg, **options).drop("amount")


@query(_rolling("sum"))
def rolling_sum(spark, d):
    return _rolled(spark, d, "sum")


@query(_rolling("avg"))
def rolling_mean(spark, d):
    return _rolled(spark, d, "mean")


@query(_rolling("avg"))
def rolling_mean_sliced(spark, d):
    """As above, with nearly every company cut into slices."""
    return _rolled(spark, d, "mean", slice_rows=3)


FIN_SQL = f"""select company_master_id, cast(left(financial_year, 4) as bigint) as fy_start,
  cast(sum(price) as double) as revenue, cast(sum(tax) as double) as tax_paid from order_sums group by 1, 2"""


def _fin(spark, d):
    return run_sql(spark, d, FIN_SQL)


def _history_sql() -> str:
    cols = []
    for i in range(1, 5):
        lag = f"lag(tax_paid, {i}) over w"
        cols.append(f"{lag} as tax_paid_prv_{i}_yrs, tax_paid - {lag} as tax_paid_diff_{i}_yrs")
        ratio = f"100 * ((tax_paid - {lag}) / {lag})"
        cols.append(f"case when isnan({ratio}) then null else {ratio} end as tax_paid_diff_perc_{i}_yrs")
    return f"""select company_master_id, fy_start, {', '.join(cols)} from ({FIN_SQL})
window w as (partition by company_master_id order by fy_start)"""


@query(_history_sql())
def lag_diff_pct(spark, d):
    return history_features(_fin(spark, d), [COMPANY], ["fy_start"], ["tax_paid"]).drop("revenue", "tax_paid")


@query(f"""select company_master_id, fy_start, {', '.join(
    f"case when revenue / lag(revenue, {i}) over w > 0 and not isnan(revenue / lag(revenue, {i}) over w) then round(pow(revenue / lag(revenue, {i}) over w, 1.0 / {i}) - 1, 6) end as growth_{i}"
    for i in range(1, 5))} from ({FIN_SQL}) window w as (partition by company_master_id order by fy_start)""")
def compound_growth(spark, d):
    out = history_features(_fin(spark, d), [COMPANY], ["fy_start"], [], ["revenue"])
    grown = [F.round(f"revenue_diff_perc_{i}_yrs", 6).alias(f"growth_{i}") for i in range(1, 5)]
    return out.select(COMPANY, "fy_start", *grown)


@query(f"""select company_master_id, agency, rating, cast(day as varchar) as rt_from, cast(case when agency is null then {NOW}
  else coalesce(lead(day) over (partition by company_master_id, agency order by day, rating), {NOW}) end as varchar) as rt_to
from (select distinct company_master_id, trim(credit_rating_agency) as agency, lower(trim(derived_long_term_rating)) as rating,
  d_date_of_last_rating as day from credit_rating_data)""")
def next_event_periods(spark, d):
    rows = view(spark, d, "credit_rating_data").select(
        COMPANY,
        strip("credit_rating_agency").alias("agency"),
        strip_lower("derived_long_term_rating").alias("rating"),
        F.col("d_date_of_last_rating").alias("rt_from"),
    )
    return next_event_date(rows.distinct(), [COMPANY, "agency"], "rt_from", "rt_to", D.date_lit(TODAY), ties=["rating"])


@query(f"""select company_master_id, agency, rating, cast(day as varchar) as rt_from, cast(coalesce(
  lead(day) over (partition by agency order by day, rating nulls last, company_master_id), {NOW}) as varchar) as rt_to
from (select distinct company_master_id, trim(credit_rating_agency) as agency, lower(trim(derived_long_term_rating)) as rating,
  d_date_of_last_rating as day from credit_rating_data where credit_rating_agency is not null)""")
def next_event_of_agency(spark, d):
    """The agency's next rating of any company: a few keys hold all rows, cut into slices."""
    rows = view(spark, d, "credit_rating_data").select(
        COMPANY,
        strip("credit_rating_agency").alias("agency"),
        strip_lower("derived_long_term_rating").alias("rating"),
        F.col("d_date_of_last_rating").alias("rt_from"),
    )
    rows = rows.dropna(subset=["agency"]).distinct()
    return next_event_date(rows, ["agency"], "rt_from", "rt_to", D.date_lit(TODAY), ["rating", COMPANY], slice_rows=200)


@query("""select event_type, hour, cast(sum(events) over w as bigint) as events_so_far, cast(sum(cents) over w as bigint) as cents_so_far
from (select event_type, cast(floor(epoch(ts) / 3600) as bigint) as hour, count(*) as events, sum(cast(round(value * 100) as bigint)) as cents
  from events group by 1, 2)
window w as (partition by event_type order by hour rows between unbounded preceding and current row)""")
def running_total_hourly(spark, d):
    """Totals by the hour, which no calendar of days bounds: few keys, cut into slices."""
    hour = F.floor(F.unix_seconds("ts") / 3600).alias("hour")
    cents = F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents")
    per_hour = run_sql(spark, d, "select event_type, cast(ts as timestamp) as ts, value from events").groupBy("event_type", hour).agg(F.count("*").alias("n"), cents)
    totals = {"events_so_far": "n", "cents_so_far": "cents"}
    return running_totals(per_hour, ["event_type"], ["hour"], totals, slice_rows=100).drop("n", "cents")


@query("""select company_master_id, cast(day as varchar) as day, cast(sum(n) over (partition by company_master_id order by day
  rows between unbounded preceding and current row) as bigint) as so_far
from (select company_master_id, d_date as day, count(*) as n from yml_sat_litigation_data group by 1, 2)""")
def running_total(spark, d):
    per_day = view(spark, d, "yml_sat_litigation_data").groupBy(COMPANY, F.col("d_date").alias("day")).agg(F.count("*").alias("n"))
    return running_totals(per_day, [COMPANY], ["day"], {"so_far": "n"}).drop("n")


# --- cases ----------------------------------------------------------------------------------

CASES_SQL = """select company_master_id, case_number, min(filed) as filed, max(disposed) as disposed, max(crime) as crime from (
  select company_master_id, case_number, make_date(case_year, 1, 1) as filed, cast(d_decision_date as date) as disposed,
    coalesce(try_cast(is_criminal as int), 0) as crime from yml_district_court_litigation_data) group by 1, 2"""


def _cases(spark, d):
    rows = view(spark, d, "yml_district_court_litigation_data").select(
        COMPANY,
        "case_number",
        D.first_of_january("case_year").alias("filed"),
        D.parse_iso("d_decision_date").alias("disposed"),
        F.expr("coalesce(try_cast(is_criminal as int), 0)").alias("crime"),
    )
    return dedup_cases(rows, [COMPANY, "case_number"], flags=["crime"])


@query(f"select company_master_id, case_number, cast(filed as varchar) as filed, cast(disposed as varchar) as disposed, cast(crime as bigint) as crime from ({CASES_SQL})")
def group_extrema(spark, d):
    return _cases(spark, d)


@query(f"""select company_master_id, count(filed) - count(disposed) as open_cases,
  case when sum(crime) > 0 then count(filed) filter (crime = 1) - count(disposed) filter (crime = 1) end as open_criminal
from ({CASES_SQL}) group by 1""")
def open_cases_current(spark, d):
    return open_now(_cases(spark, d), [COMPANY], {"open_cases": None, "open_criminal": F.col("crime") == 1})


@query(f"""select company_master_id, count(*) filter (filed <= {DAY}) - count(*) filter (disposed <= {DAY}) as open_cases
from ({CASES_SQL}) group by 1""")
def open_cases_asof(spark, d):
    return open_as_of(_cases(spark, d), [COMPANY], AS_ON, {"open_cases": None})


_START = f"date '{SERIES_START}'"


@query(f"""with cases as ({CASES_SQL}),
events as (select company_master_id, filed as day, 1 as n from cases where filed is not null
  union all select company_master_id, disposed, -1 from cases where disposed <= {NOW}),
spine as (select company_master_id, unnest(generate_series({_START}, {NOW}, interval 1 day))::date as day, 0 as n
  from (select distinct company_master_id from cases)),
per_day as (select company_master_id, day, sum(n) as n from (select * from events union all select * from spine) group by 1, 2)
select company_master_id, cast(day as varchar) as as_on_date,
  cast(sum(n) over (partition by company_master_id order by day rows between unbounded preceding and current row) as bigint) as open_cases
from per_day""")
def running_total_daily(spark, d):
    return open_daily(_cases(spark, d), [COMPANY], SERIES_START, TODAY, "open_cases", text=True)


# --- joins and sets -------------------------------------------------------------------------


@query(f"""select a.company_master_id, a.financial_year, a.l_suppkey, f.id from (
  select o_custkey as company_master_id, {fy_label('l_shipdate')} as financial_year, l_suppkey, 'consolidated' as stmt
  from lineitem join orders on l_orderkey = o_orderkey) a
left join ({_first("id desc")}) f using (company_master_id, financial_year, stmt)""")
def left_join_latest(spark, d):
    lines = run_sql(
        spark, d,
        f"select o_custkey as {COMPANY}, {fy_label('l_shipdate')} as {FY}, l_suppkey, 'consolidated' as stmt "
        "from lineitem join orders on l_orderkey = o_orderkey",
    )
    latest = latest_per_key(_stmt(spark, d), [COMPANY, FY, "stmt"], "id")
    return lines.join(latest, [COMPANY, FY, "stmt"], "left").select(COMPANY, FY, "l_suppkey", "id")


@query(f"""select company_master_id, financial_year, id, qty from order_sums_keyed
union all select company_master_id, financial_year, null, null from (
  select company_master_id, unnest([{YEARS_SQL[1:-1]}]) as financial_year from companies)
  where (company_master_id, financial_year) not in (select (company_master_id, financial_year) from order_sums_keyed)""".replace(
    "order_sums_keyed", "(select company_master_id, financial_year, o_orderkey as id, cast(qty as bigint) as qty from order_sums)"))
def spine_completion(spark, d):
    rows = _stmt(spark, d).select(COMPANY, FY, "id", "qty")
    return complete_with(rows, company_years(view(spark, d, "companies"), YEARS), [COMPANY, FY])


@query("""select company_master_id, sat_cases, bifr_rows from
  (select company_master_id, count(*) as sat_cases from yml_sat_litigation_data group by 1)
  full join (select company_master_id, count(*) as bifr_rows from yml_bifr_litigation_data group by 1)
  using (company_master_id)""")
def full_outer_blocks(spark, d):
    sat = view(spark, d, "yml_sat_litigation_data")
    bifr = view(spark, d, "yml_bifr_litigation_data")
    blocks = [
        sat.groupBy(COMPANY).agg(F.count("*").alias("sat_cases")),
        bifr.groupBy(COMPANY).agg(F.count("*").alias("bifr_rows")),
    ]
    return side_by_side(blocks, [COMPANY])


@query("""select h.company_master_id, m.DIN as din, h.date_cessation from director_history_details h
join director_master m using (director_master_id)""")
def master_join(spark, d):
    master = view(spark, d, "director_master").withColumnRenamed("DIN", "din")
    return view(spark, d, "director_history_details").join(master, "director_master_id").select(COMPANY, "din", "date_cessation")


_SHIPMENTS = f"""select o_custkey as company_master_id, {fy_label('l_shipdate')} as financial_year,
  'consolidated' as stmt, l_orderkey as id from lineitem join orders on l_orderkey = o_orderkey"""
_SHIPPED = f"select company_master_id, financial_year, stmt, min(id) as id from ({_SHIPMENTS}) group by 1, 2, 3"


@query(f"""select b.company_master_id, b.financial_year, b.stmt, b.id, p.id as other_id, r.id as optional_id
from ({_first("id desc")}) b join ({_first("id")}) p using (company_master_id, financial_year, stmt)
left join ({_SHIPPED}) r using (company_master_id, financial_year, stmt)""")
def statement_join(spark, d):
    rows, key = _stmt(spark, d), [COMPANY, FY, "stmt"]
    b = latest_per_key(rows, key, "id").select(*key, "id")
    p = any_per_key(rows, key, ties=["id"]).select(*key, F.col("id").alias("other_id"))
    r = any_per_key(run_sql(spark, d, _SHIPMENTS), key, ties=["id"]).select(*key, F.col("id").alias("optional_id"))
    return b.join(p, key).join(r, key, "left")


def periods_sql(strict: bool = False) -> str:
    def day(word: str) -> str:
        text = f"regexp_extract(lower(trim(remarks)), '{word} (\\d{{2}}/\\d{{2}}/(?:\\d{{4}}|\\d{{2}}))', 1)"
        if strict:
            text = f"regexp_extract(lower(trim(remarks)), '{word} (\\d{{2}}/\\d{{2}}/\\d{{2}})', 1)"
        return f"cast(case when length({text}) = 8 then try_strptime({text}, '%d/%m/%y') else try_strptime({text}, '%d/%m/%Y') end as date)"

    return f"""select din, p_from, p_to from (select try_cast(trim(din) as bigint) as din, {day('from')} as p_from, {day('to')} as p_to
  from director_remarks where regexp_matches(lower(trim(remarks)), 'from \\d{{2}}/\\d{{2}}/\\d{{2,4}} to \\d{{2}}/\\d{{2}}/\\d{{2,4}}'))
where p_from < p_to"""


def _periods(spark, d, strict=False):
    rows = view(spark, d, "director_remarks").select(strip("din").try_cast("bigint").alias("din"), "remarks")
    return extract_periods(rows, "remarks", "p_from", "p_to", strict).drop("remarks")


@query(f"select din, cast(p_from as varchar) as p_from, cast(p_to as varchar) as p_to from ({periods_sql()})")
def extracted_periods(spark, d):
    return _periods(spark, d)


@query(f"select din, cast(p_from as varchar) as p_from, cast(p_to as varchar) as p_to from ({periods_sql(True)})")
def extracted_periods_two_digits(spark, d):
    return _periods(spark, d, strict=True)


@query(f"""select t.company_master_id, t.din, cast(t.ceased as varchar) as ceased, cast(p_from as varchar) as p_from, cast(p_to as varchar) as p_to
from (select company_master_id, director_master_id as din, ceased from tenure) t join ({periods_sql()}) p
  on t.din = p.din and t.ceased between p_from and p_to""")
def interval_join_periods(spark, d):
    points = view(spark, d, "tenure").select(COMPANY, F.col("director_master_id").alias("din"), "ceased")
    return interval_join(points, _periods(spark, d), ["din"], "ceased", "p_from", "p_to")


_TENURE_PERIODS = "select company_master_id, appointed, ceased from tenure where appointed <= ceased"


@query(f"""with p as ({_TENURE_PERIODS}),
marked as (select *, case when max(ceased) over (partition by company_master_id order by appointed, ceased rows between unbounded preceding and 1 preceding) >= appointed then 0 else 1 end as opens from p),
blocks as (select *, sum(opens) over (partition by company_master_id order by appointed, ceased rows between unbounded preceding and current row) as block from marked)
select company_master_id, cast(min(appointed) as varchar) as appointed, cast(max(ceased) as varchar) as ceased from blocks group by company_master_id, block""")
def merged_periods(spark, d):
    rows = view(spark, d, "tenure").where("appointed <= ceased").select(COMPANY, "appointed", "ceased")
    return merge_periods(rows, [COMPANY], "appointed", "ceased")


@query("""select company_master_id, case when exists (select 1 from cibil_defaulter_data x
  where x.company_master_id = c.company_master_id and x.credit_bureau = ' CIBIL') then 1 else 0 end as reported from companies c""")
def membership_flags(spark, d):
    reported = view(spark, d, "cibil_defaulter_data").where("credit_bureau = ' CIBIL'")
    return membership_flag(view(spark, d, "companies"), reported, COMPANY, "reported")


@query("""select company_master_id, count(distinct director_master_id) as directors,
  count(distinct case when designation = 'Director ' then director_master_id end) as plain_directors,
  count(distinct case when ceased is null then director_master_id end) as active_directors from tenure group by 1""")
def conditional_distinct_counts(spark, d):
    conditions = {
        "directors": F.lit(True),
        "plain_directors": F.col("designation") == "Director ",
        "active_directors": F.col("ceased").isNull(),
    }
    return conditional_distinct(view(spark, d, "tenure"), [COMPANY], "director_master_id", conditions)


def answer_score_sql(column: str) -> str:
    return f"""case when max(case when lower({column}) in ('unfavourable', 'disclaimer') then 1 else 0 end) = 1 then 0.0
  when max(case when lower({column}) = 'favourable' then 1 else 0 end) = 1 then 1.0 else 0.5 end::double"""


@query(f"""select company_master_id, financial_year, {answer_score_sql('t_fixed_assets')} as fixed_assets_score,
  {answer_score_sql('t_fraud_noticed')} as fraud_score, {answer_score_sql('t_accept_public_deposits')} as financial_due_score
from aoc4_caro_dtls group by 1, 2""")
def answer_score(spark, d):
    answers = {
        "fixed_assets_score": "t_fixed_assets",
        "fraud_score": "t_fraud_noticed",
        "financial_due_score": "t_accept_public_deposits",
    }
    return answer_scores(view(spark, d, "aoc4_caro_dtls"), [COMPANY, FY], answers)


@query("select distinct company_master_id, credit_rating_agency, derived_long_term_rating from credit_rating_data")
def distinct_rows(spark, d):
    return view(spark, d, "credit_rating_data").select(COMPANY, "credit_rating_agency", "derived_long_term_rating").distinct()


@query("select distinct director_master_id from director_history_details")
def distinct_keys(spark, d):
    return view(spark, d, "director_history_details").select("director_master_id").distinct()


@query("select company_master_id, count(distinct link) as links from yml_sat_litigation_data group by 1")
def count_distinct_links(spark, d):
    return view(spark, d, "yml_sat_litigation_data").groupBy(COMPANY).agg(F.count_distinct("link").alias("links"))


@query("""select company_master_id, case_no as case_number, 'high' as court from yml_high_court_litigation_data
union all select company_master_id, case_number, 'district' from yml_district_court_litigation_data""")
def union_sources(spark, d):
    high = view(spark, d, "yml_high_court_litigation_data").select(COMPANY, F.col("case_no").alias("case_number"))
    district = view(spark, d, "yml_district_court_litigation_data").select("case_number", COMPANY)
    return high.withColumn("court", F.lit("high")).unionByName(district.withColumn("court", F.lit("district")))


@query("""select company_master_id, financial_year, trim(pan) as pan from (
  select company_master_id, financial_year, unnest(string_split(replace(replace(pan_no, '"', ''), '''', ''), ',')) as pan from aoc4_auditor_dtls)
where trim(pan) <> ''""")
def explode_id_list(spark, d):
    return explode_ids(view(spark, d, "aoc4_auditor_dtls"), "pan_no", "pan").select(COMPANY, FY, "pan")


@query("""select company_master_id, financial_year, pan from (
  select company_master_id, financial_year, unnest(string_split(replace(replace(pan_no, '"', ''), '''', ''), ',')) as pan from aoc4_auditor_dtls)
where pan <> ''""")
def explode_id_list_untrimmed(spark, d):
    return explode_ids(view(spark, d, "aoc4_auditor_dtls"), "pan_no", "pan", strict=True).select(COMPANY, FY, "pan")
