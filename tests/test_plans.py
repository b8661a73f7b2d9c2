"""What the physical plans must look like to hold on large and skewed data."""

import datetime as dt
import re

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from riskfeatures import AuditorFeatures, DirectorsFeatures, LitigationFeatures, Sources, Universe
from riskfeatures.operators.key_filter import key_bits
from riskfeatures.operators.rolling import rolling_rows
from riskfeatures.session import tune, tune_finely
from riskfeatures.sources import TABLES
from riskfeatures.workload import QUERIES, views

SF_DIR = "/root/testdata/sf0.001"
AS_ON, TODAY = dt.date(2020, 8, 20), dt.date(2021, 12, 31)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def empty_sources(spark, tmp_path_factory):
    """Empty Parquet tables, so that scans can be looked at."""
    base = str(tmp_path_factory.mktemp("tables"))
    for name, columns in TABLES.items():
        ddl = ", ".join(f"{c} {t}" for c, t in columns.items())
        spark.createDataFrame([], ddl).write.parquet(f"{base}/{name}")
    sources = Sources(spark)
    for connection in ("etl_etl_data", "live_crawler_output"):
        sources.add_files(connection, base)
    return sources


def test_fine_tuning_ends_with_the_next_tune(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit, None)
    assert int(tune_finely(spark).conf.get(limit)) <= 8000
    assert tune(spark).conf.get(limit, None) == before


def test_case_dates_are_parsed_once(spark, empty_sources):
    plan = LitigationFeatures(empty_sources, Universe.of(spark, [1, 2]), AS_ON, TODAY)
    for cases, pattern, tables in ((plan.court_case_records(), "regexp_extract", 2), (plan.nclt_case_records(), "regexp_replace", 1)):
        assert cases._jdf.queryExecution().optimizedPlan().toString().count(pattern) == tables


def test_years_and_columns_reach_the_statement_scans(spark, empty_sources):
    plan = physical(AuditorFeatures(empty_sources, [1, 2], AS_ON, TODAY).caro_scores())
    assert "GreaterThanOrEqual(financial_year,2016-2017)" in plan and "LessThan(financial_year,2019-2021)" in plan
    assert "In(company_master_id, [1,2])" in plan
    forms = physical(AuditorFeatures(empty_sources, [1], AS_ON, TODAY).form_headers())
    read = re.search(r"ReadSchema: struct<([^>]*)", forms).group(1)
    assert "valid_data" in read and "t_category" not in read


def test_scores_by_year_take_one_exchange_and_no_window(spark):
    companies = views.view(spark, SF_DIR, "companies")
    plan = physical(AuditorFeatures(views.sources(spark, SF_DIR, "aoc4_caro_dtls"), Universe(companies), views.AS_ON, views.TODAY).caro_scores())
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan


def test_universes_given_as_frames_reduce_the_reads(spark, empty_sources):
    universe = Universe.of(spark, spark.range(10))
    tenures = DirectorsFeatures(empty_sources, universe, AS_ON, TODAY).tenures()
    assert "LeftSemi" in physical(tenures)


def test_two_hop_forms_no_company_pairs(spark):
    """A director on every board: rows stay in proportion to the tenures, not their square."""
    n = 3000
    tenures = spark.range(n).selectExpr(
        "id as company_master_id", "cast(if(id % 3 = 0, 0, id) as bigint) as director_master_id", "'director' as designation",
        "'1/1/2010' as appointment_original_date", "cast(null as string) as date_cessation",
    )
    more = tenures.withColumn("director_master_id", F.lit(0).cast("bigint"))
    ratings = spark.range(n).selectExpr(
        "id as company_master_id", "'X' as credit_rating_agency", "'D' as derived_long_term_rating",
        "date '2019-01-01' as d_date_of_last_rating",
    )
    sources = Sources(spark, {"director_history_details": tenures.union(more), "credit_rating_data": ratings})
    plan = DirectorsFeatures(sources, spark.range(n), AS_ON, TODAY).is_dir_in_d_rated_company()
    assert plan.groupBy("director_in_d_rated_comp").count().collect()[0]["count"] == n
    joins = re.findall(r"Join.*director_master_id", physical(plan))
    assert joins and "first_director_in_d_rated_comp" in physical(plan)


def test_hot_company_keeps_every_auditor(spark):
    """One company with a third of all auditor rows gets the same means as by hand."""
    hot = spark.range(3000).selectExpr("1 as company_master_id", "lpad(cast(id as string), 5, '0') as aud_firm_pan")
    rest = spark.range(6000).selectExpr("id + 2 as company_master_id", "'P' as aud_firm_pan")
    rows = hot.union(rest).selectExpr(
        "cast(company_master_id as bigint) as company_master_id", "aud_firm_pan", "'c' as category",
        "'standalone' as is_consolidated_standalone_stmt",
        "if(cast(aud_firm_pan as string) like '%9', 'no', 'yes') as wthr_qualified", "'2019-2020' as financial_year",
    )
    frames = {"aoc4xbrl_auditor_dtls": rows}
    for name in ("form_aoc4_dtls", "aoc4_auditor_dtls", "adt3_general_resignation_dtls"):
        frames[name] = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in TABLES[name].items()))
    plan = AuditorFeatures(Sources(spark, frames), spark.range(1, 6002), AS_ON, TODAY, slice_rows=100)
    history = plan.auditor_history().where("company_master_id = 1").orderBy("auditor_pan")
    values = [0.5, 0.5, 0.5] + [1.0 if i % 10 == 9 else 0.0 for i in range(3000)]
    want = [sum(values[i : i + 4]) / 4 for i in range(3000)]
    assert [r.adv_qual_score_4yrs for r in history.select("adv_qual_score_4yrs").collect()] == want


def test_case_counts_combine_before_the_exchange(spark):
    sources = views.sources(spark, SF_DIR, "yml_high_court_litigation_data", "yml_district_court_litigation_data")
    plan = physical(LitigationFeatures(sources, views.view(spark, SF_DIR, "companies"), views.AS_ON, views.TODAY).court_cases())
    assert "Window" not in plan and plan.count("partial_") >= 4


def test_recent_resignations_filter_before_any_exchange(spark):
    sources = views.sources(spark, SF_DIR, "director_history_details", "director_master", "dir12_director_dtls")
    got = DirectorsFeatures(sources, views.view(spark, SF_DIR, "companies"), views.AS_ON, views.TODAY).resigned_director_feat()
    assert len(rows_of(got)) == 150


def test_windows_are_cut_by_key_and_slice_on_one_path(spark):
    rows = spark.range(100).selectExpr("id % 3 as k", "id as i", "1.0d as v")
    plan = physical(rolling_rows(rows, ["k"], ["i"], {"m": "v"}, slice_rows=10))
    windows = re.findall(r"Window \[.*?\], \[(.*?)\], \[", plan)
    assert windows and all("__slice" in w or "__target" in w for w in windows)
    # the cuts reach the rows inside the search, and are not handed on with them
    assert "Subquery" in plan and not re.search(r"Exchange.*__cuts|Project \[[^(]*__cuts", plan)


def test_audit_row_reads_each_table_once(spark, empty_sources):
    plan = physical(AuditorFeatures(empty_sources, [1, 2], AS_ON, TODAY).get_auditor_features())
    # by a column that only this table's scan asks for
    marks = ("valid_data", "pan_no", "aud_firm_pan", "auditor_resignation_date", "t_fixed_assets")
    reads = re.findall(r"ReadSchema: struct<([^>]*)", plan)
    assert len(reads) == 5 and all(sum(mark + ":" in r for r in reads) == 1 for mark in marks)
    # a company sends its last few rows, however many it has
    assert "WindowGroupLimit" in plan


def test_dependent_reads_are_reduced_at_the_scan(spark, empty_sources):
    """Master, remarks, ratings, defaults and other tenures meet a bitmap of keys before any exchange."""
    features = DirectorsFeatures(empty_sources, [1, 2], AS_ON, TODAY)
    bits = key_bits(spark.range(5), "id")
    plans = {
        ("derived_long_term_rating",): features.is_dir_in_d_rated_company(),
        ("credit_bureau",): features.default_periods(bits),
        ("DIN", "remarks"): features.disq_dir_active(),
    }
    for marks, plan in plans.items():
        # the blanks to strip are printed as they are, line ends among them
        plan = re.sub(r"Some\([^)]*\)", "Some()", physical(plan))
        lines = plan.splitlines()
        for mark in marks:
            scans = [i for i, line in enumerate(lines) if "FileScan" in line and re.search(rf"ReadSchema: .*\b{mark}:", line)]
            assert scans, mark
            for i in scans:
                # going up from the scan, the join with the bitmap comes before an exchange
                depth, above = len(lines[i]) - len(lines[i].lstrip(" :+-")), []
                for line in reversed(lines[:i]):
                    indent = len(line) - len(line.lstrip(" :+-"))
                    if indent < depth:
                        above.append(line)
                        depth = indent
                first = next(line for line in above if "Exchange" in line or "__word" in line and "Join" in line)
                assert "Join" in first, (mark, first)


def test_dependent_reads_pass_few_rows(spark):
    """One company of ten thousand: hardly any rating or remark is read for it."""
    n = 10_000
    tenures = spark.range(n).selectExpr(
        "id as company_master_id", "id div 2 as director_master_id", "'director' as designation",
        "'1/1/2010' as appointment_original_date", "cast(null as string) as date_cessation",
    )
    ratings = spark.range(n).selectExpr(
        "id as company_master_id", "'X' as credit_rating_agency", "'D' as derived_long_term_rating", "date '2019-01-01' as d_date_of_last_rating",
    )
    plan = DirectorsFeatures(Sources(spark, {"director_history_details": tenures, "credit_rating_data": ratings}), [7], AS_ON, TODAY)
    directors = key_bits(plan.tenures(), "director_master_id")
    boards = key_bits(plan.liable_directors(directors), "company_master_id")
    assert 2 <= plan.liable_directors(directors).count() <= 20
    assert 2 <= plan.rating_periods(boards).count() <= 50
    assert rows_of(plan.is_dir_in_d_rated_company()) == [(7, 1)]


def test_feature_queries_run_in_many_small_parts(spark):
    import __spark_entry__

    named = __spark_entry__.queries()
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    df = named["criminal_cases_past"](spark, "/root/testdata/sf0.001")
    # as dealt, whatever the number of parts that the session asks for
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(company_master_id" in plan and ", 512)" in plan and ", 8)" not in plan
    assert spark.conf.get(size) != before
    # the operators on texts and others run with the session's own
    named["op10_spotsigs"](spark, "/root/testdata/sf0.001")
    assert spark.conf.get(size) == before
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None


def test_scorecard_deals_orders_and_lines_once(spark):
    """All views that join the two read one and the same exchange, so its rows lie on disk once."""
    text = physical(QUERIES["scorecard"](tune_finely(spark), SF_DIR))
    tune(spark)
    scans = {re.sub(r"#\d+L?", "", line) for line in text.splitlines() if "FileScan parquet" in line and "l_orderkey" in line}
    assert text.count("REPARTITION_BY_COL") > 8 and len({re.sub(r"^\W*", "", s) for s in scans}) == 1


def test_views_dealt_by_company_hold_the_same_rows(spark, tmp_path):
    """With null keys, orders without lines, lines without orders, and rows that occur twice."""
    for name in ("orders", "lineitem"):
        df = spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(200)
        keys = [c for c in df.columns if c.endswith("key")]
        nulls = df.limit(40).withColumns({c: F.lit(None).cast("bigint") for c in keys[:1]})
        more = nulls.union(df.limit(9)).union(df.limit(30).withColumn("o_custkey", F.lit(None).cast("bigint")) if name == "orders" else df.limit(3))
        df.union(more).write.parquet(f"{tmp_path}/{name}.parquet")
    for name in ("order_sums", "tenure", "aoc4_auditor_dtls", "adt3_general_resignation_dtls", "yml_bifr_litigation_data"):
        plain, dealt = (views.view(spark, str(tmp_path), name, by_company) for by_company in (False, True))
        assert plain.columns == dealt.columns and plain.count() == dealt.count() > 0
        assert plain.exceptAll(dealt).isEmpty()
