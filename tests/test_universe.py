"""A universe that is a part of the companies, as list and as DataFrame, in every entry."""

import pytest

from helpers import rows_of
from riskfeatures.plans.audit import AuditorFeatures
from riskfeatures.plans.directors import DirectorsFeatures
from riskfeatures.plans.enterprise import EfFinancialFeatures
from riskfeatures.plans.financial_services import FsFinancialFeatures
from riskfeatures.plans.litigation import LitigationFeatures
from riskfeatures.workload.views import AS_ON, TODAY, sources

SF_DIR = "/root/testdata/sf0.001"
IDS = list(range(1, 11))
ENTRIES = {
    "ef": lambda p: EfFinancialFeatures(*p).get_ef_financials(),
    "fs": lambda p: FsFinancialFeatures(*p).get_fs_financials(),
    "audit": lambda p: AuditorFeatures(*p).get_auditor_features(),
    "audit facts": lambda p: AuditorFeatures(*p).auditor_facts(),
    "resigned": lambda p: DirectorsFeatures(*p).tenures(),
    "sat": lambda p: LitigationFeatures(*p).sat_cases(),
    "bifr": lambda p: LitigationFeatures(*p).bifr_cases(),
    "nclt": lambda p: LitigationFeatures(*p).nclt_cases(),
    "criminal": lambda p: LitigationFeatures(*p).get_criminal_case(),
    "cheques": lambda p: LitigationFeatures(*p).get_check_bounce_cases(),
    "courts": lambda p: LitigationFeatures(*p).get_litigation_features(),
}


@pytest.mark.parametrize("name", ENTRIES)
def test_only_companies_of_the_universe(spark, name):
    ids = spark.createDataFrame([(0, i) for i in IDS], "rank int, company_master_id int")
    listed, framed = (ENTRIES[name]((sources(spark, SF_DIR), u, AS_ON, TODAY)) for u in (IDS, ids))
    mine = rows_of(listed, *sorted(listed.columns))
    assert mine == rows_of(framed, *sorted(listed.columns))
    assert mine and {r.company_master_id for r in framed.select("company_master_id").collect()} <= set(IDS)
